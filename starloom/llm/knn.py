"""Exact top-k search by inner product as a Voronoi join.

Pivots, as many as the square root of the rows divided by ``ROWS_ROOT`` and at most
``MAX_PIVOTS``, are rows chosen by hash; they divide queries and data into Voronoi cells. Small
summaries follow: for each data cell the distances of its nearest rows to the pivot, and for each
pair of a query cell and a pivot the range of the queries' inner products with that pivot. With y =
pivot + (y - pivot), a query q has q.y within |q| |y - pivot| of q.pivot. The nearest rows bound
every query cell's k-th best score from below; a data row goes only to those query cells where its
own bound from above reaches that. What a query cell gets is cut into blocks of queries and of rows;
each pair of blocks is solved exactly in one task, and the local best are merged. Equal vectors are
one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm._common import stored, table
from starloom.llm._vectors import answered, askers, best_pairs, classes, first_k, matrix, packed, unpacked, usable

NEIGHBOURS = 5
SCALE = 256
ROWS_ROOT = 8
MIN_PIVOTS = 16
MAX_PIVOTS = 256
#: Queries and rows of a pair of blocks: some 20 MB of vectors of 64 components in a task.
BLOCK_QUERIES = 4096
BLOCK_ROWS = 16_384
#: Queries scored at a time.
SLICE = 128


class _Dots:
    """Inner products of integer rows with ``x``: through exact doubles where they can't round, else in integers."""

    def __init__(self, x: np.ndarray) -> None:
        self.x, self.most, self.doubles = x, float(np.abs(x).max(initial=0)) * x.shape[1], x.astype(np.float64)

    def __call__(self, q: np.ndarray) -> np.ndarray:
        if self.most * float(np.abs(q).max(initial=0)) < 2**53:
            return q.astype(np.float64) @ self.doubles.T
        return q @ self.x.T


def _cells(rows: DataFrame, pivots: np.ndarray, d: int) -> DataFrame:
    """(vec_id, v binary of int64, cell, away): the nearest pivot and the distance to it, rounded up."""
    held = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        p = held.value.astype(np.float64)
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                v = np.floor(SCALE * matrix(part.column("v"), d)).astype(np.int64)
                x = v.astype(np.float64)
                cell = ((p * p).sum(axis=1) - 2 * (x @ p.T)).argmin(axis=1)
                away = np.sqrt(((x - p[cell]) ** 2).sum(axis=1)) * (1 + 1e-12)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), packed(v), pa.array(cell.astype(np.int64)), pa.array(away)], ["vec_id", "v", "cell", "away"])

    return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, v binary, cell long, away double")


def _ranges(asked: DataFrame, pivots: np.ndarray, d: int) -> list:
    """Per query cell and pivot: least and greatest inner product; the cell's longest query and number of queries."""
    held = asked.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        p = held.value.astype(np.float64)
        for batch in batches:
            x, cell = unpacked(batch.column("v"), np.int64, d).astype(np.float64), batch.column("cell").to_numpy()
            dots, norm = x @ p.T, np.sqrt((x * x).sum(axis=1))
            out = []
            for c in np.unique(cell):
                own = dots[cell == c]
                out += [(int(c), j, float(own[:, j].min()), float(own[:, j].max()), float(norm[cell == c].max()), len(own)) for j in range(len(p))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(z) for z in zip(*out, strict=True)], ["cell", "pivot", "low", "high", "norm", "n"])

    rows = asked.mapInArrow(run, "cell long, pivot long, low double, high double, norm double, n long")
    return rows.groupBy("cell", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("norm").alias("norm"), F.sum("n").alias("n")).collect()


def search(rows: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, pivots: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score long): each query's k highest integer inner products among ``rows``, exactly.

    Both are (vec_id, embedding); every component x becomes floor(256 x). A query's own vec_id is no
    candidate; ties go to the smaller vec_id; all candidates come where there are at most k.
    Vectors that are null, of another length than most, or hold a null or non-finite component
    take no part; zero vectors do. Repeated vec_ids count as one row; empty tables give no rows;
    other columns are ignored. Exact while sums of products fit 64-bit integers.
    """
    spark = rows.sparkSession
    rows = usable(rows).dropDuplicates(["vec_id"])
    size = rows.agg(F.max("d")).first()
    if size[0] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    d = size[0]
    kinds = stored(classes(rows.select("vec_id", "v"), k), "classes")
    total = kinds.count()
    if pivots is None:
        pivots = int(min(MAX_PIVOTS, max(MIN_PIVOTS, total**0.5 / ROWS_ROOT)))
    sample = kinds.select("v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    centres = np.unique(np.floor(SCALE * np.array([r["v"] for r in sample])), axis=0)
    one, members = askers(usable(queries).where(F.col("d") == d).dropDuplicates(["vec_id"]).select("vec_id", "v"))
    data, asked = stored(_cells(kinds, centres, d), "cells"), stored(_cells(one, centres, d), "cells")

    # Summaries: pivots x (k + 1) distances, and pivots x pivots ranges.
    nearest = data.withColumn("nth", F.row_number().over(Window.partitionBy("cell").orderBy("away"))).where(F.col("nth") <= k + 1).select("cell", "away").collect()
    ranges = _ranges(asked, centres, d)
    need = np.full((len(centres), len(centres)), np.inf)  # data cell x query cell: least distance to the pivot that may matter
    shares = np.zeros(len(centres), int)
    for cell in {r["cell"] for r in ranges}:
        own = {r["pivot"]: r for r in ranges if r["cell"] == cell}
        norm = max(r["norm"] for r in own.values()) * (1 + 1e-12)
        shares[cell] = -(-own[0]["n"] // BLOCK_QUERIES)
        bounds = sorted((own[r["cell"]]["low"] - norm * r["away"] for r in nearest), reverse=True)
        # one of the k + 1 may be the query itself
        least = bounds[k] if len(bounds) > k else -np.inf
        for j, r in own.items():
            need[j, cell] = (least - 1 - r["high"]) / norm if norm else (0 if least <= 1 else np.inf)
    table_ = spark.createDataFrame([(j, [float(x) for x in line]) for j, line in enumerate(need)], "cell long, least array<double>")
    near = F.filter(F.transform("least", lambda x, i: F.when(F.col("away") >= x, i)), lambda i: i.isNotNull())
    data = data.join(F.broadcast(table_), "cell").select("vec_id", "v", F.explode(near).alias("target"))
    # A row a query cell: in how many blocks its rows and its queries go.
    loads = data.groupBy("target").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks")).collect()
    loads = spark.createDataFrame([(r["target"], r["blocks"], int(shares[r["target"]])) for r in loads], "target int, blocks long, shares long")
    data = data.join(F.broadcast(loads), "target").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    data = data.select("target", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), "vec_id", "v")
    asked = asked.withColumn("target", F.col("cell").cast("int")).join(F.broadcast(loads), "target").withColumn("share", F.pmod(F.xxhash64("vec_id"), F.col("shares")))
    asked = asked.select("target", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "share", F.col("vec_id").alias("query_id"), F.col("v").alias("query"))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            ids, x = left.column("vec_id").to_numpy(), unpacked(left.column("v"), np.int64, d)
            who, q = right.column("query_id").to_numpy(), unpacked(right.column("query"), np.int64, d)
            dots = _Dots(x)
            for i in range(0, len(q), SLICE):
                exact = dots(q[i : i + SLICE])
                scores = exact.astype(np.float64)
                r, c = best_pairs(scores, k + 1, np.abs(scores).max(initial=0) * 1e-14)
                values = exact[r, c].astype(np.int64)
                best = first_k(r, ids[c], values, k + 1)
                found.append((who[i + r[best]], ids[c[best]], values[best]))
        a, b, s = (np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3
        return pa.table({"query_id": a, "vec_id": b, "score": s})

    keys = ["target", "share", "block"]
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(solve, "query_id long, vec_id long, score long")
    return answered(found, kinds, members, k)


def op5_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where(F.col("vec_id") % 50 == 0))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256*CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON c.vec_id <> q.vec_id
)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s) WHERE rank <= 5
"""
