"""What the two vector searches share: reading vectors, equal vectors as one, local best lists, merging them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part: not null, no null or non-finite component, of the commonest length."""
    v = F.col(vector).cast("array<double>")
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False))).select("vec_id", v.alias("v"))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("v") == sizes["d"]).withColumn("d", F.lit(sizes["d"])) if sizes else rows.withColumn("d", F.lit(0))


def _named(rows: DataFrame) -> DataFrame:
    """``rows`` plus the vector's 128-bit name (h1, h2)."""
    v = F.transform("v", lambda x: x + 0.0)  # one zero
    return rows.withColumns({"h1": F.xxhash64(v), "h2": F.xxhash64(F.lit(5), v)})


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(vec_id, v, ids): one row for each different vector of ``rows``, with the k + 1 least ids that have it, the first as vec_id.

    No more of them can be among a query's k best, so any number of equal vectors costs as one.
    The limit is applied before the shuffle, so a vector that very many rows have is no hot key.
    """
    window = Window.partitionBy("h1", "h2").orderBy("vec_id")
    least = _named(rows).withColumn("nth", F.row_number().over(window)).where(F.col("nth") <= k + 1)
    return least.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v")).select(F.col("ids")[0].alias("vec_id"), "v", "ids")


def askers(queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The different vectors of ``queries`` as (vec_id, v), and (vec_id, asker): which of them stands for each query."""
    named = _named(queries)
    one = named.groupBy("h1", "h2").agg(F.min("vec_id").alias("asker"), F.first("v").alias("v"))
    return one.select(F.col("asker").alias("vec_id"), "v"), named.select("vec_id", "h1", "h2").join(one.select("h1", "h2", "asker"), ["h1", "h2"]).select("vec_id", "asker")


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of an array<double> column as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def packed(m: np.ndarray) -> pa.Array:
    """Rows of ``m`` as binary values."""
    m = np.ascontiguousarray(m)
    width = m.shape[1] * m.itemsize
    if not len(m):
        return pa.array([], pa.binary())
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(np.arange(0, (len(m) + 1) * width, width, dtype=np.int32)), pa.py_buffer(m)])


def unpacked(column: pa.ChunkedArray | pa.Array, kind: type, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, d)


def best_pairs(scores: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of all scores within ``slack`` of their row's k-th best."""
    if scores.shape[1] <= k:
        return np.nonzero(scores > -np.inf)
    least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    return np.nonzero((scores >= (least - slack)[:, None]) & (scores > -np.inf))


def first_k(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, ties to the smaller id."""
    order = np.lexsort((ids, -scores, query))
    q = query[order]
    begin = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.empty(0, int)
    nth = np.arange(len(q)) - np.repeat(begin, np.diff(np.append(begin, len(q))))
    return order[nth < k]


def answered(found: DataFrame, rows: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best.

    ``found`` (query_id, vec_id, score) has local bests between classes, ``rows`` the classes' ids,
    ``members`` which asker stands for which query. A query's own id is dropped at the end.
    """
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k + 1).drop("rank")
    each = best.join(rows.select("vec_id", "ids"), "vec_id").select("query_id", "score", F.explode("ids").alias("vec_id"))
    each = each.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k + 1)
    lists = each.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best"))
    mine = members.join(lists.withColumnRenamed("query_id", "asker"), "asker")
    other = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("vec_id")), 1, k)
    mine = mine.select(F.col("vec_id").alias("query_id"), F.posexplode(other).alias("at", "one"))
    return mine.select("query_id", (F.col("at") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"), F.col("one.score").alias("score"))
