"""Approximate nearest neighbours by inner product in a hash-prefix forest.

Each tree gives a vector a long string of ``SYMBOLS`` symbols: a symbol names the axis, with its
sign, of a random 16-dimensional subspace that the vector lies nearest to. A tree is an array of
strings in sorted order, cut into blocks at quantiles. A query descends to its own string's place,
where the entries with the longest common prefixes are, and ascends in all trees at once, level by
level to shorter prefixes, until the prefixes' ranges hold ``budget`` entries; on the last level
only as many trees ascend as it takes. How many entries a range holds is counted exactly inside the
block of the query's place and by whole blocks beyond it. Only the ranges found are scored.

The budget is not fixed: ``CALIBRATION`` queries, chosen by hash, are answered exactly, and the
least budget is taken whose ranges hold the share ``RECALL`` of their true neighbours. The budget
can rise to a whole tree, which finds everything.

Equal vectors are one entry. For vectors of unequal length one coordinate is added that makes all
entries equally long, so the largest inner product is the nearest direction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm._common import stored, table
from starloom.llm._vectors import answered, askers, best_pairs, classes, first_k, matrix, packed, unpacked, usable

NEIGHBOURS = 20
TREES = 48
#: Symbols of a string, of five bits each: sixteen axes with a sign.
SYMBOLS = 12
BITS = 5
SEED = 11
#: Share of the calibration queries' true neighbours that the budget has to reach.
RECALL = 0.93
CALIBRATION = 256
#: Entries of a block, queries that meet a block in one task, vectors whose strings give the quantiles, blocks of a tree at most (then they get larger).
BLOCK_ROWS = 8192
SHARE_QUERIES = 2048
SAMPLE_ROWS = 16_384
MAX_BLOCKS = 4096
_AXES = 1 << (BITS - 1)


def subspaces(d: int, trees: int) -> np.ndarray:
    """d x (trees * SYMBOLS * 16): the axes of every symbol, orthogonal in each where d allows it."""
    rng = np.random.default_rng(SEED)
    g = rng.normal(size=(trees * SYMBOLS, d, _AXES))
    if d >= _AXES:
        g = np.linalg.qr(g)[0]
    return np.ascontiguousarray(g.transpose(1, 0, 2).reshape(d, -1), np.float32)


def strings_of(m: np.ndarray, axes: np.ndarray, trees: int) -> np.ndarray:
    """rows x trees; a string's first symbol is in the highest bits."""
    p = (m.astype(np.float32) @ axes).reshape(len(m), trees, SYMBOLS, _AXES)
    at = np.abs(p).argmax(axis=3)
    sign = np.take_along_axis(p, at[..., None], 3)[..., 0] < 0
    symbol = at.astype(np.int64) | (sign.astype(np.int64) << (BITS - 1))
    return (symbol << (BITS * np.arange(SYMBOLS - 1, -1, -1))).sum(axis=2)


def _lengthened(m: np.ndarray, norm2: float) -> np.ndarray:
    own = np.einsum("ij,ij->i", m, m)
    return np.column_stack([m, np.sqrt(np.maximum(norm2 - own, 0))])


def _with_strings(rows: DataFrame, d: int, norm2: float, trees: int, query: bool) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(subspaces(d + 1, trees))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                m = matrix(part.column("v"), d)
                code = strings_of(np.column_stack([m, np.zeros(len(m))]) if query else _lengthened(m, norm2), held.value, trees)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * trees), pa.array(code.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), packed(m), lists], ["vec_id", "vector", "strings"])

    return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, vector binary, strings array<long>")


def _shift(depth):
    return BITS * (SYMBOLS - depth)


def _block_of(bounds: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """rows x trees: in which block of its tree each string lies."""
    return np.stack([np.searchsorted(bounds[t], strings[:, t], "right") for t in range(strings.shape[1])], axis=1)


def _entries(index: DataFrame, bounds: np.ndarray, trees: int, vectors: bool) -> DataFrame:
    """(tree, block, string, vec_id), and the vector, of every entry of the forest."""
    held = index.sparkSession.sparkContext.broadcast(bounds)
    columns = ["vec_id", "strings"] + ["vector"] * vectors

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                n = part.num_rows
                code = part.column("strings").flatten().to_numpy().reshape(n, trees)
                at = pa.array(np.repeat(np.arange(n), trees))
                out = [pa.array(np.tile(np.arange(trees), n)), pa.array(_block_of(held.value, code).ravel()), pa.array(code.ravel()), part.column("vec_id").take(at)]
                yield pa.RecordBatch.from_arrays(out + [part.column(c).take(at) for c in columns[2:]], ["tree", "block", "string", "vec_id", *columns[2:]])

    return index.select(*columns).mapInArrow(run, "tree long, block long, string long, vec_id long" + ", vector binary" * vectors)


def _range_counts(index: DataFrame, asked: DataFrame, bounds: np.ndarray, sizes: np.ndarray, trees: int) -> DataFrame:
    """(vec_id, counts): how many entries, over all trees, share each number of symbols (0 to SYMBOLS) with a query."""
    spark = asked.sparkSession
    held = spark.sparkContext.broadcast((bounds, sizes))
    parts = spark.createDataFrame([(t, b, int(max(1, -(-n // BLOCK_ROWS)))) for (t, b), n in np.ndenumerate(sizes)], "tree long, block long, parts long")

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        n = right.num_rows
        if not n:
            return pa.table({"vec_id": pa.array([], pa.int64()), "counts": pa.array([], pa.list_(pa.int64()))})
        tree, block, first = right.column("tree")[0].as_py(), right.column("block")[0].as_py(), right.column("salt")[0].as_py() == 0
        bounds, sizes = held.value[0][tree], held.value[1][tree]
        own = np.sort(left.column("string").to_numpy()) if left.num_rows else np.empty(0, np.int64)
        string, found = right.column("string").to_numpy(), np.zeros((n, SYMBOLS + 1), np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for depth in range(SYMBOLS + 1):
            low = string >> _shift(depth) << _shift(depth)
            high = low + (np.int64(1) << _shift(depth))
            found[:, depth] = np.searchsorted(own, high) - np.searchsorted(own, low)
            if first:  # whole blocks on either side
                found[:, depth] += ends[block] - ends[np.minimum(np.searchsorted(bounds, low, "right"), block)]
                found[:, depth] += ends[np.maximum(np.searchsorted(bounds, high - 1, "right"), block) + 1] - ends[block + 1]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (SYMBOLS + 1)), pa.array(found.ravel()))
        return pa.table({"vec_id": right.column("vec_id"), "counts": lists})

    entries = _entries(index, bounds, trees, False).join(F.broadcast(parts), ["tree", "block"]).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.col("parts"))).drop("parts")
    asked = _entries(asked, bounds, trees, False).join(F.broadcast(parts), ["tree", "block"]).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    keys = ["tree", "block", "salt"]
    each = entries.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(solve, "vec_id long, counts array<long>")
    return each.groupBy("vec_id").agg(F.array(*[F.sum(F.col("counts")[k]) for k in range(SYMBOLS + 1)]).alias("counts"))


def ascent(counts: np.ndarray, budget: float, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """(depth, ahead) for each row of ``counts``: all trees stop at depth + 1 and the first ``ahead`` of them at depth, one tree alone at the root."""
    enough = counts >= np.minimum(budget, counts[:, :1])
    depth = counts.shape[1] - 1 - enough[:, ::-1].argmax(axis=1)
    here = counts[np.arange(len(counts)), depth].astype(float)
    deeper = np.where(depth + 1 < counts.shape[1], counts[np.arange(len(counts)), np.minimum(depth + 1, counts.shape[1] - 1)], 0)
    ahead = np.ceil(trees * np.clip((budget - deeper) / np.maximum(here - deeper, 1), 0, 1)).astype(int)
    return depth, np.where(depth == 0, 1, np.clip(ahead, 1, trees))


def _calibrated(index: DataFrame, asked: DataFrame, counts: DataFrame, k: int, trees: int, d: int, recall: float) -> float:
    """The least budget whose ranges hold the share ``recall`` of the true neighbours of the calibration queries."""
    spark = index.sparkSession
    chosen = asked.join(counts, "vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).collect()
    if not chosen:
        return 0.0
    held = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in chosen]), np.array([np.frombuffer(r["vector"]) for r in chosen])))

    def exact(batches):
        who, q = held.value
        for batch in batches:
            ids, x = batch.column("vec_id").to_numpy(), unpacked(batch.column("vector"), np.float64, d)
            code = batch.column("strings").flatten().to_numpy().reshape(len(ids), trees)
            for i in range(0, len(ids), 8192):
                scores = q @ x[i : i + 8192].T
                scores[ids[i : i + 8192] == who[:, None]] = -np.inf
                r, c = best_pairs(scores, k, 0.0)
                best = first_k(r, ids[i : i + 8192][c], scores[r, c], k)
                at = pa.array(np.arange(len(best) + 1, dtype=np.int32) * trees)
                yield pa.RecordBatch.from_arrays([pa.array(r[best]), pa.array(scores[r[best], c[best]]), pa.ListArray.from_arrays(at, pa.array(code[i:][c[best]].ravel()))], ["q", "score", "strings"])

    nth = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    near = index.mapInArrow(exact, "q long, score double, strings array<long>").withColumn("nth", nth).where(F.col("nth") <= k).collect()
    if not near:  # a query is alone in the table
        return 0.0
    q = np.array([r["q"] for r in near])
    own, other = np.array([r["strings"] for r in chosen])[q], np.array([r["strings"] for r in near])
    alike = sum(((own >> _shift(x)) == (other >> _shift(x))).astype(int) for x in range(1, SYMBOLS + 1))
    table_ = np.array([r["counts"] for r in chosen])
    total = int(table_[:, 0].max()) // trees
    for budget in np.geomspace(min(k, total), total, 120):
        depth, ahead = ascent(table_, budget, trees)
        stop = depth[q][:, None] + (np.arange(trees)[None, :] >= ahead[q][:, None])
        found = (depth[q] == 0) | ((alike >= stop) & (stop <= SYMBOLS)).any(axis=1)
        if found.mean() >= recall:
            return float(budget)
    return float(table_[:, 0].max())


def search(rows: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, trees: int = TREES, recall: float = RECALL, budget: float | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found to each of ``queries`` among ``rows``, nearest first.

    Both are (vec_id, embedding); a query's own vec_id is no candidate. The score is the inner
    product of the original vectors in double precision, ties go to the smaller vec_id. Vectors that
    are null, zero, of another length than most, or hold a null or non-finite component take no
    part. All candidates are found where there are at most k. Repeated vec_ids count as one row;
    empty tables give no rows; other columns are ignored. ``budget`` fixes how many entries a
    query's ranges hold; by default it is found from ``recall``.
    """
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = usable(rows).where(F.exists("v", lambda x: x != 0)).dropDuplicates(["vec_id"])
    facts = rows.agg(F.max("d"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    if facts[0] is None:
        return empty
    d, norm2 = facts[0], float(facts[1])
    queries = usable(queries).where((F.col("d") == d) & F.exists("v", lambda x: x != 0)).dropDuplicates(["vec_id"])
    kinds = stored(classes(rows.select("vec_id", "v"), k), "classes")
    one, members = askers(queries.select("vec_id", "v"))
    index, asked = stored(_with_strings(kinds, d, norm2, trees, False), "forest"), stored(_with_strings(one, d, norm2, trees, True), "forest")
    total = index.count()
    sample = index.select("strings").where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) <= F.lit(min(1.0, SAMPLE_ROWS / total) * (1 << 20))).toArrow().column("strings")
    sample = sample.combine_chunks().flatten().to_numpy().reshape(-1, trees)
    blocks = int(min(MAX_BLOCKS, max(1, -(-total // BLOCK_ROWS)), max(1, len(sample))))
    bounds = np.sort(sample, axis=0)[[len(sample) * b // blocks for b in range(1, blocks)]].T if blocks > 1 else np.empty((trees, 0), np.int64)
    bounds = np.ascontiguousarray(bounds)
    sizes = np.zeros((trees, blocks), np.int64)  # of trees x MAX_BLOCKS at most
    for r in _entries(index, bounds, trees, False).groupBy("tree", "block").agg(F.count("*").alias("n")).collect():
        sizes[r["tree"], r["block"]] = r["n"]
    counts = stored(_range_counts(index, asked, bounds, sizes, trees), "counts")
    if budget is None:
        budget = _calibrated(index, asked, counts, k + 1, trees, d, recall)
    held = spark.sparkContext.broadcast((bounds, float(max(budget, k + 1))))

    def probes(batches):
        bounds, budget = held.value
        for batch in batches:
            n = batch.num_rows
            code = batch.column("strings").flatten().to_numpy().reshape(n, trees)
            table_ = batch.column("counts").flatten().to_numpy().reshape(n, SYMBOLS + 1)
            depth, ahead = ascent(table_, budget, trees)
            stop = depth[:, None] + (np.arange(trees)[None, :] >= ahead[:, None])
            stop[depth == 0, 1:] = SYMBOLS + 1  # the root's one tree has everything
            low = code >> _shift(np.minimum(stop, SYMBOLS)) << _shift(np.minimum(stop, SYMBOLS))
            high = low + (np.int64(1) << _shift(np.minimum(stop, SYMBOLS)))
            for i in range(n):
                tree, begin, end = [], [], []
                for t in np.flatnonzero(stop[i] <= SYMBOLS):
                    a, b = np.searchsorted(bounds[t], low[i, t], "right"), np.searchsorted(bounds[t], high[i, t] - 1, "right")
                    tree.append(t)
                    begin.append(a)
                    end.append(b + 1)
                block = np.concatenate([np.arange(a, b) for a, b in zip(begin, end, strict=True)])
                tree = np.repeat(tree, np.subtract(end, begin))
                at = pa.array(np.full(len(tree), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(at), batch.column("vector").take(at), *[pa.array(x.astype(np.int64)) for x in (tree, block, low[i, tree], high[i, tree])]],
                    ["query_id", "query", "tree", "block", "low", "high"],
                )

    probed = stored(asked.join(counts, "vec_id").select("vec_id", "vector", "strings", "counts").mapInArrow(probes, "query_id long, query binary, tree long, block long, low long, high long"), "probes")
    # A row a block: how its entries and its queries are salted so that a task has a bounded number of either.
    parts = spark.createDataFrame([(t, b, int(max(1, -(-n // BLOCK_ROWS)))) for (t, b), n in np.ndenumerate(sizes)], "tree long, block long, parts long")
    loads = probed.groupBy("tree", "block").agg(F.ceil(F.count("*") / SHARE_QUERIES).alias("shares")).join(parts, ["tree", "block"])
    loads = F.broadcast(stored(loads, "loads"))
    entries = _entries(index, bounds, trees, True).join(loads, ["tree", "block"]).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    entries = entries.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))).drop("shares", "parts")
    probed = probed.join(loads, ["tree", "block"]).withColumn("share", F.pmod(F.xxhash64("query_id"), F.col("shares")))
    probed = probed.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("shares", "parts")

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            left = left.sort_by("string")
            string, ids, x = left.column("string").to_numpy(), left.column("vec_id").to_numpy(), unpacked(left.column("vector"), np.float64, d)
            who, q = right.column("query_id").to_numpy(), unpacked(right.column("query"), np.float64, d)
            begin, end = np.searchsorted(string, right.column("low").to_numpy()), np.searchsorted(string, right.column("high").to_numpy())
            order = np.lexsort((end, begin))
            edge = np.flatnonzero((np.diff(begin[order]) != 0) | (np.diff(end[order]) != 0)) + 1
            for group in np.split(order, edge):
                b, e = begin[group[0]], end[group[0]]
                if b == e:
                    continue
                for i in range(0, len(group), 256):
                    some = group[i : i + 256]
                    r, c = best_pairs(q[some] @ x[b:e].T, k + 1, 1e-9 * max(1.0, norm2))
                    # summed the same way for every pair, so that equal vectors tie
                    exact = np.concatenate([(q[some[r[j : j + 65536]]] * x[b + c[j : j + 65536]]).sum(axis=1) for j in range(0, len(r), 65536)])
                    best = first_k(r, ids[b + c], exact, k + 1)
                    found.append((who[some[r[best]]], ids[b + c[best]], exact[best]))
        a, b, s = (np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table({"query_id": a, "vec_id": b, "score": s})

    keys = ["tree", "block", "salt", "share"]
    found = entries.groupBy(*keys).cogroup(probed.groupBy(*keys)).applyInArrow(solve, "query_id long, vec_id long, score double")
    return answered(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), kinds, members, k)


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where(F.col("vec_id") % 20 == 0))
