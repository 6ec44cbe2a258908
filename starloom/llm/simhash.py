"""SimHash near-duplicates: exact Hamming search in BK-trees over shards of fingerprints.

Two 64-bit fingerprints that differ in at most ``radius`` bits agree on at least two of
``radius + 2`` blocks. So each *distinct* fingerprint goes to one shard for every pair of blocks
(15 for radius 4), keyed by what the two blocks hold, and any link lies inside some shard. A shard
of more than ``HOT`` fingerprints is dealt out again by ``radius + 1`` sub-blocks of the bits its
key leaves open, of which one must agree; that loses no link and leaves small shards, since
fingerprints in a shard are distinct and have to differ somewhere. In a shard a BK-tree (children
keyed by their integer distance to the parent) finds everything within the radius, and only edges
that join parts of the shard not yet joined are passed on to the connected components.

``similar_groups`` links texts by the Jaccard similarity of their shingle sets. That takes a radius at
which no block has to agree, so its shards are keyed by random choices of bits, as many as let two
fingerprints of the least similarity share a shard with the chance ``SHARED``. In a shard's BK-tree
each fingerprint finds those within ``WIDE`` bits, and of these the ones within ``BOTH`` bits of 128,
with a second fingerprint of the same shingles; they are confirmed on their whole texts. Where that
is very many, a fingerprint is first paired with few, and when the confirmed links have joined what they
join, all pairs left out there whose ends are still apart are confirmed as well.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm._common import cut, discard, key_runs, picked, stored, table, text_chunks
from starloom.llm._components import connected_components
from starloom.llm._words import word_spans

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: A shard with more fingerprints is dealt out again, so many times at most.
HOT = 256
REFINEMENTS = 2
#: Of ``similar_groups``: words, least similarity in hundredths, radius, chance of sharing a shard.
SIMILAR_WORDS = 5
SIMILAR = 80
WIDE = 18
BOTH = 36
SHARED = 0.998
#: Up to so many fingerprints within the radius each is a candidate at once; of more, the nearest and the shard's first, and the rest once these are joined.
FEW = 4


def shingle_spans(raw: np.ndarray, off: np.ndarray, words: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words joined by one space; begin and end of each shingle in them; shingles of each text."""
    flat, start, stop, n = word_spans(raw, off)
    each = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    inner = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    first = np.repeat(np.cumsum(n) - n, each) + inner
    last = first + np.repeat(np.minimum(n, words), each) - 1
    return flat.tobytes(), start[first], stop[last], each


def fingerprints_of(raw: np.ndarray, off: np.ndarray, words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    flat, begin, end, each = shingle_spans(raw, off, words)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[s:e], seed) for s, e in zip(begin.tolist(), end.tolist(), strict=True)], np.uint64)
    found = np.zeros(len(each), np.uint64)
    some = np.flatnonzero(each)
    if len(some):
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        at = (np.cumsum(each) - each)[some]
        ones = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
        found[some] = np.packbits(ones * 2 > each[some][:, None], axis=1).view(">u8")[:, 0]
    return found


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp long) of each row's whole ``text``; no words (or a null text) give 0."""

    def run(batches):
        for batch in batches:
            for i, j, raw, off in text_chunks(batch.column("text")):
                fp = fingerprints_of(raw, off, words, seed).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(fp)], ["doc_id", "fp"])

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


class BKTree:
    """Distinct 64-bit numbers; a child's key is its Hamming distance to the parent."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while (d := (node[0] ^ value).bit_count()) in node[1]:
            node = node[1][d]
        if d:
            node[1][d] = (value, {})

    def within(self, value: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            held, children = todo.pop()
            d = (held ^ value).bit_count()
            if d <= radius:
                found.append(held)
            for k, child in children.items():
                if d - radius <= k <= d + radius:
                    todo.append(child)
        return found


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that span each group of ``values`` reachable by steps of at most ``radius`` bits."""
    tree, parent, links = BKTree(), {}, []

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for v in values:
        if v in parent:
            continue
        parent[v] = v
        for u in tree.within(v, radius):
            if (a := top(u)) != (b := top(v)):
                parent[a] = b
                links.append((u, v))
        tree.add(v)
    return links


def _split(bits: list[int], parts: int) -> list[list[int]]:
    return [list(x) for x in np.array_split(np.array(bits), parts)]


def _mask(bits) -> int:
    return int(np.array(sum(1 << int(b) for b in bits), np.uint64).astype(np.int64))


def shard_masks(radius: int) -> list[list[int]]:
    """By level, the bits that shard keys look at; entry i of a level refines entry i // (radius + 1) of the one before."""
    sets = [a + b for a, b in combinations(_split(list(range(64)), radius + 2), 2)]
    levels = [sets]
    for _ in range(REFINEMENTS):
        sets = [s + part for s in sets for part in _split([b for b in range(64) if b not in s], radius + 1)]
        levels.append(sets)
    return [[_mask(s) for s in level] for level in levels]


def links(distinct: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """Edges (a, b) whose closure joins exactly the ``fp`` of ``distinct`` linked by at most ``radius`` bits."""
    levels = shard_masks(radius)

    def keyed(rows: DataFrame, level: int) -> DataFrame:
        masks = F.array(*[F.lit(m) for m in levels[level]])
        return rows.withColumn("key", F.xxhash64("set", F.col("fp").bitwiseAND(masks[F.col("set")])))

    rows = keyed(distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(len(levels[0]) - 1))).alias("set")), 0)
    ready = None
    for level in range(len(levels)):
        size = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        rows = rows.join(size, "key")
        if level == len(levels) - 1:
            cold = rows
        else:
            rows = cut(rows)
            cold = rows.where(F.col("n") <= hot)
            over = rows.where(F.col("n") > hot)
            step = F.explode(F.sequence(F.lit(0), F.lit(radius))).alias("step")
            rows = keyed(over.select("fp", "set", step).select("fp", (F.col("set") * (radius + 1) + F.col("step")).alias("set")), level + 1)
        ready = cold.select("key", "fp") if ready is None else ready.union(cold.select("key", "fp"))

    def run(batches):
        for t in key_runs(batches, "key"):
            keys = t.column("key").to_numpy()
            # two's complement keeps Hamming distances; Python's numbers have to be unsigned
            fps = t.column("fp").to_numpy().view(np.uint64).tolist()
            ends = [*(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            found, i = [], 0
            for j in ends:
                if j - i > 1:
                    found += shard_links(fps[i:j], radius)
                i = j
            if found:
                pairs = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return ready.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the least doc_id reachable over links of at most ``radius`` bits, itself
    included. Texts are read whole; equal texts share a fingerprint. Null and wordless texts have
    fingerprint 0, which links like any other. A null doc_id belongs to its component but never
    names it. Repeated rows stay repeated; an empty table gives an empty result; other columns of
    ``docs`` are ignored.
    """
    held = cut(fingerprints(docs, words))
    ids = held.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(links(ids.select("fp"), radius, hot))
    named = cut(ids.join(roots, ids.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(groups, "root").select("fp", "component_id")
    return held.join(named, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _hashed_shingles(raw: np.ndarray, off: np.ndarray, words: int) -> list[np.ndarray]:
    flat, begin, end, each = shingle_spans(raw, off, words)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[s:e], SEED) for s, e in zip(begin.tolist(), end.tolist(), strict=True)], np.uint64)
    return np.split(h, np.cumsum(each)[:-1])


def _bits(h: np.ndarray) -> int:
    """The fingerprint of a set of hashes, as a signed number."""
    ones = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h)).view(">u8")[0].astype(np.uint64).view(np.int64))


def _mixed(h: np.ndarray) -> np.ndarray:
    """Other hashes, one for each."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _named(docs: DataFrame, words: int) -> DataFrame:
    """(row, one, two, fp, more, size): the 128-bit name of a text's set of shingles, the set's two fingerprints (null: no shingle) and its size."""

    def run(batches):
        for batch in batches:
            for i, j, raw, off in text_chunks(batch.column("text")):
                sets = [np.unique(x) for x in _hashed_shingles(raw, off, words)]
                fps = [[_bits(x) if len(x) else None for x in own] for own in (sets, [_mixed(x) for x in sets])]
                held = [x.tobytes() for x in sets]
                name = [[xxhash.xxh64_intdigest(x, s) - (1 << 63) for x in held] for s in (1, 2)]
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(i, j - i), *[pa.array(x, pa.int64()) for x in (*name, *fps, map(len, sets))]], ["row", "one", "two", "fp", "more", "size"])

    return docs.select("row", "text").mapInArrow(run, "row long, one long, two long, fp long, more long, size long")


def wide_shards(rows: int, least: int) -> list[int]:
    """Masks of the bits that key a shard: about as many bits as leave a few of ``rows`` random fingerprints in one, and enough choices of them."""
    similarity = least / 100
    apart = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)  # share of bits in which two sets of that similarity differ
    bits = int(min(40, max(10, np.log2(max(rows, 2)) - 2)))
    count = int(np.ceil(np.log(1 - SHARED) / np.log(1 - (1 - apart) ** bits)))
    rng = np.random.default_rng(SEED)
    return [_mask(rng.choice(64, bits, replace=False)) for _ in range(count)]


def shard_pairs(values: list[int], more: list[int], radius: int, both: int = BOTH, few: int = FEW) -> tuple[list[tuple[int, int]], bool]:
    """Candidate pairs among distinct ``values`` with second fingerprints ``more``, each with those before it in the shard; whether these are all."""
    tree, found, first, second, whole = BKTree(), [], values[0], dict(zip(values, more, strict=True)), True
    for v in values:
        far = {u: (u ^ v).bit_count() + (second[u] ^ second[v]).bit_count() for u in tree.within(v, radius)}
        near = [u for u, d in far.items() if d <= both]
        if len(near) > few:
            near = [min(near, key=lambda u: (far[u], u)), *([first] if first in near else [])]
            whole = False
        found += [(u, v) for u in dict.fromkeys(near)]
        tree.add(v)
    return found, whole


def _alike(x: np.ndarray, y: np.ndarray, least: int) -> bool:
    """Whether two ordered sets have a Jaccard similarity of ``least`` hundredths or more."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")  # merges the two
    n = int((both[1:] == both[:-1]).sum())
    return 100 * n >= least * (len(both) - n)


def apart_links(rows: DataFrame, sets: Callable[[DataFrame], DataFrame], least: int, radius: int, both: int = BOTH, block: int = 2 * HOT, kept: Callable[[DataFrame, str], DataFrame] = stored) -> DataFrame:
    """(a, b), a < b, that join all parts of ``rows`` (key, node, fp, more, size, part) which some similar pair of nodes of one ``key`` within the radii joins.

    ``sets`` gives (row, held) of rows (row), ``kept`` stores what is read twice. Every pair of different parts is looked at, nearest first, unless
    what was found in its group joins it already, so no group gives more links than it has rows. A key of very many
    rows is dealt in blocks in the order of their parts, and each two blocks to a group; blocks of one part don't meet.
    """
    sizes = rows.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("n")).where("lo < hi").select("key", "n")
    held = kept(rows.join(sizes, "key"), "apart")
    columns = ["cell", "block", "node", "fp", "more", "size", "part"]
    ready = held.where(F.col("n") <= block).select(F.col("key").alias("cell"), F.lit(0).alias("block"), *columns[2:])
    large = held.where(F.col("n") > block)
    large = kept(large.withColumn("block", F.floor((F.row_number().over(Window.partitionBy("key").orderBy("part", "node")) - 1) / block).cast("int")), "apart")
    blocks = large.groupBy("key", "block").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    met = blocks.join(blocks.toDF("key", "other", "other_lo", "other_hi"), "key").where("block <= other AND lo < other_hi")
    met = met.select("key", F.xxhash64("key", "block", "other").alias("cell"), F.explode(F.array_distinct(F.array("block", "other"))).alias("block"))
    ready = ready.unionByName(large.join(met, ["key", "block"]).select(*columns))
    ready = ready.join(sets(held.select(F.col("node").alias("row")).distinct()).withColumnRenamed("row", "node"), "node")

    def run(batches):
        for t in key_runs(batches, "cell"):
            cells, blocks_, nodes, size, part = (t.column(c).to_numpy() for c in ("cell", "block", "node", "size", "part"))
            fp, more = (t.column(c).to_numpy().view(np.uint64) for c in ("fp", "more"))
            held, out, i = t.column("held"), [], 0
            for j in [*(np.flatnonzero(cells[1:] != cells[:-1]) + 1).tolist(), len(cells)]:
                m = i + int(np.searchsorted(blocks_[i:j], blocks_[j - 1]))
                x, y = (slice(i, m), slice(m, j)) if m > i else (slice(i, j), slice(i, j))
                across = lambda c: (c[x][:, None], c[y])  # noqa: B023, E731
                far = np.bitwise_count(np.bitwise_xor(*across(fp)))
                good = (far <= radius) & np.not_equal(*across(part))
                far = far + np.bitwise_count(np.bitwise_xor(*across(more)))
                good &= (far <= both) & (100 * np.minimum(*across(size)) >= least * np.maximum(*across(size)))
                a, b = np.nonzero(good if m > i else np.triu(good, 1))
                order = np.argsort(far[a, b], kind="stable")
                parent: dict[int, int] = {}
                seen: dict[int, np.ndarray] = {}

                def top(p: int) -> int:
                    while (q := parent.setdefault(p, p)) != p:  # noqa: B023
                        parent[p] = p = parent[q]  # noqa: B023
                    return p

                def hashes(k: int) -> np.ndarray:
                    if k not in seen:  # noqa: B023
                        seen[k] = np.frombuffer(held[k].as_buffer(), np.uint64)  # noqa: B023
                    return seen[k]  # noqa: B023

                for u, v in zip((a[order] + x.start).tolist(), (b[order] + y.start).tolist(), strict=True):
                    p, q = top(int(part[u])), top(int(part[v]))
                    if p != q and _alike(hashes(u), hashes(v), least):
                        parent[p] = q
                        out.append(sorted((int(nodes[u]), int(nodes[v]))))
                i = j
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    return ready.repartition("cell").sortWithinPartitions("cell", "block").mapInArrow(run, "a long, b long")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(row, held binary): the distinct hashes of each text's shingles, in order."""

    def run(batches):
        for batch in batches:
            for i, j, raw, off in text_chunks(batch.column("text")):
                held = [np.unique(x).tobytes() for x in _hashed_shingles(raw, off, words)]
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(i, j - i), pa.array(held, pa.binary())], ["row", "held"])

    return docs.select("row", "text").mapInArrow(run, "row long, held binary")


def similar_pairs(sets: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose ``sets`` (row, held) have a Jaccard similarity of ``least`` hundredths or more."""

    def confirm(batches):
        for batch in batches:
            good = []
            for k, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                if _alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), least):
                    good.append(k)
            if good:
                at = pa.array(good, pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], ["a", "b"])

    x, y = sets.toDF("a", "x"), sets.toDF("b", "y")
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(confirm, "a long, b long")


def similar_groups(docs: DataFrame, words: int = SIMILAR_WORDS, least: int = SIMILAR, radius: int = WIDE) -> DataFrame:
    """(row, part) for every row of ``docs`` (row long, text): rows linked by a similarity of ``least`` hundredths or more share a part.

    Texts of equal shingle sets are one node, null and wordless texts are one part. ``row`` has to be
    unique and the same each time ``docs`` is read; an empty table gives no rows. A link is exact; a
    pair of the least similarity is looked at with a chance of ``SHARED`` times that of lying within the radius.
    """
    steps: list[DataFrame] = []

    def kept(df: DataFrame, kind: str) -> DataFrame:
        """``df`` stored until the parts are."""
        steps.append(stored(df, kind))
        return steps[-1]

    held = stored(_named(docs, words), "shingles")
    nodes = kept(held.groupBy("one", "two").agg(F.min("row").alias("node"), *[F.min(c).alias(c) for c in ("fp", "more", "size")]), "shingles")
    # Sets of one fingerprint: all against the first of them, and the first stands for them in its shards.
    prints = nodes.where("fp IS NOT NULL").groupBy("fp").agg(F.min(F.struct("node", "more")).alias("least"), F.count("*").alias("n")).select("fp", "least.*", "n")
    prints = kept(prints, "prints")
    same = nodes.join(prints.where("n > 1").select("fp", F.col("node").alias("a")), "fp").where("node > a").select("a", F.col("node").alias("b"))
    masks = wide_shards(prints.count(), least)
    mask = F.array(*[F.lit(m) for m in masks])

    def keyed(rows: DataFrame) -> DataFrame:
        each = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("set"))
        return each.withColumn("key", F.xxhash64("set", F.col("fp").bitwiseAND(mask[F.col("set")]))).drop("set")

    shards = keyed(prints.select("fp", "more"))
    shared = kept(shards.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").withColumn("parts", F.ceil(F.col("n") / (4 * HOT))), "shards")
    # A shard of very many is divided by the fingerprints' order of bits at first, so that near ones mostly stay together.
    # Merged: Spark takes the exploded shards for as small as the fingerprints and would broadcast them.
    ready = shards.join(shared.hint("merge"), "key").withColumn("key", F.when(F.col("parts") > 1, F.xxhash64("key", F.pmod(F.shiftrightunsigned("fp", 44), F.col("parts")))).otherwise(F.col("key"))).select("key", "fp", "more")

    def run(batches):
        for t in key_runs(batches, "key"):
            keys, fps, more = t.column("key").to_numpy(), *(t.column(c).to_numpy().view(np.uint64).tolist() for c in ("fp", "more"))
            found, left, i = [], [], 0
            for j in [*(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]:
                if j - i > 1:
                    pairs, whole = shard_pairs(fps[i:j], more[i:j], radius)
                    found += pairs
                    left += [] if whole else [int(keys[i])]
                i = j
            if found:
                pairs = np.unique(np.array(found, np.uint64), axis=0).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])
            if left:  # the shard's key, and no partner
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.nulls(len(left), pa.int64())], ["u", "v"])

    near = kept(ready.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "u long, v long").distinct(), "near")
    at = prints.select("fp", "node")
    pairs = near.join(at.toDF("u", "a"), "u").join(at.toDF("v", "b"), "v").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = kept(pairs.union(same), "pairs")

    def sets(rows: DataFrame) -> DataFrame:
        return kept(shingle_sets(picked(docs.select("row", "text"), kept(rows, "wanted")), words), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        before = len(steps)
        found = stored(similar_pairs(sets(pairs.select("a").union(pairs.select("b")).distinct().toDF("row")), pairs, least), "links")
        discard(*steps[before:])
        steps[before:] = [found]
        return found

    def parted(links: DataFrame) -> DataFrame:
        return stored(nodes.join(connected_components(links), "node", "left").withColumn("part", F.coalesce("root", "node")).drop("root"), "parts")

    named = parted(confirmed(pairs))
    # What was left out: shards with very many near ones, divided shards, and sets that another of their fingerprint stood for.
    keys = kept(near.where("v IS NULL").select(F.col("u").alias("key")).union(shared.where("parts > 1").select("key")).distinct(), "keys")
    several = kept(prints.where("n > 1").select("fp"), "several")
    rest = []
    if not keys.isEmpty():
        crowded = keyed(named.where("fp IS NOT NULL").select("node", "fp", "more", "size", "part")).join(keys, "key", "left_semi")
        before = len(steps)
        rest.append(stored(apart_links(crowded, sets, least, radius, kept=kept).distinct(), "links"))
        discard(*steps[before:])
        steps[before:] = rest
    if not several.isEmpty():
        near = near.where("v IS NOT NULL")
        standing = near.join(several.toDF("u"), "u", "left_semi").unionByName(near.join(several.toDF("v"), "v", "left_semi")).distinct().unionByName(several.select(F.col("fp").alias("u"), F.col("fp").alias("v")))
        one = named.select(F.col("fp").alias("u"), F.col("node").alias("a"), F.col("part").alias("p"))
        both = standing.join(one, "u").join(one.toDF("v", "b", "q"), "v").where("a <> b AND p <> q").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        rest.append(confirmed(kept(both.distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")))
    if any(not x.isEmpty() for x in rest):
        steps.append(named)  # its parts are stars, which the rest joins
        named = parted(reduce(DataFrame.unionByName, rest, named.where("node <> part").select(F.col("node").alias("a"), F.col("part").alias("b"))))
    discard(*steps)
    return held.select("row", "one", "two").join(named.select("one", "two", "part"), ["one", "two"]).select("row", "part")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "fingerprint", "component_id")
