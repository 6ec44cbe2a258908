"""Exact substring dedup: bytes covered by a ``min_bytes`` string that starts twice are removed.

A full suffix array of the corpus would order every byte. Here only suffixes at *anchors* are
ordered: each window of ``min_bytes`` bytes picks, among its first half's places, the one whose
next eight bytes hash least, so equal windows pick the same anchor. All windows of an anchor hold
a common *core*; they lie in its *context*.

1. Anchors of the same context in a row, as in periodic text, become two. Anchors whose core occurs once are dropped: no window of theirs can repeat. Counting cores is a
   plain aggregation, and what is left is stored.
2. Equal contexts are counted together, so copies of any number weigh as one row. A context that
   occurs twice repeats in whole.
3. Where a core has different contexts, their suffixes from the core on are ordered by deep-shallow
   sorting: a multikey quicksort over eight-byte letters to ``SHALLOW`` bytes, then a blind trie
   for each group that is still tied, which also yields the longest common prefixes. Going outward
   from a suffix in that order, a neighbour that shares r bytes to the right and l to the left of
   the core's start repeats those l + r bytes if they are ``min_bytes`` at least.
4. A core with more than ``HOT`` different contexts doesn't go to one task: its windows are divided
   into ranges with longer cores and steps 1 to 4 apply to these; with one window a range, context
   and core are the same and nothing is left to order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm._common import key_runs, stored, table, text_chunks

MIN_BYTES = 400
HOT = 256
PARTS = 8
SHALLOW = 16

_PLACE_BITS = np.uint64(31)
_RNG = np.random.default_rng(20)
_LETTERS = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(which: int, inverse: bool, n: int) -> np.ndarray:
    held = _powers.get((which, inverse))
    if held is None or len(held) < n:
        base = pow(_BASE[which], -1, 2**64) if inverse else _BASE[which]
        steps = np.full(max(n, 1 << 21), base, np.uint64)
        steps[0] = 1
        held = _powers[which, inverse] = np.multiply.accumulate(steps)
    return held[:n]


class _Hash:
    """Polynomial hashes modulo 2**64 of any substring of ``raw``."""

    def __init__(self, raw: np.ndarray, which: int) -> None:
        self.which = which
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_LETTERS[which][raw] * _power(which, False, len(raw)), out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * _power(self.which, True, len(self.sums))[begin]


def find_anchors(raw: np.ndarray, off: np.ndarray, length: int) -> np.ndarray:
    """Places in ``raw`` that some window of ``length`` bytes inside one text picks."""
    n, half = len(raw), length // 2
    if n < length:
        return np.empty(0, np.int64)
    padded = np.concatenate([raw, np.zeros(16, np.uint8)])
    word = np.empty((n // 8 + 1) * 8, np.uint64)
    for k in range(8):
        word[k::8] = padded[k : k + (n // 8 + 1) * 8].view("<u8")
    key = word[:n] * np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    key = (key >> _PLACE_BITS << _PLACE_BITS) | np.arange(n, dtype=np.uint64)
    blocks = np.full(-(-n // half) * half + half, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = key
    grid = blocks.reshape(-1, half)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[:n], before[half - 1 : half - 1 + n])
    edge = np.zeros(n + 1, np.int32)
    whole = np.diff(off) >= length
    np.add.at(edge, off[:-1][whole], 1)
    np.add.at(edge, off[1:][whole] - length + 1, -1)
    chosen = np.zeros(n, bool)
    chosen[(least[np.cumsum(edge[:n]) > 0] & np.uint64((1 << 31) - 1)).astype(np.int64)] = True
    return np.flatnonzero(chosen)


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """(core, context, row, pos, lo, hi) for each anchor of ``docs`` (row, text); places are bytes from the text's start."""
    half = length // 2

    def run(batches):
        for batch in batches:
            for i, j, raw, off in text_chunks(batch.column("text")):
                at = find_anchors(raw, off, length)
                if not len(at):
                    continue
                doc = np.searchsorted(off, at, "right") - 1
                pos = at - off[doc]
                lo = np.maximum(pos - (half - 1), 0)
                hi = np.minimum(pos + length, np.diff(off)[doc])
                core = _Hash(raw, 0).of(at, at + length - half + 1)
                context = _Hash(raw, 1).of(off[doc] + lo, off[doc] + hi) ^ (pos - lo).astype(np.uint64)
                # In periodic text one context follows another unchanged: a run's ends stand for it, the
                # last one for all its bytes, which repeat whatever other texts hold.
                same = (doc[1:] == doc[:-1]) & (core[1:] == core[:-1]) & (context[1:] == context[:-1])
                before, after = np.concatenate([[False], same]), np.concatenate([same, [False]])
                begin = np.maximum.accumulate(np.where(before, 0, np.arange(len(at))))
                lo = np.where(after, lo, lo[begin])
                keep = ~(before & after)
                doc, pos, lo, hi, core, context = (x[keep] for x in (doc, pos, lo, hi, core, context))
                row = batch.column("row").to_numpy()[i:j][doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(context.view(np.int64)), pa.array(row), *[pa.array(x.astype(np.int32)) for x in (pos, lo, hi)]],
                    ["core", "context", "row", "pos", "lo", "hi"],
                )

    return docs.select("row", "text").mapInArrow(run, "core long, context long, row long, pos int, lo int, hi int")


def settle(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans of contexts that occur twice, and one row of each context whose core has others too, with their number ``kinds``.

    ``rows`` weigh ``n``: one with n over 1 was settled before and only stands for its partners.
    """
    # Stored sums: a join with a scan can be split where one core has very many contexts or places.
    groups = stored(rows.groupBy("core", "context").agg(F.sum("n").alias("all"), F.min(F.struct("row", "pos")).alias("first")), "groups")
    repeated = groups.where(F.col("all") > 1).select("core", "context")
    spans = rows.where("n = 1").join(repeated, ["core", "context"], "left_semi").select("row", "lo", "hi")
    kinds = stored(groups.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1"), "groups")
    first = groups.join(kinds, "core").select("core", "context", F.col("all").alias("n"), "first.row", "first.pos", "kinds")
    return spans, first


def contexts(first: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """``first`` with the context's bytes, where its first window begins (``lo``) and where its core does (``start``)."""
    half = length // 2
    wanted = first.groupBy("row").agg(F.collect_list(F.struct("core", "context", "n", "pos", "kinds")).alias("wanted"))

    def run(batches):
        for batch in batches:
            texts, rows = batch.column("text"), batch.column("row").to_numpy()
            out: list[tuple] = []
            for k, wants in enumerate(batch.column("wanted")):
                text = texts[k].as_py().encode()
                for w in wants.as_py():
                    lo, hi = max(w["pos"] - (half - 1), 0), min(w["pos"] + length, len(text))
                    out.append((w["core"], w["context"], w["n"], int(rows[k]), w["pos"], lo, hi, w["pos"], half - 1, w["kinds"], text[lo:hi]))
                if len(out) > 5000:
                    yield _context_batch(out)
                    out = []
            if out:
                yield _context_batch(out)

    return wanted.join(docs, "row").select("row", "text", "wanted").mapInArrow(run, _CONTEXT)


_CONTEXT = "core long, context long, n long, row long, pos int, lo int, hi int, start int, reach int, kinds long, bytes binary"


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32()] * 5 + [pa.int64(), pa.binary()]
    names = [c.split()[0] for c in _CONTEXT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def divide(rows: DataFrame, length: int) -> DataFrame:
    """Each context as up to ``PARTS`` shorter ones whose cores hold a part of its windows.

    A row's windows begin at ``start`` - d for d from 0 to ``reach``, so far as they lie in lo to hi.
    """

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                text, base = r["bytes"], r["lo"]
                width = -(-(r["reach"] + 1) // PARTS)
                for x in range(0, r["reach"] + 1, width):
                    y = min(x + width - 1, r["reach"])
                    start = r["start"] - x
                    lo, hi = max(r["start"] - y, r["lo"]), min(start + length, r["hi"])
                    if hi - lo < length or start < r["lo"]:
                        continue
                    core = text[start - base : r["start"] - y + length - base]
                    part = text[lo - base : hi - base]
                    # two anchors may share windows: a window only counts as its own anchor's
                    away = (r["pos"] - start) << 32
                    key = xxhash.xxh3_64_intdigest(core, seed=away + y - x) - 2**63
                    own = xxhash.xxh3_64_intdigest(part, seed=away + start - lo) - 2**63
                    out.append((key, own, r["n"], r["row"], r["pos"], lo, hi, start, y - x, 0, part))
            if out:
                yield _context_batch(out)

    return rows.mapInArrow(run, _CONTEXT)


class BlindTrie:
    """Strings by the places where they branch only; inner nodes are (depth, children by byte; -1: it ends there)."""

    def __init__(self, strings: list[bytes]) -> None:
        self.strings = strings
        self.root: tuple[int, dict] | list[int] | None = None

    def _shared(self, a: int, b: int) -> int:
        x, y = self.strings[a], self.strings[b]
        n = min(len(x), len(y))
        differ = int.from_bytes(x[:n]) ^ int.from_bytes(y[:n])
        return n - (differ.bit_length() + 7) // 8

    def add(self, new: int) -> None:
        if self.root is None:
            self.root = [new]
            return
        text, path, node = self.strings[new], [], self.root
        while isinstance(node, tuple):
            path.append(node)
            depth, children = node
            letter = text[depth] if depth < len(text) else -1
            node = children.get(letter) or next(iter(children.values()))
        shared = self._shared(node[0], new)
        other = self.strings[node[0]]
        if shared == len(text) == len(other):
            node.append(new)
            return
        letter = text[shared] if shared < len(text) else -1
        above = None
        for step in path:
            if step[0] >= shared:
                break
            above = step
        below = self.root if above is None else above[1][text[above[0]] if above[0] < len(text) else -1]
        if isinstance(below, tuple) and below[0] == shared:
            below[1][letter] = [new]
            return
        split = (shared, {(other[shared] if shared < len(other) else -1): below, letter: [new]})
        if above is None:
            self.root = split
        else:
            above[1][text[above[0]] if above[0] < len(text) else -1] = split

    def walk(self) -> Iterator[tuple[int, int]]:
        """Each string in order, with the length it shares with the one before it."""
        todo, first = [(self.root, 0)], True
        while todo:
            node, shared = todo.pop()
            if isinstance(node, tuple):
                depth, children = node
                order = sorted(children)
                todo += [(children[c], shared if k == 0 else depth) for k, c in reversed(list(enumerate(order)))]
            else:
                for k, s in enumerate(node):
                    yield s, 0 if first else (shared if k == 0 else len(self.strings[s]))
                    first = False


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Order of ``strings`` and the length that each shares with the one before it in that order."""
    depth = -(-shallow // 8)
    head = np.zeros((len(strings), depth * 8), np.uint8)
    for k, s in enumerate(strings):
        part = s[: depth * 8]
        head[k, : len(part)] = np.frombuffer(part, np.uint8)
    letters = head.view(">u8").astype(np.uint64)
    groups: list[np.ndarray] = []
    todo = [(np.arange(len(strings)), 0)]
    while todo:
        rows, d = todo.pop()
        if len(rows) == 1 or d == depth:
            groups.append(rows)
            continue
        values = letters[rows, d]
        pivot = np.partition(values, len(values) // 2)[len(values) // 2]
        less, same = values < pivot, values == pivot
        for part, at in ((rows[~(less | same)], d), (rows[same], d + 1), (rows[less], d)):
            if len(part):
                todo.append((part, at))
    order, shared = [], []
    for rows in groups:
        trie = BlindTrie(strings)
        for r in rows.tolist():
            trie.add(r)
        for r, n in trie.walk():
            order.append(r)
            shared.append(n)
        if len(order) > len(rows):
            k = len(order) - len(rows)
            shared[k] = trie._shared(order[k - 1], order[k])
    return order, shared


def _left_shared(left: list[int], size: list[int], i: int, j: int) -> int:
    """Bytes before the core that two texts share; the byte next to it is the most significant one of a text's number."""
    n = min(size[i], size[j])
    differ = (left[i] >> 8 * (size[i] - n)) ^ (left[j] >> 8 * (size[j] - n))
    return n - (differ.bit_length() + 7) // 8


def _left_most(lefts: list[bytes], left: list[int], size: list[int], cores: list[int]) -> list[int]:
    """The most bytes before its core that each text shares with another of its core: with a neighbour, read backwards."""
    back = [x[::-1] for x in lefts]
    order = sorted(range(len(lefts)), key=lambda i: (cores[i], back[i]))
    most = [0] * len(lefts)
    for i, j in zip(order, order[1:]):
        if cores[i] == cores[j]:
            n = _left_shared(left, size, i, j)
            most[i], most[j] = max(most[i], n), max(most[j], n)
    return most


def repeats(lefts: list[bytes], rights: list[bytes], cores: list[int], ask: list[bool], length: int) -> list[list[tuple[int, int]]]:
    """For each asked string, (bytes left, bytes right) of the core's start that it shares with another of its core and that make ``length``.

    A string's walk to its neighbours ends where what they share to the right can't make ``length``
    with the most that it shares to the left with any, or where no more can be gained to the left.
    """
    order, shared = deep_shallow(rights)
    left, size = [int.from_bytes(x, "little") for x in lefts], [len(x) for x in lefts]
    most = _left_most(lefts, left, size, cores)
    found: list[list[tuple[int, int]]] = [[] for _ in lefts]
    for k, i in enumerate(order):
        if not ask[i]:
            continue
        for step in (1, -1):
            r, at = len(rights[i]), k
            while True:
                r = min(r, shared[at + 1] if step > 0 and at + 1 < len(order) else shared[at] if step < 0 else 0)
                at += step
                if not 0 <= at < len(order) or r < length - most[i]:
                    break
                j = order[at]
                if cores[i] != cores[j]:
                    continue
                same = _left_shared(left, size, i, j)
                if same + r >= length:
                    found[i].append((same, r))
                    if same == most[i]:
                        break
    return found


def ordered_spans(rows: DataFrame, length: int) -> DataFrame:
    """(row, lo, hi) of the bytes that contexts with the same core repeat, by suffix order."""

    def run(batches):
        for t in key_runs(batches, "core"):
            texts, core = t.column("bytes").to_pylist(), t.column("core").to_numpy()
            start, lo, row, n = (t.column(c).to_numpy() for c in ("start", "lo", "row", "n"))
            cut = (start - lo).tolist()
            lefts = [x[:c] for x, c in zip(texts, cut, strict=True)]
            rights = [x[c:] for x, c in zip(texts, cut, strict=True)]
            out = []
            ends = [*(np.flatnonzero(core[1:] != core[:-1]) + 1).tolist(), len(core)]
            begin = 0
            for k, end in enumerate(ends):
                # several cores are ordered at once
                if end - begin < 512 and k + 1 < len(ends):
                    continue
                for i, spans in enumerate(repeats(lefts[begin:end], rights[begin:end], core[begin:end].tolist(), (n[begin:end] == 1).tolist(), length), begin):
                    out += [(int(row[i]), int(start[i]) - a, int(start[i]) + b) for a, b in _merged(spans)]
                begin = end
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32()), strict=True)], ["row", "lo", "hi"])

    return rows.repartition("core").sortWithinPartitions("core").mapInArrow(run, "row long, lo int, hi int")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of the (left, right) reaches that no other contains."""
    kept: list[tuple[int, int]] = []
    for a, b in sorted(set(spans), reverse=True):
        if not kept or b > kept[-1][1]:
            kept.append((a, b))
    return kept


def repeated_spans(docs: DataFrame, length: int = MIN_BYTES, hot: int = HOT) -> DataFrame:
    """(row, lo, hi): pieces, perhaps overlapping, that together are all bytes to remove from ``docs`` (row, text)."""
    found = stored(anchors(docs, length), "anchors")
    cores = stored(found.groupBy("core").agg(F.count("*").alias("times")).where("times > 1").select("core"), "cores")
    rows = stored(found.join(cores, "core").withColumn("n", F.lit(1).cast("long")), "anchors")
    spans, first = settle(rows)
    left = stored(contexts(first, docs, length), "contexts")
    while True:
        spans = spans.union(ordered_spans(left.where(F.col("kinds") <= hot), length))
        over = left.where(F.col("kinds") > hot)
        if over.isEmpty():
            return spans
        parts = stored(divide(over, length), "contexts")
        more, first = settle(parts)
        spans = spans.union(more)
        left = stored(parts.drop("n", "kinds").join(first, ["core", "context", "row", "pos"]).select(parts.columns), "contexts")


def dedup_substrings(docs: DataFrame, length: int = MIN_BYTES, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for each row of ``docs`` (doc_id, text).

    Every byte is removed that some string of ``length`` bytes covers which also starts elsewhere,
    in the same text or another; strings may overlap, never cross texts, and are judged on the input.
    ``kept`` is what is left, as bytes (a cut may fall inside a character). A null text is empty.
    Repeated rows and equal doc_ids are texts of their own, so both lose what they share; an empty
    table gives no rows; other columns are ignored. ``docs`` has to be a table scan: its rows are
    told apart by their place in it.
    """
    if length < 16:
        raise ValueError("length has to be 16 at least")
    docs = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    spans = repeated_spans(docs.select("row", "text").where(F.octet_length("text") >= length), length, hot)
    spans = spans.groupBy("row").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            spans_ = batch.column("spans")
            off_s, lo_s, hi_s = spans_.offsets.to_numpy(), spans_.values.field("lo").to_numpy(), spans_.values.field("hi").to_numpy()
            for i, j, raw, off in text_chunks(batch.column("text")):
                facts = []
                for k in range(i, j):
                    text = raw[off[k - i] : off[k - i + 1]]
                    a, b = (off_s[k], off_s[k + 1]) if spans_[k].is_valid else (0, 0)
                    gone = np.zeros(len(text) + 1, np.int32)
                    np.add.at(gone, lo_s[a:b], 1)
                    np.add.at(gone, hi_s[a:b], -1)
                    out = np.cumsum(gone[:-1]) > 0
                    kept = text[~out].tobytes() if b > a else text.tobytes()
                    runs = int(out[:1].sum() + (out[1:] & ~out[:-1]).sum())
                    facts.append((len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), *[pa.array(c, t) for c, t in zip(zip(*facts, strict=True), kinds, strict=True)]],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
                )

    return docs.join(spans, "row", "left").select("doc_id", "text", "spans").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).drop("kept")
