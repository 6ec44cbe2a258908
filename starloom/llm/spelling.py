"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

1. Two words are one edit apart where one of length L and one of length L or L + 1 differ at a single
   place e, the length of their common prefix. For a window [a, b) of places, such words share their
   first a and their last L - b code points. A word joins the groups that share this key, for both
   values of L it can have and for both halves of the places 0..L, so every pair has exactly one group.
2. A group of over ``GROUP_WORDS`` words halves its window, until groups are small or the window is one
   place, where the group's words differ in one code point only. No group is cut off.
3. In a group only what stands inside the window is compared. The list is sorted, so words of a common
   prefix are a range; the banded row of the edit matrix for a prefix is worked out once for its range
   and split where the adjacent common prefixes end. A range whose row exceeds one edit everywhere is
   skipped. All queries of many groups go through a depth of their lists at a time.
4. A word's partners are summed up inside the group: only counts and the best partner leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm._common import key_runs, stored, table

LEAST_LENGTH = 5
LEAST_COUNT = 3
GROUP_WORDS = 4096
#: A form has to be so many times as frequent as its variant.
RATIO = 2
#: Code points of words that a task compares at a time, unless one group alone has more.
CELLS = 1 << 17
WORD = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, change: Column | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of ``least_length`` code points and ``least_count`` occurrences in all texts, A-Z lower-cased.

    ``change`` is an expression of ``run``, a word as it stands in the text, and the columns of ``docs``,
    and gives the word to count, never a longer one. A null or empty text has no words.
    """
    runs = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    each = docs.select("*", F.explode(F.filter(runs, lambda x: F.length(x) >= least_length)).alias("run"))
    words = each.select((F.col("run") if change is None else change).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` (word, n, shorter, a, b) with the key of their window and what stands in it."""
    m = F.length("word")
    tail = F.col("shorter") - F.col("b")
    inner = F.substring("word", F.col("a") + 1, m - F.greatest(tail, F.lit(0)) - F.col("a"))
    key = F.concat_ws(" ", "a", "b", F.substring("word", F.lit(1), F.col("a")), F.when(tail > 0, F.substring("word", m - tail + 1, tail)).otherwise(""))
    return rows.select("word", "n", "shorter", "a", "b", key.alias("key"), inner.alias("inner"))


def _windows(rows: DataFrame) -> DataFrame:
    """Both halves of each row's window."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    halves = F.array(F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b").alias("b")))
    return _keyed(rows.select("word", "n", "shorter", F.explode(halves).alias("h")).select("word", "n", "shorter", "h.*"))


def _grouped(words: DataFrame, group_words: int) -> DataFrame:
    """(shorter, key, word, n, b, a, inner): every word in its groups, none of which is both large and divisible."""
    m = F.length("word")
    start = words.select("word", "n", F.explode(F.array(m, m - 1)).alias("shorter")).where("shorter > 0")
    now = _windows(start.select("*", F.lit(0).alias("a"), (F.col("shorter") + 1).alias("b")))
    small = None
    while True:
        large = stored(now.groupBy("shorter", "key").agg(F.count("*").alias("size"), F.max(F.col("b") - F.col("a")).alias("width")).where((F.col("size") > group_words) & (F.col("width") > 1)).select("shorter", "key"), "spelling")
        if large.isEmpty():
            return now if small is None else small.unionByName(now)
        kept = now.join(large, ["shorter", "key"], "left_anti").select(now.columns)
        small = kept if small is None else small.unionByName(kept)
        now = stored(_windows(now.join(large, ["shorter", "key"], "left_semi").select("word", "n", "shorter", "a", "b")), "spelling")


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as rows of code points, padded with 0, and their lengths."""
    size = np.array([len(t) for t in texts])
    wide = int(size.max()) + 2 if len(size) else 2
    return np.array(texts, f"U{wide}").view(np.uint32).reshape(len(texts), wide), size


def near_pairs(group: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (query, found) of equal ``group`` and edit distance 1, in both directions.

    ``texts`` are sorted inside each group, different there, and groups are contiguous.
    """
    count = len(texts)
    none = np.zeros(0, np.int64)
    if count < 2:
        return none, none
    letters, size = _code_points(texts)
    same = letters[1:] == letters[:-1]
    shared = np.where(same.all(1), letters.shape[1], same.argmin(1))
    common = np.concatenate([[-1], np.where(group[1:] == group[:-1], np.minimum(shared, np.minimum(size[1:], size[:-1])), -1)])
    # ranges of a common prefix of the present depth, by their first word; a row is (one letter behind, on, ahead of the diagonal)
    starts = np.flatnonzero(common < 0)
    query = np.arange(count)
    at = np.cumsum(common < 0) - 1
    row = np.tile(np.array([2, 0, 1], np.int8), (count, 1))
    row[size == 0, 2] = 2
    out = []
    for depth in range(int(size.max()) + 1):
        # words that end here
        ends = size[starts[at]] == depth
        ahead = size[query] - depth + 1
        fits = ends & (ahead >= 0) & (ahead <= 2)
        hit = np.flatnonzero(fits)
        hit = hit[row[hit, ahead[hit]] == 1]
        out.append((query[hit], starts[at[hit]]))
        # ranges one letter deeper
        deeper = np.flatnonzero((common <= depth) & (size > depth))
        bounds = np.searchsorted(deeper, np.append(starts, count))
        n = (bounds[1:] - bounds[:-1])[at]
        parent = np.repeat(np.arange(len(at)), n)
        if not len(parent):
            break
        child = np.arange(len(parent)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[:-1][at], n)
        query, old = query[parent], row[parent]
        letter = letters[deeper[child], depth]
        length = size[query]
        mine = lambda k: np.where((k >= 0) & (k < length), letters[query, np.clip(k, 0, letters.shape[1] - 1)], 0)  # noqa: B023, E731
        new = np.empty_like(old)
        new[:, 0] = np.minimum(old[:, 0] + (letter != mine(np.full(len(query), depth - 1))), old[:, 1] + 1)
        new[:, 1] = np.minimum(np.minimum(old[:, 1] + (letter != mine(np.full(len(query), depth))), old[:, 2] + 1), new[:, 0] + 1)
        new[:, 2] = np.minimum(old[:, 2] + (letter != mine(np.full(len(query), depth + 1))), new[:, 1] + 1)
        for k in range(3):
            new[depth + k > length, k] = 2
        new = np.minimum(new, 2)
        alive = np.flatnonzero(new.min(1) <= 1)
        query, row, at, starts = query[alive], new[alive], child[alive], deeper
    a, b = (np.concatenate(x) for x in zip(*out, strict=True))
    return a, b


def _partners(rows: pa.Table) -> pa.RecordBatch:
    """(word, n_near, form_n, form) of each word of whole groups that has a partner there."""
    words, inner = rows.column("word").to_pylist(), rows.column("inner").to_pylist()
    n, shorter, first, last = (rows.column(c).to_numpy() for c in ("n", "shorter", "a", "b"))
    q, p = near_pairs(rows.column("group").to_numpy(), inner)
    long = np.array([len(w) for w in words]) > shorter
    letters, _ = _code_points(inner)
    prefix = (letters[q] != letters[p]).argmax(1)
    good = ~(long[q] & long[p]) & (first[q] + prefix < last[q])
    q, p = q[good], p[good]
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    turn = np.lexsort((place[p], -n[p], q))
    q, p = q[turn], p[turn]
    who, at, count = np.unique(q, return_index=True, return_counts=True)
    best = p[at]
    return pa.RecordBatch.from_arrays([pa.array([words[i] for i in who], pa.string()), pa.array(count), pa.array(n[best]), pa.array([words[i] for i in best], pa.string())], ["word", "n_near", "form_n", "form"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups, as many at a time as ``CELLS`` allows, of one length each."""
    for run in key_runs(batches, "group"):
        group, size = run.column("group").to_numpy(), run.column("shorter").to_numpy() + 1
        edge = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
        begin = 0
        for k in range(1, len(edge)):
            i, done = edge[begin], k == len(edge) - 1
            if done or size[edge[k]] != size[i] or (edge[k + 1] - i) * size[i] > CELLS:
                yield _partners(run.slice(i, edge[k] - i))
                begin = k


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n_near, form_n, form): of the different ``words`` (word, n) those with a word one edit away.

    ``n_near`` counts these, ``form`` is the one of largest n (ties: the first in code-point order) and ``form_n`` its n.
    """
    rows = _grouped(words, group_words)
    # equal keys lie together; a number for each group, as a task sees them, keeps groups of one length together
    dealt = rows.repartition("shorter", "key").sortWithinPartitions("shorter", "key", "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scan(_numbered(batches))

    found = dealt.select("shorter", "key", "word", "n", "a", "b", "inner").mapInArrow(run, "word string, n_near long, form_n long, form string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("w"))).alias("best"))
    return best.select("word", "n_near", (-F.col("best.n")).alias("form_n"), F.col("best.w").alias("form"))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, number = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, size = batch.column("key").dictionary_encode().indices.to_numpy(), batch.column("shorter").to_numpy()
        new = np.concatenate([[last is not None and last != (batch.column("key")[0].as_py(), int(size[0]))], (keys[1:] != keys[:-1]) | (size[1:] != size[:-1])])
        group = number + np.cumsum(new)
        number, last = int(group[-1]), (batch.column("key")[-1].as_py(), int(size[-1]))
        yield batch.append_column("group", pa.array(group))


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of ``links`` (word, root): each followed to the last, twice as far in every round."""
    now = stored(links, "spelling")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stored(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling")
        now = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return now


def spelling_variants(words: DataFrame, ratio: int = RATIO, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each of the different ``words`` (word, n).

    ``n_near`` counts the words that differ by one inserted, deleted or replaced code point. ``form`` is
    the most frequent of them (ties: the first in code-point order) if it is ``ratio`` times as frequent
    as the word, which has to be over 1, so that ``root``, where following forms ends, exists. Words
    without a form are their own root. No words give no rows.
    """
    words = stored(words.select("word", F.col("n").cast("long").alias("n")), "spelling")
    near = near_words(words, group_words)
    both = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("form_n"), F.lit(None).cast("string").alias("form"))
    both = both.unionByName(near.select("word", F.lit(None).cast("long").alias("n"), "n_near", "form_n", "form"))
    each = both.groupBy("word").agg(*[F.max(c).alias(c) for c in ("n", "n_near", "form_n", "form")])
    good = F.col("form_n") >= ratio * F.col("n")
    found = stored(each.select("word", "n", "n_near", F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n")), "spelling")
    roots = _roots(found.where("form is not null").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variants among the words of all texts, of which one in 97 (by a hash of document and word) has lost a code point.

    A null doc_id is hashed as an empty text.
    """
    run = F.col("run")
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    words = vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text"), F.when(h % 97 == 0, short).otherwise(run))
    return spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")
