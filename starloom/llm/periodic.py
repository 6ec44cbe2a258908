"""Periodic runs of words: recursive frequency splitting, then a scan of lags.

1. A word that occurs fewer than twice in a segment is in no run there, for a run holds each of its
   words at least twice. Such words split the segment; what is left is counted anew, until no segment
   changes. Segments shorter than the least run are dropped.
2. In the segments that survive, a run of period q is a stretch of at least q places whose word equals
   the one q places on. Any such stretch holds four neighbours of the places 0, t, 2t ... for t = q // 4,
   so only these are compared, for all lags of one octave and all segments at once; where four in a row
   agree, the stretch is followed to both its ends. Lags that are multiples of the period of a run found
   before are passed over inside that run.
3. Of equal stretches the smallest lag is the period.

A chunk of texts of a task is worked on at a time; a text is never cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm._common import table

LEAST_WORDS = 12
#: Words of texts that a task searches at a time, unless one text alone has more.
CHUNK_WORDS = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _spans(flags: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true ``flags``; a true ``breaks`` starts a new one."""
    begin = flags & np.concatenate([[True], ~flags[:-1] | breaks[1:]]) if len(flags) else flags
    end = flags & np.concatenate([~flags[1:] | breaks[1:], [True]]) if len(flags) else flags
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def split_by_frequency(words: np.ndarray, firsts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the segments in which every word occurs twice; ``firsts`` are where texts begin."""
    at = np.arange(len(words))
    breaks = np.zeros(len(words), bool)
    breaks[firsts[firsts < len(words)]] = True
    begin, end = _spans(np.ones(len(words), bool), breaks)
    while True:
        wide = end - begin >= least
        begin, end = begin[wide], end[wide]
        size = end - begin
        part = np.repeat(np.arange(len(begin)), size)
        at = np.arange(len(part)) + np.repeat(begin - (np.cumsum(size) - size), size)
        if not len(at):
            return begin, end
        key = part.astype(np.int64) << 32 | words[at]
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        number = np.cumsum(new) - 1
        often = np.empty(len(at), bool)
        often[order] = (np.bincount(number) >= 2)[number]
        if often.all():
            return begin, end
        edge = np.zeros(len(at), bool)
        edge[np.cumsum(size) - size] = True
        b, e = _spans(often, edge)
        begin, end = at[b], at[e - 1] + 1


def _reach(words: np.ndarray, i: int, q: int, low: int, high: int) -> tuple[int, int]:
    """The stretch around place ``i`` in which words ``q`` apart are equal, inside the segment [low, high)."""
    end, step = i, 64
    while end < high - q:
        n = min(step, high - q - end)
        differ = words[end : end + n] != words[end + q : end + q + n]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = end + n, step * 2
    begin, step = i, 64
    while begin > low:
        n = min(step, begin - low)
        differ = words[begin - n : begin] != words[begin - n + q : begin + q]
        if differ.any():
            begin -= int(differ[::-1].argmax())
            break
        begin, step = begin - n, step * 2
    return begin, end


def find_runs(words: np.ndarray, firsts: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of ``least`` words and two periods, by start and period.

    ``words`` are the numbers of the words of many texts, which begin at ``firsts``; no run crosses from one to the next.
    """
    begin, end = split_by_frequency(words, firsts, least)
    found: dict[tuple[int, int], int] = {}
    # of the runs found in earlier octaves, the one that reaches furthest from each place
    furthest, period = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
    octave = 1
    while len(begin):
        wide = end - begin >= max(2 * octave, least)
        begin, end = begin[wide], end[wide]
        if not len(begin):
            break
        lags = np.minimum(2 * octave, (end - begin) // 2 + 1) - octave
        seg = np.repeat(np.arange(len(begin)), lags)
        q = octave + np.arange(len(seg)) - np.repeat(np.cumsum(lags) - lags, lags)
        t = np.maximum(1, q // 4)
        count = (end[seg] - begin[seg] - q - 1) // t + 1
        done: list[tuple[int, int, int]] = []
        for i, j in _slices(count, 4 * CHUNK_WORDS):
            n = count[i:j]
            of = np.repeat(np.arange(i, j), n)
            place = begin[seg[of]] + (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * t[of]
            lag = q[of]
            same = words[place] == words[place + lag]
            four = same[:-3] & same[1:-2] & same[2:-1] & same[3:] & (of[:-3] == of[3:])
            at = np.flatnonzero(four)
            at = at[~((furthest[place[at]] >= place[at] + lag[at] + 1) & (lag[at] % period[place[at]] == 0))]
            last = np.searchsorted(of[at], of[at], "right")
            k = 0
            while k < len(at):
                i, lag, low, high = (int(x) for x in (place[at[k]], q[of[at[k]]], begin[seg[of[at[k]]]], end[seg[of[at[k]]]]))
                a, b = _reach(words, i, lag, low, high)
                if b - a >= max(lag, least - lag) and found.setdefault((a, b + lag), lag) == lag:
                    done.append((a, b + lag, lag))
                k += int(np.searchsorted(place[at[k : last[k]]], b))
        for a, b, lag in done:
            later = furthest[a:b] < b
            furthest[a:b][later], period[a:b][later] = b, lag
        octave *= 2
    return sorted((a, b - a, q) for (a, b), q in found.items())


def _slices(count: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of ``count`` whose sums stay under ``most``, unless one number alone is larger."""
    total, i = np.cumsum(count), 0
    while i < len(count):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + most, "right")))
        yield i, j
        i = j


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[str]]]]:
    """Words of the batch's texts, some rows at a time, with the first one's number."""
    cut = re.compile(WORD)
    begin, held, total = 0, [], 0
    for i, text in enumerate(batch.column("text")):
        held.append(cut.findall(text.as_py() or ""))
        total += len(held[-1])
        if total >= CHUNK_WORDS:
            yield begin, held
            begin, held, total = i + 1, [], 0
    if held:
        yield begin, held


def _search(texts: list[list[str]], least: int) -> tuple[list[list[dict]], list[str]]:
    """Each text's runs, and its words without the repeats."""
    numbers: dict[str, int] = {}
    words = np.array([numbers.setdefault(w, len(numbers)) for text in texts for w in text], np.int64)
    firsts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    runs: list[list[dict]] = [[] for _ in texts]
    keep = [t for t in texts]
    gone: dict[int, np.ndarray] = {}
    for start, length, q in find_runs(words, firsts[:-1], least):
        k = int(np.searchsorted(firsts, start, "right")) - 1
        start -= int(firsts[k])
        runs[k].append({"start": start, "length": length, "period": q})
        gone.setdefault(k, np.zeros(len(texts[k]), bool))[start + q : start + length] = True
    for k, drop in gone.items():
        keep[k] = [w for w, d in zip(texts[k], drop.tolist(), strict=True) if not d]
    return runs, [" ".join(t) for t in keep]


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of ``docs``.

    A run is a stretch of words with smallest period q, of at least ``least`` words and 2 q, that no
    neighbouring word extends; ``runs`` lists (start, length, period) by start and period. ``collapsed``
    is the text's words, one space between them, without those that a run has after its first q words.
    A null text counts as empty: no words, no runs, an empty ``collapsed``. Repeated rows and equal or
    null doc_ids are kept as they are; other columns are ignored; an empty table gives no rows.
    ``least`` is at least 8.
    """
    if least < 8:
        raise ValueError("runs of under 8 words can't be looked for")
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    type_ = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in _texts(batch):
                runs, kept = _search(texts, least)
                ids = batch.column("doc_id").slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array([len(t) for t in texts], pa.int64()), pa.array(runs, type_), pa.array(kept, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def _repeating(docs: DataFrame) -> DataFrame:
    """Texts of which one in ten, by a hash of doc_id, goes on repeating itself from some word; a null doc_id leaves the text as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n = F.size("words")
    chosen = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    a = F.when(n > 0, F.pmod("g", n)).cast("int")
    split = chosen.select("doc_id", "text", "words", a.alias("a"), (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int").alias("p"))
    again = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return split.select("doc_id", F.when(F.size("words") > 0, F.concat_ws(" ", again)).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_repeating(table(spark, sf_dir, "documents")))
    longest = F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda best, x: F.when(best.isNull() | (x["length"] > best["length"]), x).otherwise(best))
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    hashed = lambda text: F.sha2(text.cast("binary"), 256)
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"), hashed(F.array_join(lines, "")).alias("runs_sha256"), hashed(F.col("collapsed")).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "longest.*", F.expr("1000 * longest.length div longest.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
