"""Packing by patterns: shortest pack first over the histogram of lengths, documents joined by rank.

1. Texts become token ids, each document's followed by an end id, and are cut into pieces of at most a
   sequence; only a document's last piece is shorter. Pieces are stored with their rank among the
   pieces of equal length of their task.
2. The histogram of lengths, at most as many numbers as a sequence has tokens, is packed at the driver:
   from the longest length to the shortest, all pieces of a length go at once to the packs with most
   room, a pack being a list of lengths and the number of sequences that are filled so (``Pack``).
   Where no pack has room, new ones are opened.
3. Sequences of a length that needs no padding are complete. Of the others, the emptiest are dissolved
   and their pieces are cut to fill the rest, again for all sequences of a pack at once. What is left
   in the end is under one sequence and is cut at powers of two. So nothing is padded.
4. Each pack's pieces are ranges of ranks among the pieces of their length. Ranks are counted over tasks
   by a running sum for each length, and a piece finds its place by its length and rank. The table of
   places is as long as the packs have pieces, whatever the number of documents.
"""

from __future__ import annotations

import base64
import re
from bisect import insort
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import count

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm._common import new_folder, stored, table

SEQUENCE = 1024
END_ID = 0
#: Up to so many numbers of pieces, one for each task and length, are broadcast; more are joined.
BROADCAST_COUNTS = 1 << 18


@dataclass
class Pack:
    """``count`` sequences filled alike: ``pieces`` are (length, first rank, first token, tokens, offset), the k-th sequence holds the piece of rank first + k."""

    count: int
    used: int = 0
    pieces: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    def add(self, length: int, rank: int, start: int, tokens: int) -> None:
        self.pieces.append((length, rank, start, tokens, self.used))
        self.used += tokens

    def split(self, n: int) -> Pack:
        """Takes the first ``n`` sequences out."""
        first = Pack(n, self.used, list(self.pieces))
        self.count -= n
        self.pieces = [(length, rank + n, start, tokens, offset) for length, rank, start, tokens, offset in self.pieces]
        return first


def shortest_pack_first(histogram: Mapping[int, int], size: int = SEQUENCE) -> list[Pack]:
    """Packs that hold, for each length, so many pieces as ``histogram`` says; no piece is cut."""
    by_room: dict[int, list[Pack]] = {}
    rooms: list[int] = []

    def put(pack: Pack) -> None:
        room = size - pack.used
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append(pack)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            while rooms and not by_room[rooms[-1]]:
                del by_room[rooms.pop()]
            if rooms and rooms[-1] >= length:
                pack = by_room[rooms[-1]].pop()
                if pack.count > left:
                    first = pack.split(left)
                    put(pack)
                    pack = first
                copies = 1
            else:
                copies = min(size // length, left)
                pack = Pack(left // copies)
            for _ in range(copies):
                pack.add(length, rank, 0, length)
                rank += pack.count
                left -= pack.count
            put(pack)
    return [pack for room in rooms for pack in by_room[room]]


def _whole(used: int, size: int) -> bool:
    return used == size or used & (used - 1) == 0


def fill_up(packs: list[Pack], size: int = SEQUENCE) -> list[Pack]:
    """The same pieces, some of them cut, in sequences of ``size`` or a power of two tokens each."""
    done = [p for p in packs if _whole(p.used, size)]
    part = sorted((p for p in packs if not _whole(p.used, size)), key=lambda p: -p.used)
    # sequences are dissolved from the emptiest on, until they have the tokens that the others lack
    tokens, lack = 0, sum(p.count * (size - p.used) for p in part)
    loose: list[Pack] = []
    while tokens < lack:
        n = min(part[-1].count, -(-(lack - tokens) // size))
        pack = part[-1].split(n) if n < part[-1].count else part.pop()
        loose += [Pack(n, some, [(length, rank, start, some, 0)]) for length, rank, start, some, _ in pack.pieces]
        tokens, lack = tokens + n * pack.used, lack - n * (size - pack.used)
    # the pieces of most sequences go to the pack of most sequences, so that few are left to be handled one by one
    turn = count()
    pieces, open_ = ([(-p.count, next(turn), p) for p in found] for found in (loose, part))
    heapify(pieces)
    heapify(open_)
    while open_:
        piece, pack = heappop(pieces)[2], heappop(open_)[2]
        n = min(piece.count, pack.count)
        for rest, heap in ((piece, pieces), (pack, open_)):
            if rest.count > n:
                heappush(heap, (n - rest.count, next(turn), rest))
        piece, pack = (p.split(n) if p.count > n else p for p in (piece, pack))
        length, rank, start, some, _ = piece.pieces[0]
        take = min(some, size - pack.used)
        pack.add(length, rank, start, take)
        if take < some:
            heappush(pieces, (-n, next(turn), Pack(n, some - take, [(length, rank, start + take, some - take, 0)])))
        if pack.used == size:
            done.append(pack)
        else:
            heappush(open_, (-n, next(turn), pack))
    return done + _by_powers([p for *_, p in pieces])


def _by_powers(loose: list[Pack]) -> list[Pack]:
    """What is left, less than one sequence, in one for each power of two in its number of tokens."""
    total = sum(p.count * p.used for p in loose)
    sizes = [1 << k for k in reversed(range(total.bit_length())) if total >> k & 1]
    out = [Pack(1) for _ in sizes]
    k = 0
    for pack in loose:
        for i in range(pack.count):
            for length, rank, start, tokens, _ in pack.pieces:
                while tokens:
                    take = min(tokens, sizes[k] - out[k].used)
                    out[k].add(length, rank + i, start, take)
                    start, tokens = start + take, tokens - take
                    k += out[k].used == sizes[k]
    return out


class Places:
    """Where pieces go, by length and rank: sorted ranges of ranks, each with the parts that its pieces are cut into."""

    def __init__(self, packs: list[Pack]) -> None:
        base, rows = 0, []
        for pack in packs:
            rows += [(length, rank, rank + pack.count, start, tokens, base, offset) for length, rank, start, tokens, offset in pack.pieces]
            base += pack.count
        cuts: dict[int, set[int]] = {}
        for length, first, last, _, tokens, _, _ in rows:
            if tokens < length:
                cuts.setdefault(length, set()).update((first, last))
        bounds = {length: np.array(sorted(found)) for length, found in cuts.items()}
        parts = []
        for length, first, last, start, tokens, base, offset in rows:
            if tokens == length:
                parts.append((length, first, start, tokens, base, offset))
                continue
            inside = bounds[length][np.searchsorted(bounds[length], first) : np.searchsorted(bounds[length], last)]
            parts += [(length, int(k), start, tokens, base + int(k) - first, offset) for k in inside]
        parts.sort()
        found = np.array(parts, np.int64).reshape(-1, 6)
        self.length, self.rank, self.start, self.tokens, self.base, self.offset = found.T.copy()
        key = (self.length << 44) | self.rank
        self.key, self.at = np.unique(key, return_index=True)
        self.at = np.append(self.at, len(found))

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For pieces of ``length`` and ``rank``: each part's piece, its number in this table, and its sequence."""
        range_ = np.searchsorted(self.key, (length.astype(np.int64) << 44) | rank, "right") - 1
        n = self.at[range_ + 1] - self.at[range_]
        piece = np.repeat(np.arange(len(length)), n)
        part = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.at[range_], n)
        return piece, part, self.base[part] + rank[piece] - self.rank[part]


#: Characters that the two libraries' patterns may know from different versions of Unicode, and odd white space.
_UNUSUAL = re.compile("[\x1c-\x1f\x85\u0250-\U0010ffff]")


class Encoder:
    """Ids of texts, four little-endian bytes each, as the tokenizer of file ``path`` gives them.

    Most texts go through ``ranks``, the same vocabulary in the faster library's form; those that may
    hold a special token's name or characters in which the libraries could differ go to the tokenizer itself.
    """

    def __init__(self, path: str, ranks: str) -> None:
        self.whole = Tokenizer.from_file(path)
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def encode(self, text: str) -> bytes:
        unusual = "<|" in text or _UNUSUAL.search(text)
        ids = self.whole.encode(text, add_special_tokens=False).ids if unusual else self.ranks.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


@cache
def encoder(path: str, ranks: str) -> Encoder:
    """A worker's own encoder, kept from task to task."""
    return Encoder(path, ranks)


def _tokens(docs: DataFrame, path: str, ranks: str, size: int) -> DataFrame:
    """The stored table of pieces: ``task`` and ``rank``, its number among the task's pieces of its length."""
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, ranked = encoder(path, ranks).encode, TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in batches:
            out: list[tuple] = []
            for row, text in enumerate(batch.column("text")):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                for start in range(0, n, size):
                    length = min(size, n - start)
                    out.append((row, start, length, n, ids[4 * start : 4 * (start + length)], ranked[length]))
                    ranked[length] += 1
                if len(out) >= 4096 or row == batch.num_rows - 1:
                    rows, *columns = zip(*out, strict=True)
                    columns = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64()), strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows)), *columns, pa.array([task] * len(rows), pa.int32())], ["doc_id", "start", "length", "doc_tokens", "ids", "rank", "task"])
                    out = []

    pieces = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, length int, doc_tokens long, ids binary, rank long, task int")
    folder = new_folder(docs.sparkSession, "tokens")
    pieces.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(pieces.schema).parquet(folder)


def pack_by_patterns(docs: DataFrame, path: str, ranks: str, size: int = SEQUENCE) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): a row for each piece of each row of ``docs``.

    ``ids`` are the piece's token ids, four little-endian bytes each; ``start`` says how many ids of its
    document, which has ``doc_tokens``, come before. It lies from ``offset`` on in sequence ``sequence_id``,
    whose pieces leave no gap and have ``size`` ids or a power of two together. A null or empty text has
    the end id alone. Repeated rows and equal or null doc_ids are packed as often as they occur; an
    empty table gives no rows; other columns are ignored.
    """
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    pieces = _tokens(docs, path, ranks, size)
    counts = stored(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(fill_up(shortest_pack_first(histogram, size), size))
    before = counts.select("task", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    if counts.count() <= BROADCAST_COUNTS:
        before = F.broadcast(before)
    ranked = pieces.join(before, ["task", "length"]).select("doc_id", "start", "length", "doc_tokens", "ids", (F.col("before") + F.col("rank")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            piece, part, sequence = places.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            first, n = places.start[part], places.tokens[part]
            ids = batch.column("ids").take(pa.array(piece))
            if len(piece) > batch.num_rows:
                ids = pa.array([x[4 * i : 4 * (i + k)] for x, i, k in zip(ids.to_pylist(), first.tolist(), n.tolist(), strict=True)], pa.binary())
            start = batch.column("start").to_numpy()[piece] + first
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(piece)), pa.array(start), pa.array(n), ids, batch.column("doc_tokens").take(pa.array(piece)), pa.array(sequence), pa.array(places.offset[part])],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def op13_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pack_by_patterns(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
