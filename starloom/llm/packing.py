"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted. Documents longer than the longest are cut into pieces of
that length first. Pieces are dealt by hash into blocks of about ``BLOCK_ITEMS`` and each block is
packed on its own: in falling order, a piece goes to the open bin that it leaves fullest; where
none has room, a bin is opened. Which length is opened is optimised over the permitted ones
together, by what would fill it: for each length that holds the piece, the pieces still to come are
laid into it greedily, largest first, the bin is downsized to that content, and the length of least
cost per character filled is opened. A block is packed so, and with each permitted length in turn
as the least one opened, and the cheapest of these is kept. At the end every bin is downsized to
the shortest permitted length that holds its contents. Blocks never share a bin, so at most a
block's last few bins are emptier than a global packing would leave them.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm._common import table

#: Permitted sequence lengths in characters.
LENGTHS = (2048, 4096, 8192, 16384)
BLOCK_ITEMS = 4096
#: Bins that may still take pieces where the order of pieces is kept.
OPEN_BINS = 16


def sequence_cost(length: int, linear_until: int = 32768) -> float:
    """What a sequence costs to train on: linear terms, attention's quadratic one, and a fixed overhead."""
    return length + length * length / linear_until + 256


class _Waiting:
    """Pieces still to come, by size; the largest that fits is found by bisection over the different sizes."""

    def __init__(self, sizes: Sequence[int]) -> None:
        self.count = Counter(sizes)
        self.sizes = sorted(self.count)

    def take(self, size: int) -> None:
        self.count[size] -= 1
        if not self.count[size]:
            del self.sizes[bisect_left(self.sizes, size)]

    def filled(self, room: int) -> int:
        """Characters that greedy filling, largest first, lays into ``room``."""
        start, k = room, bisect_right(self.sizes, room)
        while k and room >= self.sizes[0] and room:
            size = self.sizes[k - 1]
            if not size:
                break
            room -= size * min(self.count[size], room // size)
            k = min(k - 1, bisect_right(self.sizes, room))
        return start - room


def _packed(sizes: Sequence[int], lengths: list[int], cost: Callable[[int], float], open_bins: int | None, least: int | None) -> tuple[list[int], list[int], list[int]]:
    """One packing: new bins are of length ``least`` or the next that holds the piece; with None, of the length that what is to come fills best."""
    ahead = _Waiting(sizes) if least is None else None
    room: list[tuple[int, int]] = []
    used: list[int] = []
    free: list[int] = []
    bins, offsets = [], []
    for size in sizes:
        if ahead is not None:
            ahead.take(size)
        k = bisect_left(room, (size, -1))
        if k < len(room):
            left, b = room.pop(k)
        else:
            b, fit = len(used), [c for c in lengths if c >= size]
            if ahead is None:
                left = next((c for c in fit if c >= least), fit[-1])
            else:
                filled = {c: size + ahead.filled(c - size) for c in fit}
                left = min(fit, key=lambda c: (cost(lengths[bisect_left(lengths, filled[c])]) / max(filled[c], 1), -filled[c], c))
            used.append(0)
            free.append(left)
            if open_bins and b >= open_bins:
                shut = (free[b - open_bins], b - open_bins)
                del room[bisect_left(room, shut)]
        bins.append(b)
        offsets.append(used[b])
        used[b] += size
        free[b] = left - size
        insort(room, (left - size, b))
    return bins, offsets, [lengths[bisect_left(lengths, u)] for u in used]


def best_fit(sizes: Sequence[int], lengths: Sequence[int], cost: Callable[[int], float] = sequence_cost, open_bins: int | None = None) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each of ``sizes``, in the order given, and each bin's permitted length, of the cheapest packing tried.

    With ``open_bins``, only the bins opened last, so many of them, take further pieces.
    """
    lengths = sorted(lengths)
    tried = [_packed(sizes, lengths, cost, open_bins, least) for least in (None, *lengths)]
    return min(tried, key=lambda found: sum(map(cost, found[2])))


def pack(docs: DataFrame, lengths: Sequence[int] = LENGTHS, block_items: int = BLOCK_ITEMS, order: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, piece, start, n_chars, bin_id, position, capacity): a row for each piece of each row of ``docs``.

    ``start`` and ``n_chars`` say which characters of the text the piece is (from 0), ``position``
    where it lies in bin ``bin_id`` of ``capacity`` characters. A null or empty text is one piece of
    no characters. Repeated rows and equal or null doc_ids are packed as often as they occur; an
    empty table gives no rows; other columns are ignored.

    ``order`` names two columns of whole numbers, a slot (from 0, dense) and a place in it, whose
    order the bins keep: blocks are consecutive ranges of slots, pieces are packed as they come, and
    only the last ``OPEN_BINS`` bins take more. So the bins up to any bin_id hold all pieces up to
    some place of the order, and of later ones only what fell into ``OPEN_BINS`` bins.
    """
    most = max(lengths)
    slot, place = [F.col(c).cast("long") for c in order] if order else [F.lit(0).cast("long")] * 2
    rows = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"), slot.alias("slot"), place.alias("place"))
    cut = F.greatest(F.ceil(F.col("n") / most), F.lit(1)).cast("int")
    total, last = rows.agg(F.sum(cut), F.max("slot")).first()
    blocks = max(1, -(-(total or 0) // block_items))
    slots = max(1, -(-((last or 0) + 1) // blocks))
    items = rows.select("doc_id", "n", "slot", "place", F.monotonically_increasing_id().alias("row"), F.explode(F.sequence(F.lit(0), cut - 1)).alias("piece"))
    items = items.select(
        "doc_id", "row", "piece", "slot", "place", (F.col("piece").cast("long") * most).alias("start"), F.least(F.col("n") - F.col("piece").cast("long") * most, F.lit(most)).alias("n_chars"),
        (F.floor(F.col("slot") / slots) if order else F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(blocks))).alias("block"),
    )
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    permitted = list(lengths)

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        n, row, piece, slot, place = (group.column(c).to_numpy() for c in ("n_chars", "row", "piece", "slot", "place"))
        turn = np.lexsort((piece, row, place, slot) if order else (piece, row, -n))
        bins, offsets, sizes = best_fit(n[turn].tolist(), permitted, open_bins=OPEN_BINS if order else None)
        bins = np.array(bins, np.int64)
        out = group.select(["doc_id", "piece", "start", "n_chars"]).take(pa.array(turn))
        ids = bins + (key[0].as_py() << 20)
        return out.append_column("bin_id", pa.array(ids)).append_column("position", pa.array(offsets, pa.int64())).append_column("capacity", pa.array(np.array(sizes, np.int64)[bins]))

    return items.groupBy("block").applyInArrow(run, f"doc_id {kind}, piece int, start long, n_chars long, bin_id long, position long, capacity long")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
