"""What the corpus operators share: tables, shared scratch space, text as byte arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to so many bitmaps of row numbers (4 KB each) are broadcast.
BITMAPS = 1 << 11
#: Bytes of text that a Python task turns into numpy arrays at a time.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a local session without one, as in tests, gets a local folder."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="starloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(found)
    return found.rstrip("/")


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores if a column of ``taken`` is called so."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def merged(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join of two tables that grow with the corpus, neither of which Spark may broadcast.

    It sizes a table by its compressed files, and an exploded one by what it was made of: one that it
    takes for small enough can be many times as large in the driver's memory.
    """
    return left.join(right.hint("merge"), on, how)


def picked(docs: DataFrame, rows: DataFrame, others: bool = False) -> DataFrame:
    """``docs`` whose ``row`` is in the table ``rows`` (row), or those whose ``row`` is not.

    Row numbers of a scan are dense in each of its partitions, so they go round as bitmaps, a bit each,
    and nothing is shuffled; numbers too sparse for it are joined.
    """
    at = F.col("row") + 1
    place = F.bitmap_bit_position(at)
    held = rows.select("row", F.bitmap_bucket_number(at).alias("picked_bucket")).repartition("picked_bucket")
    bits = stored(held.groupBy("picked_bucket").agg(F.bitmap_construct_agg(place).alias("picked_bits")), "picked")
    if bits.count() > BITMAPS:
        return merged(docs, rows, "row", "left_anti" if others else "left_semi")
    byte = F.conv(F.hex(F.substring("picked_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    found = docs.withColumn("picked_bucket", F.bitmap_bucket_number(at)).join(F.broadcast(bits), "picked_bucket", "left")
    return found.where(~there if others else there).drop("picked_bucket", "picked_bits")


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and cut its lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts of an Arrow string column as bytes: (first row, end row, bytes, offsets).

    A null is an empty text. A chunk ends before it exceeds ``limit`` unless one text alone does.
    """
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, raw[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def key_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup batches that come sorted by ``key`` so that no key is split between two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(keys, keys[-1], "left"))
        if last == 0 and len(held) > 1 and held[-2].column(key)[-1].as_py() == keys[-1]:
            continue
        if last == 0 and len(held) == 1:
            continue
        done = pa.Table.from_batches([*held[:-1], batch.slice(0, last)])
        held = [batch.slice(last)]
        if done.num_rows:
            yield done
    if held:
        yield pa.Table.from_batches(held)


def stored(df: DataFrame, kind: str = "step") -> DataFrame:
    """Compute ``df`` now into a table in the shared folder and return a scan of it."""
    path = new_folder(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the folders of ``stored`` tables that nothing will read again: what was made of them has to be stored itself."""
    for df in tables:
        spark = df.sparkSession
        files = df.inputFiles()
        # an empty table may have no file; it is small enough to stay
        folder = files[0].rsplit("/", 1)[0] if files else ""
        if shared_dir(spark).removeprefix("file:").rstrip("/") in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
