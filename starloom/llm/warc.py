"""WARC archives: a writer in DataFrame operations and a reader as a Python data source.

The writer makes each record a string and lets Spark's text writer end it with the two line
breaks that close a WARC record, so archives go through Spark's commit protocol to any file
system. Of records with equal payloads the one with the least page_id is the response; the others
are revisits without a payload. The reader plans one partition per archive file, takes pushed
down predicates on record type and header columns, parses a record's headers first, and seeks
past a payload that a predicate rules out or that the query doesn't ask for.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull
from pyspark.sql.types import StructType

from starloom.llm._common import new_folder, stored, table

END = "\r\n\r\n"
#: Payloads with fewer bytes are always written in full.
MIN_REVISIT_BYTES = 0
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20
SCHEMA = "record_id string, record_type string, target_uri string, payload_digest string, refers_to string, payload_length long, payload binary"
#: The WARC header that each column but the payload comes from.
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "payload_length": "x-payload-length",
}


def _base32(hex_digest):
    """Upper-case base32 of a 40-digit hex column: 5 bits at a time, from 20-bit groups."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    letters = []
    for group in range(8):
        number = F.conv(F.substring(hex_digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(alphabet, F.shiftright(number, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def with_record_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, html) as page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload. Equal payloads of at least ``min_bytes`` bytes are one group:
    the least page_id is the response (a null page_id is the greatest), also when it occurs
    twice; then one of its rows is the response and the others revisit it.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha"), F.monotonically_increasing_id().alias("row"))
    pages_of = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("sha", "page_id").agg(F.min("row").alias("row"), F.count("*").alias("same"))
    order = F.struct(F.col("page_id").isNull(), "page_id", "row", "same")
    groups = pages_of.groupBy("sha").agg(F.min(order).alias("first"), F.sum("same").alias("n")).where("n > 1")
    # Written first: Spark then knows its size, and broadcasts it only when that is small.
    groups = stored(groups.select("sha", "first.page_id", "first.row", "first.same").toDF("sha", "first_id", "first_row", "same"))
    other = ~F.col("page_id").eqNullSafe(F.col("first_id")) | ((F.col("same") > 1) & (F.col("row") != F.col("first_row")))
    repeat = F.col("first_row").isNotNull() & (F.col("payload_bytes") >= min_bytes) & other
    return rows.join(groups, "sha", "left").select(
        "page_id", "url", "payload", "payload_bytes", _base32(F.col("sha")).alias("payload_digest"),
        F.when(repeat, "revisit").otherwise("response").alias("record_type"), F.when(repeat, F.col("first_id")).alias("refers_to"),
    )


def record_text(rows: DataFrame) -> DataFrame:
    """One WARC record per row of ``with_record_types``, without the two line breaks that end it."""
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes"), F.lit(END))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    refers = F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), page("refers_to"))).otherwise("")
    return rows.select(
        F.concat(
            F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"), F.lit("\r\nWARC-Record-ID: "), page("page_id"),
            F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), clean, F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
            F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes"), refers,
            F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block), F.lit(END), block,
        ).alias("value")
    )


def write_warc(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """One archive file for each partition of ``pages`` under ``path``."""
    record_text(with_record_types(pages, min_bytes)).write.option("lineSep", END).text(path)


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    if ":" not in path.split("/", 1)[0]:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.path, self.schema = options["path"], schema
        self.equal: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Takes ``=``, ``IN`` and ``IS NOT NULL`` on header columns; Spark keeps the rest."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.equal.append((name, frozenset([f.value])))
            elif name in HEADERS and isinstance(f, In):
                self.equal.append((name, frozenset(f.value)))
            elif name in HEADERS and isinstance(f, IsNotNull):
                self.equal.append((name, frozenset()))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, path = _system(self.path)
        files = [x.path for x in fs.get_file_info(pafs.FileSelector(path, recursive=True)) if x.is_file and x.size and not x.base_name.startswith(("_", "."))]
        return [_File(p) for p in sorted(files)] or [_File("")]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        names = self.schema.fieldNames()
        fs, _ = _system(self.path)
        rows: list[tuple] = []
        held = 0
        with fs.open_input_file(partition.path) as source:
            for record in _records(source, self.equal, "payload" in names):
                rows.append(tuple(record.get(n) for n in names))
                held += len(record.get("payload") or b"")
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield self._batch(names, rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(names, rows)

    def _batch(self, names: list[str], rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"payload": pa.binary(), "payload_length": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names)


def _records(source, equal: list[tuple[str, frozenset]], payloads: bool) -> Iterator[dict]:
    """Records of one archive that pass ``equal``; other payloads are skipped by seeking."""
    size, at, window, base = source.size(), 0, b"", 0
    ahead = 1 << 16

    def upto(position: int, mark: bytes) -> int:
        nonlocal window, base
        if not base <= position <= base + len(window):
            source.seek(position)
            window, base = source.read(ahead), position
        while (k := window.find(mark, position - base)) < 0:
            source.seek(base + len(window))
            more = source.read(ahead)
            if not more:
                raise ValueError(f"record at byte {position} doesn't end its headers")
            window, base = window[position - base :] + more, position
        return base + k

    def exactly(position: int, length: int) -> bytes:
        if base <= position and position + length <= base + len(window):
            return window[position - base : position - base + length]
        source.seek(position)
        return source.read(length)

    while at < size:
        end = upto(at, b"\r\n\r\n")
        lines = window[at - base : end - base].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block, length = end + 4, int(headers["content-length"])
        record: dict = {c: headers.get(h) for c, h in HEADERS.items()}
        record["payload_length"] = int(record["payload_length"]) if record["payload_length"] else None
        at = block + length + 4
        if any(record[c] is None or (allowed and record[c] not in allowed) for c, allowed in equal):
            continue
        if payloads:
            if record["record_type"] == "revisit":
                record["payload"] = None
            else:
                http = upto(block, b"\r\n\r\n") + 4
                record["payload"] = exactly(http, block + length - http)
        yield record


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``; a schema naming fewer of SCHEMA's columns reads only those."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options, schema)


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").schema(columns).load(path)


def payload_facts(records: DataFrame) -> DataFrame:
    """Length and bare base32 SHA-1 of each record's payload as read; a revisit's are those its headers state."""
    names = ["record_id", "record_type", "refers_to"]

    def run(batches):
        for batch in batches:
            size, digest = [], []
            for payload, length, stated in zip(batch.column("payload"), batch.column("payload_length"), batch.column("payload_digest"), strict=True):
                if payload.is_valid:
                    data = payload.as_buffer()
                    size.append(data.size)
                    digest.append(base64.b32encode(hashlib.sha1(data).digest()).decode())
                else:
                    size.append(length.as_py())
                    digest.append((stated.as_py() or "").rpartition(":")[2])
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(size, pa.int64()), pa.array(digest, pa.string())], [*names, "payload_bytes", "payload_digest"])

    return records.mapInArrow(run, "record_id string, record_type string, refers_to string, payload_bytes long, payload_digest string")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    facts = payload_facts(read_warc(spark, path))
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(.*)>', 1) AS bigint)")
    return facts.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


def _base32_sql(digits: str) -> str:
    letters = []
    for group in range(8):
        places = [f"(instr('0123456789abcdef', substr({digits}, {5 * group + k}, 1)) - 1)" for k in range(1, 6)]
        number = places[0]
        for p in places[1:]:
            number = f"({number}*16 + {p})"
        letters += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(({number} >> {s}) & 31 AS BIGINT) + 1, 1)" for s in (15, 10, 5, 0)]
    return " || ".join(letters)


OP7_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS digits, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
SELECT page_id, payload_bytes, {_base32_sql("digits")} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
