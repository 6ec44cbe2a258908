"""Event tables in FITS files: a Python data source that reads byte ranges, its writer, and ingestion.

A file is blocks of 2880 bytes: header cards of 80 characters, then big-endian rows of fixed
width, so any range of rows is a seek. A partition is a range of one file's bytes, planned from the
listing alone; the task that reads it opens the header. Columns that the query doesn't name are not
decoded. Files may differ in layout: each file's own columns are mapped to the asked ones by name or
alias, and wider types take narrower ones. A file that can't be read, or lacks an asked column, is a bad
file: it fails the query, is left out, or is reported as a row with its error. A file that says it is
sorted by a column is searched by bisection for the range of that column that a query asks for. The
writer makes files of at most ``FILE_ROWS`` rows, or one whole file for each name where a column names
them; rows beyond that many wait in the task's own temporary file, so a task never holds more.
"""

from __future__ import annotations

import contextlib
import itertools
import math
import shutil
import tempfile
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructType

BLOCK = 2880
#: Bytes of a partition, rows of a batch, rows of a written file, and bytes of arrays read at once.
SPLIT_BYTES = 64 << 20
BATCH = 65_536
FILE_ROWS = 1 << 18
HEAP_BYTES = 64 << 20
#: Of a reported file's rows: its path, why it can't be read, and false for the row that stands for the file itself.
REPORT = "file string, error string, is_event boolean"
_BAD = (ValueError, KeyError, OSError)
_KINDS = {"K": ">i8", "J": ">i4", "I": ">i2", "D": ">f8", "E": ">f4", "B": "u1", "L": "u1"}
_TYPES = {"K": "long", "J": "int", "I": "short", "D": "double", "E": "float", "B": "short", "L": "boolean"}
_LETTERS = {LongType: "K", IntegerType: "J", ShortType: "I", ByteType: "I", DoubleType: "D", FloatType: "E"}
_NUMPY = {"K": np.int64, "J": np.int32, "I": np.int16, "D": np.float64, "E": np.float32, "B": np.int16}


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if ":" not in path.split("/", 1)[0]:
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        path = "file:///" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _listing(folder: str) -> list[pafs.FileInfo]:
    fs, path = file_system(folder)
    found = fs.get_file_info(pafs.FileSelector(path, recursive=True))
    return sorted((x for x in found if x.is_file and x.base_name.endswith(".fits")), key=lambda x: x.path)


def _header(source, at: int) -> tuple[dict[str, str], int]:
    """Cards of the header that begins at ``at``, and where its blocks end."""
    source.seek(at)
    cards: dict[str, str] = {}
    while True:
        block = source.read(BLOCK)
        if len(block) < BLOCK:
            raise ValueError("a header doesn't end")
        at += BLOCK
        for i in range(0, BLOCK, 80):
            card = block[i : i + 80].decode("ascii")
            key, value = card[:8].strip(), card[10:]
            if key == "END":
                return cards, at
            if card[8:10] == "= ":
                value = value.strip()
                cards[key] = value[1:].split("'")[0].rstrip() if value.startswith("'") else value.split("/")[0].strip()


@dataclass
class Field:
    """A column: ``letter`` and ``count`` of its form, and the cards that scale it or name its null."""

    name: str
    letter: str
    count: int
    scale: float = 1.0
    zero: float = 0.0
    null: int | None = None
    #: Of a column of arrays kept behind the table: the form of one array's values.
    inner: Field | None = None

    @property
    def width(self) -> int:
        if self.letter == "X":
            return -(-self.count // 8)
        if self.letter in "PQCM":
            return self.count * {"P": 8, "Q": 16, "C": 8, "M": 16}[self.letter]
        return self.count * (1 if self.letter == "A" else np.dtype(_KINDS[self.letter]).itemsize)

    @property
    def one(self) -> str:
        """Spark type of one value."""
        if self.letter in _TYPES and (self.scale, self.zero) != (1.0, 0.0):
            return "long" if self.unsigned else "double"
        return _TYPES[self.letter]

    @property
    def unsigned(self) -> bool:
        """Whether the zero only shifts a signed number to an unsigned one (or the other way about)."""
        return self.scale == 1 and (self.letter, self.zero) in {("I", 2.0**15), ("J", 2.0**31), ("B", -(2.0**7))}

    @property
    def type(self) -> str | None:
        """Spark type; None for what can't be read (complex numbers, bits and arrays of arrays kept behind the table, no value)."""
        if self.letter in "PQ":
            inner = self.inner.letter if self.inner and self.count == 1 else ""
            return "string" if inner == "A" else f"array<{self.inner.one}>" if inner and inner in _TYPES else None
        if self.letter == "A":
            return "string"
        if self.letter == "X":
            return "long" if 0 < self.count < 64 else "binary" if self.count else None
        if self.letter not in _TYPES or not self.count:
            return None
        return self.one if self.count == 1 else f"array<{self.one}>"

    def decode(self, raw: np.ndarray) -> pa.Array:
        """Values of the column from its bytes, a row of ``raw`` each."""
        n = len(raw)
        if self.letter == "A":
            text = pa.array(np.ascontiguousarray(raw).view(f"S{self.count}")[:, 0]) if self.count else pa.array([b""] * n)
            return pc.utf8_rtrim(text.cast(pa.string()), characters=" \x00")
        if self.letter == "X":
            if self.count >= 64:
                return pa.array([x.tobytes() for x in raw], pa.binary())
            value = np.zeros(n, np.int64)
            for k in range(raw.shape[1]):
                value = (value << 8) | raw[:, k]
            return pa.array(value >> (8 * raw.shape[1] - self.count))
        flat = np.ascontiguousarray(raw).view(_KINDS[self.letter]).ravel()
        if self.letter == "L":
            one = pa.array(flat == ord("T"), mask=flat == 0)
        else:
            values = flat.astype(_NUMPY[self.letter])
            gone = None if self.null is None or self.letter in "DE" else values == self.null
            if self.one == "long" and self.letter != "K":
                values = values.astype(np.int64) + int(self.zero)
            elif (self.scale, self.zero) != (1.0, 0.0):
                values = values.astype(np.float64) * self.scale + self.zero
            one = pa.array(values, mask=gone)
        return one if self.count == 1 else pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * self.count), one)


    def decode_arrays(self, raw: np.ndarray, source, heap: int) -> pa.Array:
        """Values of a column of arrays, which ``raw`` says the number and place of; neighbours are read together."""
        place = np.ascontiguousarray(raw).view(">i4" if self.letter == "P" else ">i8").reshape(-1, 2).astype(np.int64)
        width = self.inner.width
        count, begin, end = place[:, 0], place[:, 1], place[:, 1] + place[:, 0] * width
        order = np.argsort(begin, kind="stable")
        order = order[count[order] > 0]
        pieces: list[bytes] = [b""] * len(count)
        i = 0
        while i < len(order):
            # a stretch of the heap without large gaps, of a bounded size unless one array is larger
            j, last = i + 1, int(end[order[i]])
            while j < len(order) and begin[order[j]] <= last + BLOCK and end[order[j]] - begin[order[i]] <= HEAP_BYTES:
                last, j = max(last, int(end[order[j]])), j + 1
            first = int(begin[order[i]])
            source.seek(heap + first)
            held = source.read(last - first)
            if len(held) < last - first:
                raise ValueError("the file ends before its arrays do")
            for k in order[i:j].tolist():
                pieces[k] = held[int(begin[k]) - first : int(end[k]) - first]
            i = j
        if self.inner.letter == "A":
            return pc.utf8_rtrim(pa.array(pieces, pa.binary()).cast(pa.string()), characters=" \x00")
        flat = self.inner.decode(np.frombuffer(b"".join(pieces), np.uint8).reshape(-1, width))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), flat)


@dataclass
class Layout:
    """Where the rows of a binary table are and what they hold."""

    at: int
    rows: int
    width: int
    fields: dict[str, Field]
    #: Where the arrays behind the table begin, and the column that the rows are sorted by.
    heap: int = 0
    sorted_by: str | None = None

    def places(self) -> dict[str, int]:
        found, at = {}, 0
        for name, field in self.fields.items():
            found[name] = at
            at += field.width
        return found


def layout(source, extension: str | None = None) -> Layout:
    """Of the table named ``extension``, or else of the file's first binary table; raises when the file is cut short."""
    cards, at = _header(source, 0)
    while cards.get("XTENSION") != "BINTABLE" or (extension and cards.get("EXTNAME", "").upper() != extension.upper()):
        size = abs(int(cards.get("BITPIX", "8"))) // 8 if int(cards.get("NAXIS", "0")) else 0
        for k in range(1, int(cards.get("NAXIS", "0")) + 1):
            size *= int(cards[f"NAXIS{k}"])
        size += int(cards.get("PCOUNT", "0")) if cards.get("XTENSION") == "BINTABLE" else 0
        cards, at = _header(source, at + -(-size // BLOCK) * BLOCK)
    fields = {}
    for k in range(1, int(cards["TFIELDS"]) + 1):
        one = _field(cards[f"TFORM{k}"].strip(), cards[f"TTYPE{k}"].lower(), *(cards.get(f"{x}{k}") for x in ("TSCAL", "TZERO", "TNULL")))
        fields[one.name] = one
    rows, width = int(cards["NAXIS2"]), int(cards["NAXIS1"])
    heap = at + int(cards.get("THEAP", rows * width))
    found = Layout(at, rows, width, fields, heap, cards.get("SORTCOL", "").lower() or None)
    if sum(f.width for f in fields.values()) != found.width:
        raise ValueError("the row's width doesn't match its columns")
    source.seek(0, 2)
    if source.tell() < at + found.rows * found.width:
        raise ValueError("the file ends before its rows do")
    return found


def _field(form: str, name: str, scale: str | None, zero: str | None, null: str | None) -> Field:
    digits = len(form) - len(form.lstrip("0123456789"))
    letter = form[digits : digits + 1]
    if not letter or letter not in "LXBIJKAEDCMPQ":
        raise ValueError(f"column form {form!r} of {name} is unknown")
    values = (float((scale or "1").replace("D", "E")), float((zero or "0").replace("D", "E")), None if null is None else int(null))
    count = int(form[:digits] or 1)
    if letter in "PQ":
        kind = form[digits + 1 : digits + 2]
        return Field(name, letter, count, inner=Field(name, kind, 1, *values) if kind in _TYPES or kind == "A" else None)
    return Field(name, letter, count, *values)


def aliases_of(text: str) -> dict[str, list[str]]:
    """{column: the other names it may have} of "time_s=time|t, energy_mev=energy"."""
    return {k.strip().lower(): [x.strip().lower() for x in v.split("|")] for k, v in (x.split("=") for x in text.split(",") if x.strip())}


def mapped(table: Layout, asked: StructType, aliases: dict[str, list[str]]) -> dict[str, Field]:
    """The file's own column for each one asked; raises where there is none, or one whose values the asked type can't hold."""
    found = {}
    for wanted in asked.fields:
        names = [wanted.name.lower(), *aliases.get(wanted.name.lower(), [])]
        own = next((table.fields[n] for n in names if n in table.fields), None)
        if own is None:
            raise ValueError(f"no column {wanted.name}")
        kind, have = wanted.dataType.simpleString(), _spark_name(own.type)
        if have is None or (have != kind and kind not in _WIDER.get(have, ())):
            raise ValueError(f"column {wanted.name} is {have or 'of an unreadable form'} and not {kind}")
        found[wanted.name] = own
    return found


#: What holds all values of a type.
_WIDER = {"smallint": ("int", "bigint", "float", "double"), "int": ("bigint", "double"), "float": ("double",), "bigint": ()}


def _spark_name(kind: str | None) -> str | None:
    """A type as schemas print it."""
    return kind and kind.replace("short", "smallint").replace("long", "bigint")


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    end: int


class EventReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.path, self.schema = options["path"], schema
        self.split, self.extension = int(options.get("split", SPLIT_BYTES)), options.get("extension")
        self.bad, self.aliases = options.get("bad_files", "fail"), aliases_of(options.get("aliases", ""))
        #: Inclusive bounds of columns, as far as they are known; rows outside them need not be read.
        self.bounds: dict[str, tuple[float, float]] = {}
        if "range_of" in options:
            self.bounds[options["range_of"].lower()] = (float(options.get("at_least", "-inf")), float(options.get("at_most", "inf")))

    def partitions(self) -> list[InputPartition]:
        found = [Range(x.path, i, min(x.size, i + self.split)) for x in _listing(self.path) for i in range(0, max(x.size, 1), self.split)]
        return found or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        report = self.bad == "report"
        names = [n for n in self.schema.fieldNames() if not (report and n in _REPORTED)]
        try:
            fs, _ = file_system(self.path)
            with fs.open_input_file(partition.path) as source:
                table = layout(source, self.extension)
                fields = mapped(table, StructType([self.schema[n] for n in names]), self.aliases)
                if report and partition.begin == 0:
                    yield self._reported(partition.path, None, None)
                for batch in self._rows(source, table, fields, partition):
                    yield self._reported(partition.path, None, batch) if report else batch
        except _BAD as e:
            if self.bad == "fail":
                raise
            if report and partition.begin == 0:
                yield self._reported(partition.path, f"{type(e).__name__}: {e}", None)

    def _rows(self, source, table: Layout, fields: dict[str, Field], partition: Range) -> Iterator[pa.RecordBatch]:
        places = table.places()
        # rows that begin in the range
        first, last = (min(table.rows, max(0, -(-(x - table.at) // max(1, table.width)))) for x in (partition.begin, partition.end))
        by = next((n for n in self.bounds if table.sorted_by in [n, *self.aliases.get(n, [])]), None)
        if by is not None:
            first, last = self._between(source, table, places, by, first, last)
        types = {n: _arrow(self.schema[n].dataType.simpleString()) for n in fields}
        for i in range(first, last, BATCH):
            n = min(BATCH, last - i)
            source.seek(table.at + i * table.width)
            rows = np.frombuffer(source.read(n * table.width), np.uint8).reshape(n, table.width)
            columns = []
            for name, field in fields.items():
                raw = rows[:, places[field.name] : places[field.name] + field.width]
                column = field.decode_arrays(raw, source, table.heap) if field.letter in "PQ" else field.decode(raw)
                columns.append(column if types[name] is None else column.cast(types[name]))
            yield pa.RecordBatch.from_arrays(columns, list(fields)) if fields else pa.RecordBatch.from_struct_array(pa.array([{}] * n, pa.struct([])))

    def _between(self, source, table: Layout, places: dict[str, int], by: str, first: int, last: int) -> tuple[int, int]:
        """The rows from ``first`` to ``last`` of a sorted file within the bounds, by bisection: a probe reads one value."""
        field, (low, high) = table.fields[table.sorted_by], self.bounds[by]

        def value(i: int) -> float:
            source.seek(table.at + i * table.width + places[field.name])
            found = field.decode(np.frombuffer(source.read(field.width), np.uint8).reshape(1, -1))[0].as_py()
            return math.inf if found is None else found

        begin = bisect_left(range(last), low, first, key=value)
        return begin, bisect_right(range(last), high, begin, key=value)

    def _reported(self, path: str, error: str | None, batch: pa.RecordBatch | None) -> pa.RecordBatch:
        """Rows with the columns of ``REPORT``; without a batch, the one that stands for the file."""
        n = 1 if batch is None else batch.num_rows
        found = {"file": pa.array([path.rsplit("/", 1)[-1].removesuffix(".fits")] * n, pa.string()), "error": pa.array([error] * n, pa.string()), "is_event": pa.array([batch is not None] * n)}
        names = self.schema.fieldNames()
        return pa.RecordBatch.from_arrays([found[x] if x in found else batch.column(x) if batch is not None else pa.nulls(n, to_arrow_type(self.schema[x].dataType)) for x in names], names)


_REPORTED = tuple(x.split()[0] for x in REPORT.split(", "))


def _arrow(kind: str) -> pa.DataType | None:
    """The Arrow type of a number; None for the others, whose types are never changed."""
    return {"smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64()}.get(kind)


class PushedReader(EventReader):
    """The reader of a session that pushes filters: those that compare a column with a number bound it, and Spark applies all of them again."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            value = getattr(f, "value", None)
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and len(f.attribute) == 1 and isinstance(value, (int, float)) and not isinstance(value, bool):
                low, high = self.bounds.get(f.attribute[0].lower(), (-math.inf, math.inf))
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    low = max(low, value)
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    high = min(high, value)
                self.bounds[f.attribute[0].lower()] = (low, high)
            yield f


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


class EventWriter(DataSourceArrowWriter):
    """Files are written under a temporary name and take theirs when the job commits; what lost tasks left behind then goes."""

    def __init__(self, options: dict, schema: StructType) -> None:
        self.path, self.text, self.job = options["path"], int(options.get("text_width", "32")), uuid.uuid4().hex
        self.by, self.sorted_by, self.extension = options.get("file_by"), options.get("sorted_by"), options.get("extension")
        self.columns = [(f.name, "A" if isinstance(f.dataType, StringType) else _LETTERS[type(f.dataType)], self.text if isinstance(f.dataType, StringType) else 1) for f in schema.fields]
        self.dtype = np.dtype([(n, f"S{w}" if k == "A" else _KINDS[k]) for n, k, w in self.columns])

    def _rows(self, batch: pa.RecordBatch) -> np.ndarray:
        rows = np.zeros(batch.num_rows, self.dtype)
        for (n, k, w), column in zip(self.columns, batch.columns, strict=True):
            if column.null_count:
                raise ValueError(f"column {n} has nulls, which event files can't hold")
            if k == "A":
                texts = column.cast(pa.binary()).to_numpy(zero_copy_only=False)
                if (pc.max(pc.binary_length(column)).as_py() or 0) > w:
                    raise ValueError(f"column {n} has a text of over {w} bytes")
                rows[n] = texts.astype(f"S{w}")
            else:
                rows[n] = column.to_numpy(zero_copy_only=False)
        return rows

    def _file(self, fs: pafs.FileSystem, path: str, parts: list[np.ndarray], called: str | None, spilled: BinaryIO) -> str:
        # with a column that names them, files are written under a task's own name first and take theirs at the commit
        name = f"{path}/{self.job}-{uuid.uuid4().hex}{'' if called is None else f'@{called}'}.fits"
        count = spilled.tell() // self.dtype.itemsize + sum(map(len, parts))
        spilled.seek(0)
        with fs.open_output_stream(f"{name}.part") as out:
            out.write(_cards([("SIMPLE", "T"), ("BITPIX", "8"), ("NAXIS", "0"), ("EXTEND", "T")]))
            fields = [(f"{a}{i}", v) for i, (n, k, w) in enumerate(self.columns, 1) for a, v in (("TTYPE", f"'{n.upper():8}'"), ("TFORM", f"'{w if k == 'A' else 1}{k}'"))]
            out.write(_cards([("XTENSION", "'BINTABLE'"), ("BITPIX", "8"), ("NAXIS", "2"), ("NAXIS1", str(self.dtype.itemsize)), ("NAXIS2", str(count)), ("PCOUNT", "0"), ("GCOUNT", "1"), ("TFIELDS", str(len(self.columns))), *fields, *[(k, f"'{v.upper():8}'") for k, v in (("SORTCOL", self.sorted_by), ("EXTNAME", self.extension)) if v]]))
            shutil.copyfileobj(spilled, out, BATCH)
            for rows in parts:
                out.write(rows.tobytes())
            out.write(b"\0" * (-(count * self.dtype.itemsize) % BLOCK))
        return name

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, path = file_system(self.path)
        fs.create_dir(path, recursive=True)
        names: list[str] = []
        parts: list[np.ndarray] = []
        called = None

        def close() -> None:
            nonlocal parts
            names.append(self._file(fs, path, parts, called, spilled))
            parts = []
            spilled.seek(0)
            spilled.truncate()

        with tempfile.TemporaryFile() as spilled:
            try:
                for batch in batches:
                    for i in range(0, batch.num_rows, BATCH):
                        for name, piece in self._named(batch.slice(i, BATCH)):
                            if name != called:
                                if parts or spilled.tell():
                                    close()
                                called = name
                            parts.append(self._rows(piece))
                            if sum(map(len, parts)) >= FILE_ROWS:
                                if called is None:
                                    close()
                                else:  # a named file stays whole: its length stands before its rows
                                    spilled.writelines(rows.tobytes() for rows in parts)
                                    parts = []
                if parts or spilled.tell() or not names and self.by is None:
                    close()
            except BaseException:
                self._delete(fs, names)
                raise
        return Written(names)

    def _named(self, batch: pa.RecordBatch) -> Iterator[tuple[str | None, pa.RecordBatch]]:
        """Stretches of rows of one file, with its name."""
        if self.by is None:
            yield None, batch
            return
        of = batch.column(self.by).cast(pa.string()).to_pylist()
        edge = [0, *(i for i in range(1, len(of)) if of[i] != of[i - 1]), len(of)]
        for i, j in itertools.pairwise(edge):
            if j > i:
                yield of[i], batch.slice(i, j - i)

    @staticmethod
    def _delete(fs: pafs.FileSystem, names: list[str]) -> None:
        for n in names:
            with contextlib.suppress(OSError):
                fs.delete_file(f"{n}.part")

    def commit(self, messages: list[Written | None]) -> None:
        fs, path = file_system(self.path)
        with ThreadPoolExecutor(16) as pool:
            final = lambda n: n if self.by is None else f"{path}/{n.rsplit('/', 1)[-1].split('@', 1)[1]}"
            list(pool.map(lambda n: fs.move(f"{n}.part", final(n)), [n for m in messages if m is not None for n in m.paths]))
        left = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        self._delete(fs, [x.path.removesuffix(".part") for x in left if x.base_name.startswith(self.job) and x.base_name.endswith(".part")])

    def abort(self, messages: list[Written | None]) -> None:
        fs, path = file_system(self.path)
        left = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        self._delete(fs, [x.path.removesuffix(".part") for x in left if x.base_name.startswith(self.job)])


def _cards(cards: list[tuple[str, str]]) -> bytes:
    text = "".join(f"{k:8}= {v if v.startswith(chr(39)) else v.rjust(20)}".ljust(80) for k, v in cards) + "END".ljust(80)
    return text.ljust(-(-len(text) // BLOCK) * BLOCK).encode("ascii")


class EventFiles(DataSource):
    """``spark.read.format("event_files").load(folder)``.

    Options to read: ``split`` (bytes of a partition), ``extension`` (name of the table to read, by default
    each file's first), ``bad_files`` ("fail", "skip" to leave out files that can't be read or lack an
    asked column, "report" to give a row for each file, with its error, before its own), ``aliases``
    (other names of columns, "time_s=time|t"), ``range_of``, ``at_least``, ``at_most`` (rows outside may
    be left out where files are sorted by that column), ``push`` (take filters of the query, where the
    session pushes them). To write: ``text_width``, ``file_by`` (a column that names the file, for rows
    that come sorted by it), ``sorted_by`` (a column that rows of a file are sorted by), ``extension`` (the table's name).
    """

    @classmethod
    def name(cls) -> str:
        return "event_files"

    def schema(self) -> str:
        path, wrong = self.options["path"], None
        fs, _ = file_system(path)
        for info in _listing(path):
            try:
                with fs.open_input_file(info.path) as source:
                    fields = layout(source, self.options.get("extension")).fields
                found = ", ".join(f"`{n}` {f.type}" for n, f in fields.items() if f.type)
                return f"{found}, {REPORT}" if self.options.get("bad_files") == "report" else found
            except _BAD as e:
                if self.options.get("bad_files", "fail") == "fail":
                    raise
                wrong = e
        raise FileNotFoundError(f"no event file in {path}") from wrong

    def reader(self, schema: StructType) -> EventReader:
        return (PushedReader if self.options.get("push") == "true" else EventReader)(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> EventWriter:
        return EventWriter(self.options, schema)


def write_events(rows: DataFrame, path: str, file_by: str | None = None, sorted_by: str | None = None, extension: str | None = None) -> None:
    """Event files in folder ``path``; ``file_by`` names the column whose values the files are called by, ``sorted_by`` the one they are sorted by, ``extension`` the table."""
    rows.sparkSession.dataSource.register(EventFiles)
    order = [c for c in (file_by, sorted_by) if c]
    rows = rows.repartition(file_by) if file_by else rows
    writer = (rows.sortWithinPartitions(*order) if order else rows).write.format("event_files")
    for name, value in (("file_by", file_by), ("sorted_by", sorted_by), ("extension", extension)):
        writer = writer.option(name, value) if value else writer
    writer.mode("append").save(path)


def read_events(
    spark: SparkSession, path: str, columns: str | None = None, extension: str | None = None, skip_bad: bool = False,
    aliases: dict[str, Sequence[str]] | None = None, between: tuple[str, float, float] | None = None, report: bool = False,
) -> DataFrame:
    """The event tables of all files under ``path``, or only ``columns`` ("name type, ...") of them.

    ``extension`` names another table of the files, such as their own time intervals. ``aliases`` gives
    other names that a column has in some files. ``between`` is a column and the least and greatest
    value asked for; sorted files are read only there, and the rows are filtered in any case.
    ``report`` adds ``file``, ``error`` and ``is_event``: each file gives one row with is_event false and
    all else null, with ``error`` where the file can't be read or lacks a column, and then its events.
    """
    spark.dataSource.register(EventFiles)
    options = {"bad_files": "report" if report else "skip" if skip_bad else "fail"}
    if extension:
        options["extension"] = extension
    if aliases:
        options["aliases"] = ", ".join(f"{k}={'|'.join(v)}" for k, v in aliases.items())
    if between:
        options |= {"range_of": between[0], "at_least": repr(float(between[1])), "at_most": repr(float(between[2]))}
    if spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true":
        options["push"] = "true"
    reader = spark.read.format("event_files").options(**options)
    rows = (reader.schema(f"{columns}, {REPORT}" if report else columns) if columns else reader).load(path)
    if between:
        inside = F.col(between[0]).between(*map(F.lit, between[1:]))
        rows = rows.where(inside | ~F.col("is_event") if report else inside)
    return rows


def check_files(spark: SparkSession, folder: str, extension: str | None = None, columns: str | None = None, aliases: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """(path, file, n_rows, error, columns) of each event file: its header is opened in a task; ``error`` is null where it can be read.

    ``file`` is the name without folder and ending. ``columns`` maps each column, or each of those asked
    for as in ``read_events``, to the file's own name and type of it. The driver only lists names.
    """
    fs_of, names = folder, [x.path for x in _listing(folder)]
    asked = spark.createDataFrame([], columns).schema if columns else None
    other = {k.lower(): [x.lower() for x in v] for k, v in (aliases or {}).items()}
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()))

    def run(batches):
        for batch in batches:
            fs, _ = file_system(fs_of)
            out = []
            for path in batch.column("path").to_pylist():
                rows, error, found = None, None, None
                try:
                    with fs.open_input_file(path) as source:
                        table = layout(source, extension)
                    own = mapped(table, asked, other) if asked else {n: f for n, f in table.fields.items() if f.type}
                    rows, found = table.rows, [(n, f"{f.name} {_spark_name(f.type)}") for n, f in own.items()]
                except _BAD as e:
                    error = f"{type(e).__name__}: {e}"
                out.append((path, path.rsplit("/", 1)[-1].removesuffix(".fits"), rows, error, found))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["path", "file", "n_rows", "error", "columns"])

    paths = spark.createDataFrame([(n,) for n in names], "path string")
    return paths.repartition(max(1, min(len(names), 256))).mapInArrow(run, "path string, file string, n_rows long, error string, columns map<string,string>")


def common_columns(checked: DataFrame) -> str:
    """("name type, ...") of the columns that all readable files of ``check_files`` have, of the widest type among them.

    A column of types that none of them holds is left out. One row for each different column reaches the driver.
    """
    kind = F.element_at(F.split("own", " "), -1)
    each = checked.where("error IS NULL").select(F.explode("columns").alias("name", "own")).groupBy("name").agg(F.collect_set(kind).alias("kinds"), F.count("*").alias("n"))
    total = checked.where("error IS NULL").count()
    found = []
    for row in each.where(F.col("n") == total).orderBy("name").collect():
        wide = next((k for k in row["kinds"] if all(k == o or k in _WIDER.get(o, ()) for o in row["kinds"])), None)
        if wide:
            found.append(f"`{row['name']}` {wide}")
    return ", ".join(found)


def ingest_events(spark: SparkSession, files: str, table: str, columns: str | None = None, aliases: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Decode event files once into a Parquet table partitioned by week, and scan that.

    Files that can't be read, or lack one of ``columns`` (by default, those of the first that can be
    read), are left out; ``check_files`` names them for the failure gate.
    """
    read_events(spark, files, columns, skip_bad=True, aliases=aliases).write.mode("overwrite").partitionBy("week").parquet(table)
    return spark.read.parquet(table)
