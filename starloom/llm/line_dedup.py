"""Line dedup: repeated runs of lines, from a suffix array over line-ID sequences made by distributed prefix doubling.

1. A line's ID is a 128-bit hash. A place's rank is 1 plus the number of places whose suffix is
   smaller, as far as lines are compared yet; at first that is one line. Ranks come from a range
   sort of the *different* keys with their numbers of places, so a common line is one row.
2. A round orders places of equal rank by the rank of the place as many lines on as were compared
   so far, and so doubles that number. Places whose rank is unique, or whose text ends, are done;
   rounds go on until all are. Lines that occur once never take part.
3. Suffixes that are neighbours in the order and were parted in the round of h lines share h to 2h - 1
   of them. The exact longest common prefix is found by comparing lines; where neighbours stand on
   one diagonal of the same two texts only the first is compared, as each later one shares a line less.
4. Cutting the order where the common prefix is under ``lines`` leaves the intervals of places that
   start the same run of so many lines. All but an interval's first place are later copies, and what
   they cover is deleted. A line of ``LONG_LINE_WORDS`` words is a run by itself.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm._common import discard, free_name, stored, table

MIN_LINES = 2
#: A repeated line of so many words is a passage, whatever stands around it.
LONG_LINE_WORDS = 50
_WORD = r"[^\x20\x09-\x0D]+"


def _lines(docs: DataFrame, long_words: int) -> DataFrame:
    """(row, line, a, b, long): a line's 128-bit ID, and whether it is a run by itself."""
    long = lambda x: F.when(F.length(x) >= 2 * long_words - 1, F.regexp_count(x, F.lit(_WORD)) >= long_words).otherwise(False)
    each = F.transform(F.split("text", "\n"), lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b"), long(x).alias("long")))
    return docs.where(F.col("text").isNotNull()).select("row", F.posexplode(each).alias("line", "id")).select("row", "line", "id.*")


def _scanned(rows: DataFrame, keys: list[str], value: str, how: str) -> DataFrame:
    """``rows`` in the order of ``keys`` plus ``before``: the running sum (without the row itself) or maximum (with it) of ``value``.

    Ranges of keys are scanned in tasks of their own; the driver sees one number for each of them.
    """
    schema = rows.select("*").schema.add("before", "long").add("part", "integer")

    def run(batches):
        held = 0
        for batch in batches:
            values = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            if how == "sum":
                done = np.cumsum(values)
                out = held + done - values
                held += int(done[-1]) if len(done) else 0
            else:
                out = np.maximum(np.maximum.accumulate(values), held) if len(values) else values
                held = int(out[-1]) if len(out) else held
            part = np.full(len(values), TaskContext.get().partitionId(), np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out), pa.array(part)], schema.fieldNames())

    found = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema), "scan")
    total = {r["part"]: r["total"] for r in found.groupBy("part").agg((F.sum(value) if how == "sum" else F.max(value)).alias("total")).collect()}
    held, starts = 0, []
    for part in sorted(total):
        starts.append((part, held))
        held = held + total[part] if how == "sum" else max(held, total[part])
    starts = rows.sparkSession.createDataFrame(starts, "part int, start long")
    before = F.col("before") + F.col("start") if how == "sum" else F.greatest("before", "start")
    return found.join(F.broadcast(starts), "part").withColumn("before", before).drop("part", "start")


def _updated(docs: DataFrame, changes: DataFrame) -> DataFrame:
    """``docs`` (row, ranks, active) with the ranks of ``changes`` (row, line, rank, active) put in."""
    lists = changes.groupBy("row").agg(F.collect_list(F.struct("line", "rank", "active")).alias("changes"))

    def run(batches):
        for batch in batches:
            out = []
            for ranks, active, changed in zip(batch.column("ranks"), batch.column("active"), batch.column("changes"), strict=True):
                ranks, active = ranks.values.to_numpy().copy(), active.values.to_numpy(zero_copy_only=False).copy()
                active[:] = False
                if changed.is_valid:
                    at = changed.values.field("line").to_numpy()
                    ranks[at], active[at] = changed.values.field("rank").to_numpy(), changed.values.field("active").to_numpy(zero_copy_only=False)
                out.append((ranks, active))
            lists = [pa.array([x[k] for x in out], pa.list_(t)) for k, t in enumerate((pa.int64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *lists], ["row", "ranks", "active"])

    return docs.join(lists, "row", "left").mapInArrow(run, "row long, ranks array<long>, active array<boolean>")


def suffix_order(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Suffix order of the repeated lines in ``lines`` (row, line, a, b).

    Gives the places (row, line, rank, left: lines to the text's end), the classes of equal suffixes
    (rank, n, parted: the lines compared before the class was parted from the one before it), and
    (row, ranks) with all first ranks of the texts concerned, which stand for line IDs.
    """
    names = _scanned(lines.groupBy("a", "b").agg(F.count("*").alias("n")), ["a", "b"], "n", "sum")
    names = stored(names.select("a", "b", "n", (F.col("before") + 1).alias("rank")), "names")
    first = stored(lines.join(names, ["a", "b"]).select("row", "line", "rank", (F.col("n") > 1).alias("active")), "places")
    lists = first.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("line", "rank", "active"))).alias("all"), F.max("active").alias("some")).where("some")
    docs = stored(lists.select("row", F.col("all.rank").alias("ranks"), F.col("all.active").alias("active")), "ranks")
    initial, width = docs.select("row", "ranks"), 1
    # How far the first class of a rank was parted from the class before it; a rank that is only split keeps it.
    parted = [names.where("n > 1").select("rank", F.lit(0).alias("parted"))]
    # Texts without an active place are finished where they are and not written again.
    going, steps, finished = docs, [names, first], []
    while True:
        beyond = F.coalesce(F.get("ranks", F.col("line") + width), F.lit(0).cast("long"))
        places = going.select("row", "ranks", F.posexplode("active").alias("line", "now")).where("now").select("row", "line", F.get("ranks", "line").alias("rank"), beyond.alias("second"))
        scanned = _scanned(places.groupBy("rank", "second").agg(F.count("*").alias("n")), ["rank", "second"], "n", "sum")
        base = scanned.groupBy("rank").agg(F.min("before").alias("base"))
        new = scanned.join(base, "rank").withColumn("new", F.col("rank") + F.col("before") - F.col("base")).withColumn("again", (F.col("n") > 1) & (F.col("second") > 0))
        new = stored(new, "keys")
        parted.append(new.where("new > rank").select(F.col("new").alias("rank"), F.lit(width).alias("parted")))
        # Each place has its key; a left join never broadcasts the exploded places, which Spark takes for as small as their texts' files.
        changes = places.join(new.select("rank", "second", "new", "again"), ["rank", "second"], "left").select("row", "line", F.col("new").alias("rank"), F.col("again").alias("active"))
        docs = stored(_updated(going, changes), "ranks")
        some = F.exists("active", lambda x: x)
        finished.append(docs.where(~some).select("row", "ranks"))
        going, width = docs.where(some), width * 2
        steps += [new, docs]
        if going.isEmpty():
            break
    depths = reduce(DataFrame.union, parted)
    ranked = reduce(DataFrame.union, finished)
    repeated = first.where("active").select("row", "line")
    final = ranked.select("row", F.size("ranks").alias("size"), F.posexplode("ranks").alias("line", "rank")).join(repeated.hint("merge"), ["row", "line"], "left_semi")
    final = stored(final.select("row", "line", "rank", (F.col("size") - F.col("line")).alias("left")), "order")
    groups = final.groupBy("rank").agg(F.count("*").alias("n"), F.min(F.struct("row", "line")).alias("least"))
    groups = stored(groups.join(depths.groupBy("rank").agg(F.max("parted").alias("parted")), "rank").select("rank", "n", "parted", "least.row", "least.line"), "classes")
    discard(*steps)
    return final, groups, initial


def common_prefixes(classes: DataFrame, initial: DataFrame) -> DataFrame:
    """(rank, n, lcp) of ``classes``: the lines that a class shares with the class before it in the suffix order."""
    ahead = classes.select((F.col("rank") + F.col("n")).alias("rank"), F.col("row").alias("other"), F.col("line").alias("place"))
    pairs = classes.where("parted > 0").join(ahead, "rank")
    diagonal = Window.partitionBy("row", "other", F.col("line") - F.col("place")).orderBy("line")
    opens = F.coalesce(F.col("line") - F.lag("line").over(diagonal) > 1, F.lit(True))
    pairs = stored(pairs.withColumn("start", F.max(F.when(opens, F.col("line"))).over(diagonal)), "pairs")
    # Lines parted - 1 on are known to be equal; at most as many more have to be compared.
    # Merged: ranks of copies take little room in files, by which Spark would choose to broadcast them.
    initial = initial.hint("merge")
    starts = pairs.where("line = start")
    part = F.slice("ranks", F.col("at") + F.col("parted") + 1, F.col("parted"))
    here = starts.select("row", "line", "other", "place", "parted", F.col("line").alias("at")).join(initial, "row").withColumn("x", part).drop("ranks", "at")
    there = here.withColumn("at", F.col("place")).join(initial.withColumnRenamed("row", "other"), "other").withColumn("y", part)
    differ = F.array_position(F.transform(F.arrays_zip("x", "y"), lambda z: F.coalesce(z["x"] == z["y"], F.lit(False))), False)
    same = F.when(differ > 0, differ - 1).otherwise(F.least(F.size("x"), F.size("y")))
    shared = stored(there.select("row", F.col("line").alias("start"), "other", (F.col("line") - F.col("place")).alias("shift"), (F.col("parted") + same).alias("most")), "prefixes")
    known = pairs.withColumn("shift", F.col("line") - F.col("place")).join(shared, ["row", "start", "other", "shift"]).select("rank", (F.col("most") - (F.col("line") - F.col("start"))).alias("lcp"))
    return classes.join(known, "rank", "left").select("rank", "n", F.coalesce("lcp", F.lit(0)).cast("long").alias("lcp"))


def longest_repeats(docs: DataFrame) -> DataFrame:
    """(row, line, length): for each line of ``docs`` (row, text) that occurs again, the longest run from there that stands elsewhere too."""
    places, classes, initial = suffix_order(stored(_lines(docs, LONG_LINE_WORDS), "lines"))
    found = stored(common_prefixes(classes, initial), "lcp")
    after = found.select(F.col("rank").alias("next"), F.col("lcp").alias("lcp_next"))
    best = found.join(after, F.col("rank") + F.col("n") == F.col("next"), "left").select("rank", "n", F.greatest("lcp", F.coalesce("lcp_next", F.lit(0))).alias("most"))
    return places.join(best, "rank").select("row", "line", F.when(F.col("n") > 1, F.col("left")).otherwise(F.col("most")).cast("int").alias("length"))


def repeated_runs(docs: DataFrame, lines: int = MIN_LINES) -> DataFrame:
    """(row, line, length) of the maximal repeated runs of ``lines`` lines or more: those that no longer repeat from the line before includes."""
    before = F.lag("length").over(Window.partitionBy("row").orderBy("line"))
    follows = F.lag("line").over(Window.partitionBy("row").orderBy("line")) == F.col("line") - 1
    rows = longest_repeats(docs).withColumn("tail", F.coalesce(follows & (before > F.col("length")), F.lit(False)))
    return rows.where((F.col("length") >= lines) & ~F.col("tail")).drop("tail")


def _later(places: DataFrame, docs: DataFrame, by: str) -> DataFrame:
    """(row, line) of all places of each ``by`` but the first, by doc_id (null: last), row and line."""
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "row", "line")
    places = stored(places.join(docs, "row"), "places")
    first = stored(places.groupBy(by).agg(F.min(place).alias("first")), "firsts")
    return places.join(first, by).where((F.col("row") != F.col("first.row")) | (F.col("line") != F.col("first.line"))).select("row", "line")


def later_copies(docs: DataFrame, lines: int, long_words: int) -> DataFrame:
    """(row, line, length): runs of ``length`` lines of ``docs`` (row, doc_id, text) that also start earlier and are to be deleted."""
    ids = docs.select("row", "doc_id")
    each = stored(_lines(docs, long_words), "lines")
    places, classes, initial = suffix_order(each.drop("long"))
    heads = common_prefixes(classes, initial).withColumn("head", F.when(F.col("lcp") < lines, F.col("rank")).otherwise(F.lit(0)))
    intervals = stored(_scanned(heads.select("rank", "head"), ["rank"], "head", "max").select("rank", F.col("before").alias("interval")), "intervals")
    runs = _later(places.where(F.col("left") >= lines).join(intervals, "rank").select("row", "line", "interval"), ids, "interval").withColumn("length", F.lit(lines))
    if lines == 1:
        return runs
    long = each.where("long").select("row", "line", F.struct("a", "b").alias("id"))
    return runs.union(_later(long, ids, "id").withColumn("length", F.lit(1)))


def dedup_lines(docs: DataFrame, lines: int = MIN_LINES, long_words: int = LONG_LINE_WORDS) -> DataFrame:
    """``docs`` with its lines' later copies deleted, plus line_count, lines_removed and runs_removed.

    A run of at least ``lines`` lines, or one line of at least ``long_words`` words, is deleted where
    the same lines also start earlier; earlier is a smaller doc_id (null: last), then an earlier place
    in the table, then in the text; copies are judged on the input and may overlap. Lines end at
    newlines only and are compared as they are. A null text has no lines and stays null; an empty one
    is one empty line; a text that loses all lines becomes empty. Repeated rows are later copies of
    the first. Other columns pass through whatever their names, except that the three new ones
    replace their namesakes. ``docs`` has to be a table scan: its rows are told apart by their place in it.
    """
    own = [c for c in docs.columns if c not in ("line_count", "lines_removed", "runs_removed")]
    row, marks = free_name(own, "row"), free_name(own, "marks")
    rows = docs.select(*[F.col(f"`{c}`") for c in own], F.monotonically_increasing_id().alias(row))
    starts = later_copies(rows.select(F.col(row).alias("row"), "doc_id", "text"), lines, long_words)
    starts = starts.groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("line", "length")).alias(marks))
    schema = docs.select(*[F.col(f"`{c}`") for c in own]).schema.add("line_count", "long").add("lines_removed", "long").add("runs_removed", "long")

    def run(batches):
        for batch in batches:
            texts, lists = batch.column("text"), batch.column(marks)
            text, count, removed, runs = [], [], [], []
            for k in range(batch.num_rows):
                whole = texts[k].as_py()
                n = 0 if whole is None else whole.count("\n") + 1
                if not lists[k].is_valid:
                    found = (whole, n, 0, 0)
                else:
                    change = np.zeros(n + lines + 1, np.int32)
                    at, length = (lists[k].values.field(c).to_numpy() for c in ("line", "length"))
                    np.add.at(change, at, 1)
                    np.add.at(change, at + length, -1)
                    gone = np.cumsum(change)[:n] > 0
                    kept = [x for x, g in zip(whole.split("\n"), gone.tolist(), strict=True) if not g]
                    found = ("\n".join(kept), n, int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                for values, value in zip((text, count, removed, runs), found, strict=True):
                    values.append(value)
            new = {"text": pa.array(text, pa.string()), "line_count": pa.array(count, pa.int64()), "lines_removed": pa.array(removed, pa.int64()), "runs_removed": pa.array(runs, pa.int64())}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in schema.fieldNames()], schema.fieldNames())

    return rows.join(starts, row, "left").drop(row).mapInArrow(run, schema)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "line_count", "lines_removed", "runs_removed", F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS following,
         len(line) >= 99 AND len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50 AS long FROM l
), f AS (
  SELECT *, following IS NOT NULL AND row_number() OVER (PARTITION BY line, following ORDER BY doc_id, i) > 1 AS later,
         long AND row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1 AS later_long FROM w
), g AS (
  SELECT *, later OR later_long OR coalesce(lag(later) OVER (PARTITION BY doc_id ORDER BY i), false) AS gone FROM f
), h AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM g
)
SELECT doc_id, count(*) AS line_count, count(*) FILTER (WHERE gone) AS lines_removed, count(*) FILTER (WHERE starts) AS runs_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM h GROUP BY doc_id
UNION ALL
SELECT doc_id, 0, 0, 0, NULL FROM documents WHERE text IS NULL
"""
