"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

A source's rows are numbered in a fixed pseudo-random order and cut into blocks. Time is a row of
slots, one block each. Target weights become whole quanta; in a period of as many slots as there
are quanta, block i of a source with q of T quanta may not start before its release
floor(i T / q) and must be done by its deadline ceil((i + 1) T / q). Earliest deadline first among
the released blocks meets all deadlines (unit jobs on one processor), so a source is never a whole
block ahead of or behind its share. The schedule repeats from period to period; when a source has
less than a period's blocks left, one closing period uses them up and the others go on at their
weights in proportion. Every row gets a slot: nothing is dropped or repeated.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm._common import table

BLOCK_ROWS = 16
#: Slots of a period (four for each source if there are more than a quarter as many).
QUANTA = 256
#: Rows of one source and hash bucket that are ordered in a task, at least (and eight times the buckets' number); equal rows share a hash.
HOT_ROWS = 16_384
#: Up to so many sources the schedule is broadcast: it has at most 2 x sources x quanta rows.
BROADCAST_SOURCES = 64


def quanta_of(weights: list[float], total: int = QUANTA) -> list[int]:
    """Whole quanta in proportion to ``weights`` by largest remainder, at least one each."""
    total = max(total, 4 * len(weights))
    scale = (total - len(weights)) / sum(weights)
    exact = [w * scale for w in weights]
    whole = [1 + int(x) for x in exact]
    order = sorted(range(len(weights)), key=lambda k: (int(exact[k]) - exact[k], k))
    for k in order[: total - sum(whole)]:
        whole[k] += 1
    return whole


def phases_of(blocks: list[int], quanta: list[int]) -> list[dict]:
    """Runs of equal periods: first slot, slots of a period, and for each source (number, share, first block, end)."""
    left, slot, found = list(blocks), 0, []
    done = [0] * len(blocks)
    while any(left):
        active = [s for s, n in enumerate(left) if n]
        periods = min(left[s] // quanta[s] for s in active)
        share = {s: quanta[s] if periods else min(quanta[s], left[s]) for s in active}
        periods = max(1, periods)
        size = sum(share.values())
        found.append({"slot": slot, "size": size, "members": [{"source": s, "share": q, "first": done[s], "end": done[s] + periods * q} for s, q in share.items()]})
        slot += periods * size
        for s, q in share.items():
            done[s] += periods * q
            left[s] -= periods * q
    return found


def schedule(phases: DataFrame) -> DataFrame:
    """Earliest deadline first over one period of each phase: (phase, source, nth, at, release, deadline) rows."""
    shares, size = F.col("members.share"), F.col("size")
    far = F.lit(2**62)

    def step(acc, t):
        done = acc["done"]
        due = F.transform(
            F.arrays_zip(done.alias("n"), shares.alias("q")),
            lambda x: F.when((x["n"] < x["q"]) & (F.floor(x["n"] * size / x["q"]) <= t), F.ceil((x["n"] + 1) * size / x["q"])).otherwise(far),
        )
        pick = F.array_position(due, F.array_min(due)).cast("int")
        return F.struct(
            F.transform(done, lambda x, i: F.when(i + 1 == pick, x + 1).otherwise(x)).alias("done"),
            F.concat(acc["order"], F.array(F.struct((pick - 1).alias("member"), F.element_at(done, pick).alias("nth")))).alias("order"),
        )

    start = F.struct(F.transform(shares, lambda _: F.lit(0).cast("long")).alias("done"), F.lit([]).cast("array<struct<member:int,nth:bigint>>").alias("order"))
    order = F.aggregate(F.sequence(F.lit(0).cast("long"), size - 1), start, step)["order"]
    rows = phases.select("phase", "size", "members", F.posexplode(order).alias("at", "job"))
    member = F.col("members")[F.col("job.member")]
    return rows.select(
        "phase", member["source"].alias("number"), F.col("job.nth").alias("nth"), F.col("at").cast("long").alias("at"),
        F.floor(F.col("job.nth") * size / member["share"]).alias("release"), F.ceil((F.col("job.nth") + 1) * size / member["share"]).alias("deadline"),
    )


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS, quanta: int = QUANTA) -> DataFrame:
    """``docs`` plus mix_block, mix_row, mix_slot, mix_release and mix_deadline; order by (mix_slot, mix_row) to mix.

    ``weights`` gives each ``source`` its target (any positive scale; one that is not named weighs
    as little as the least of those named); by default a source weighs as the square root of its
    rows. mix_block counts a source's blocks, mix_slot the blocks of the whole mixture, mix_row the
    rows of a block. A null source is a source of its own. Equal rows are interchangeable, and where
    very many are equal they are numbered in parts by their place in the table, which then has to be
    a scan; an empty table gives an empty result; input columns named mix_* are replaced.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if not c.startswith("mix_")]
    rows = docs.select(*[F.col(f"`{c}`") for c in own])
    total = rows.count()
    buckets = max(1, int(total**0.5))
    rows = rows.withColumn("mix_hash", F.xxhash64(*[F.col(f"`{c}`") for c in own]))
    rows = rows.withColumn("mix_key", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))).withColumn("mix_bucket", F.pmod("mix_hash", F.lit(buckets)))
    sizes = rows.groupBy("mix_key", "mix_bucket").agg(F.count("*").alias("n"))
    held = sizes.groupBy("mix_key").agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
    found = sorted((r["mix_key"], r["n"]) for r in held)
    limit = max(HOT_ROWS, 8 * buckets)
    if any(r["most"] > limit for r in held):
        # at most total / limit rows
        parts = sizes.where(F.col("n") > limit).select("mix_key", "mix_bucket", F.ceil(F.col("n") / limit).alias("mix_parts"))
        rows = rows.withColumn("mix_place", F.xxhash64(F.monotonically_increasing_id())).join(F.broadcast(parts), ["mix_key", "mix_bucket"], "left")
        rows = rows.withColumn("mix_sub", F.pmod("mix_place", F.coalesce("mix_parts", F.lit(1)))).drop("mix_place", "mix_parts")
    else:
        rows = rows.withColumn("mix_sub", F.lit(0).cast("long"))
    sizes = rows.groupBy("mix_key", "mix_bucket", "mix_sub").agg(F.count("*").alias("n"))
    names = [k for k, _ in found]
    least = min([w for w in (weights or {}).values() if w > 0], default=1.0)
    target = [n**0.5 if weights is None else max(weights.get(k[1:], 0) if k else 0, 0) or least for k, n in found]
    plan = phases_of([-(-n // block_rows) for _, n in found], quanta_of(target, quanta)) if found else []
    shape = "array<struct<phase:int,slot:bigint,size:bigint,members:array<struct<source:bigint,share:bigint,first:bigint,end:bigint>>>>"
    phases = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps([p | {"phase": i} for i, p in enumerate(plan)])), shape)))
    number = F.from_json(F.lit(json.dumps([{"mix_key": k, "number": i} for i, k in enumerate(names)])), "array<struct<mix_key:string,number:bigint>>")
    numbers = spark.range(1).select(F.inline(number))
    spans = phases.select("phase", "slot", "size", F.inline("members")).withColumnRenamed("source", "number")
    spans = spans.join(numbers, "number").select("mix_key", *[F.col(c).alias(f"mix_{n}") for c, n in (("phase", "phase"), ("slot", "base"), ("size", "size"), ("share", "share"), ("first", "first"), ("end", "end"))])
    jobs = schedule(phases.repartition("phase")).join(numbers, "number").select("mix_key", *[F.col(c).alias(f"mix_{n}") for c, n in (("phase", "phase"), ("nth", "of"), ("at", "at"), ("release", "from"), ("deadline", "due"))])
    if len(names) <= BROADCAST_SOURCES:
        spans, jobs = F.broadcast(spans), F.broadcast(jobs)

    before = Window.partitionBy("mix_key").orderBy("mix_bucket", "mix_sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("mix_key", "mix_bucket", "mix_sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("mix_start"))
    inside = Window.partitionBy("mix_key", "mix_bucket", "mix_sub").orderBy("mix_hash")
    index = F.col("mix_start") + F.col("mix_nth") - 1
    rows = rows.withColumn("mix_nth", F.row_number().over(inside)).join(starts, ["mix_key", "mix_bucket", "mix_sub"])
    rows = rows.withColumn("mix_block", F.floor(index / block_rows)).withColumn("mix_row", (index % block_rows).cast("int"))
    here = (F.col("mix_block") >= F.col("mix_first")) & (F.col("mix_block") < F.col("mix_end"))
    rows = rows.join(spans, "mix_key").where(here).withColumn("mix_of", (F.col("mix_block") - F.col("mix_first")) % F.col("mix_share"))
    rows = rows.join(jobs, ["mix_key", "mix_phase", "mix_of"])
    begin = F.col("mix_base") + F.floor((F.col("mix_block") - F.col("mix_first")) / F.col("mix_share")) * F.col("mix_size")
    return rows.select(
        *[F.col(f"`{c}`") for c in own], "mix_block", "mix_row",
        *[(begin + F.col(f"mix_{c}")).alias(f"mix_{n}") for c, n in (("at", "slot"), ("from", "release"), ("due", "deadline"))],
    )


def mixed_order(docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with its own columns, sorted into the order of the mixture."""
    kept = [c for c in docs.columns if not c.startswith("mix_")]
    rows = mix(docs, weights, block_rows)
    return rows.repartitionByRange("mix_slot", "mix_row").sortWithinPartitions("mix_slot", "mix_row").select(*[F.col(f"`{c}`") for c in kept])


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
