"""The pipeline's stages against plain versions, each on its own input."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from starloom.llm import packing
from starloom.llm._common import stored
from tests.llm.test_brute_force import plain_groups, plain_lines


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def shingles(text):
    """The set of five-word shingles; a shorter text is one."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    start = by_id(docs)
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "simhash", "mixing", "packing"]

    known = stored(stages["language_id"](spark, docs, sf_dir))
    kept = by_id(known)
    assert all(kept[i] == start[i] for i in kept) and len(kept) >= 0.98 * len(start)

    lines = stored(stages["line_dedup"](spark, known, sf_dir))
    order = sorted(kept)
    wanted = {i: t for i, t in zip(order, plain_lines([kept[i]["text"] for i in order], 2), strict=True)}
    found = by_id(lines)
    whole_copies = {i for i in order if wanted[i] == "" and kept[i]["text"] != ""}
    assert {i: r["text"] for i, r in found.items()} == {i: t for i, t in wanted.items() if i not in whole_copies}
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())

    distinct = stored(stages["simhash"](spark, lines, sf_dir))
    sets = {i: shingles(r["text"]) for i, r in found.items()}
    groups = plain_groups(sorted(sets.items()), lambda x, y: 5 * len(x & y) >= 4 * len(x | y))
    assert by_id(distinct) == {i: r for i, r in found.items() if groups[i] == i}

    mixed = stored(stages["mixing"](spark, distinct, sf_dir))
    assert by_id(mixed) == by_id(distinct)

    packed = stages["packing"](spark, mixed, sf_dir)
    assert packed.agg(F.sum("n_chars")).first()[0] == mixed.agg(F.sum(F.length("text"))).first()[0]
    over = packed.groupBy("bin_id").agg(F.sum("n_chars").alias("n"), F.max("capacity").alias("c")).where("n > c")
    assert over.count() == 0 and {r["capacity"] for r in packed.select("capacity").distinct().collect()} <= set(packing.LENGTHS)


def test_run_gives_the_last_stage(spark, sf_dir):
    found = pipeline.run(spark, sf_dir)
    assert found.columns == ["doc_id", "piece", "start", "n_chars", "bin_id", "position", "capacity"] and found.count() > 0


def test_stages_do_not_depend_on_order_of_rows(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.orderBy(F.desc("doc_id")).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    again = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in pipeline.STAGES[1:3]:
        assert sorted(stage(spark, docs, sf_dir).collect()) == sorted(stage(spark, again, sf_dir).collect())
