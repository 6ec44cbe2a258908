"""What operators leave in the shared folder, and the tasks that small tables take."""

from __future__ import annotations

import os
import random

from starloom.llm._common import stored
from starloom.llm._components import connected_components
from starloom.llm.simhash import similar_groups


def test_components_and_similar_groups_leave_few_tables_and_tasks(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    tables = lambda: {os.path.join(d, x) for d, names, _ in os.walk(folder) for x in names if x.startswith("rdd-") or os.path.exists(os.path.join(d, x, "_SUCCESS"))}
    held, context, before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}, spark.sparkContext, tables()
    try:
        for k, v in zip(held, ("16", "false"), strict=True):
            spark.conf.set(k, v)
        context.setJobGroup("components", "")
        edges = spark.createDataFrame([(x, x + 1) for x in range(100, 220, 2)] + [(x, x + 1) for x in range(101, 220, 2)], "a long, b long").repartition(4)
        found = connected_components(edges)
        tracker = context.statusTracker()
        stages = {s for job in tracker.getJobIdsForGroup("components") for s in tracker.getJobInfo(job).stageIds}
        tasks = sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))
        assert {r["node"]: r["root"] for r in found.collect()} == dict.fromkeys(range(100, 221), 100)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(tables() - before) == 1  # the last round's edges
    assert tasks < 1000
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(200)]
    texts = [" ".join(words[i : i + 60]) for i in range(0, 60, 3) for _ in range(2)]
    docs, before = stored(spark.createDataFrame(list(enumerate(texts)), "row long, text string")), tables()
    assert len({r["part"] for r in similar_groups(docs).collect()}) <= 20
    assert len(tables() - before) <= 4  # rows' names, their parts, and the edges of two calls
