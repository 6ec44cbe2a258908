"""Every registered sky-map query against its oracle text on the same tables."""

from __future__ import annotations

import pytest

from starloom.plans.jobs import ORACLE_SQL, QUERIES


def rows(values):
    return sorted((tuple(v + 0.0 if isinstance(v, float) else v for v in r) for r in values), key=repr)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    wanted = duck.sql(ORACLE_SQL[name])
    assert sorted(wanted.columns) == columns
    named = ", ".join(f'"{c}"' for c in columns)
    assert rows(found.select(columns).collect()) == rows(duck.sql(f"SELECT {named} FROM ({ORACLE_SQL[name]})").fetchall())


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert QUERIES.keys() <= __spark_entry__.queries().keys()
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()
