"""Every registered query with SQL, compared with that SQL on the same files."""

import duckdb
import pytest

import __spark_entry__ as entry
from fieldbook.registry.tables import BASE

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for name in BASE:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return c


def normal(v):
    return "\0null" if v is None else repr(v) if isinstance(v, float) else str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(SQL[name])
    want = rows([d[0] for d in cur.description], cur.fetchall())
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == want


def test_every_key_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", ["curated_parcels", "j05_gap_detection", "w04_headline_series", "r08_priority_rank", "j11_radius_rights"])
def test_plans_have_no_cross_join(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_component_join_becomes_inner(spark):
    """The filter on the component rejects nulls, so the planner drops the outer join."""
    plan = entry.queries()["j08_components"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    components = [line for line in plan.splitlines() if line.strip(" :+-").startswith("Join")]
    assert any("Inner" in line and "mukey" in line for line in components)


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
