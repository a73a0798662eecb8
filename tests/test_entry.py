import duckdb
import pytest

import __spark_entry__ as entry
from transitlake.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order]) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(columns, want.fetchall())


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_plans_have_no_python_and_prune_columns(spark):
    plan = QUERIES["compact_closed"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "props" not in plan and "Window" not in plan
