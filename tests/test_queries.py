"""Every registered query that has SQL gives DuckDB's rows on the smallest tables; the others run."""

import os

import duckdb
import pytest

import loomwright.plans.decision_queries
import loomwright.plans.more_queries
import loomwright.plans.nested_queries
import loomwright.plans.record_queries
import loomwright.plans.report_queries
import loomwright.plans.rule_queries
import loomwright.plans.source_queries
import loomwright.plans.text_queries  # noqa: F401
from loomwright.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return round(value, 5)
    if hasattr(value, "isoformat"):
        return value.isoformat()[:19].removesuffix("T00:00:00")
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    rows = got.collect()
    if name not in ORACLE_SQL:
        assert rows
        return
    result = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    order = sorted(columns)
    want = sorted(repr([plain(dict(zip(columns, r, strict=True))[c]) for c in order]) for r in result.fetchall())
    assert sorted(repr([plain(r[c]) for c in order]) for r in rows) == want


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
