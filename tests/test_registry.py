"""Every registered query against its SQL on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from lakemart.registry import lake

# The operators for text corpora register more; they have tests of their own.
NAMES = [name for name, run in contract.queries().items() if run.__module__.startswith("lakemart.registry")]

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, oracle, rows, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = oracle.execute(contract.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = sorted((tuple(row) for row in result.fetchall()), key=repr)
    assert rows(df, *names) == expected


def test_every_backfill_query_runs_a_backfill(spark, monkeypatch):
    """Also after another one of the same session, and when it is repeated."""
    built = []
    monkeypatch.setattr(lake, "write_sources", lambda spark, sf_dir, path: {"of": path})
    monkeypatch.setattr(lake.jobs, "backfill", lambda spark, sources, path, *args, **options: built.append(path))
    monkeypatch.setattr(lake, "read_table", lambda spark, path: path)
    for mart in ("orders", "order_items", "order_statuses", "orders"):
        assert lake.backfilled(spark, SF_DIR, mart) == lake.jobs.trusted_path(built[-1], mart)
    assert len(set(built)) == 4


def test_entry(spark):
    assert contract.entry(spark).count() == 1500
