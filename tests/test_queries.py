"""Every query of the driver's tables against its SQL."""

import glob
import os

import duckdb
import pytest

from sedimenta.plans.queries import QUERIES, flagship
from sedimenta.plans.sql import SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def test_each_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    order = sorted(df.columns)
    want = con.sql(SQL[name])
    assert sorted(want.columns) == order
    assert sorted(map(repr, (tuple(r) for r in df.select(*order).collect()))) == sorted(map(repr, want.select(*order).fetchall()))


def test_entry(spark, sf_dir):
    assert flagship(spark, sf_dir).count() > 0


def test_plans(spark, sf_dir):
    plan = QUERIES["q04_range_tombstone"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "Cartesian" not in plan and "BroadcastNestedLoopJoin" not in plan
    plan = QUERIES["q01_lww"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "props" not in plan
