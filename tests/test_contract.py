"""Every registered query against its SQL twin."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from tests import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("name", list(contract._sensor_queries()))
def test_query(spark, con, name):
    good, note = compare.compare(spark, con, name, SF_DIR)
    assert good, note


@pytest.mark.parametrize("name", ["dedup", "clean"])
def test_instruments_with_equal_counts_and_means(spark, tmp_path, name):
    """Ten instruments at one station, each day with one reading that is missing or small and a
    pair around one mean: count and mean are equal, extremes are not."""
    con = duckdb.connect()
    con.execute("create table region as select 0::int as r_regionkey, 'R' as r_name")
    con.execute("create table nation as select i::int as n_nationkey, 'N' || i as n_name, 0::int as n_regionkey from range(25) t(i)")
    con.execute(
        """create table events as select row_number() over () as event_id,
          timestamp '2024-01-01 05:00:00' + to_days(day::int) + to_seconds(n * 60 + user) as ts, user * 25 as user_id,
          kind as event_type, 20 + (1 - 2 * n) * ((user * 7 + day) % 10)::double as value,
          case when kind = 'view' and n = 0 then '{"k": 93}' else '{"k": 0}' end as props
        from range(12) d(day), range(10) u("user"), range(2) r(n), (values ('click'), ('view')) k(kind)"""
    )
    for table in ("region", "nation", "events"):
        con.execute(f"copy {table} to '{tmp_path}/{table}.parquet' (format parquet)")
    good, note = compare.compare(spark, con, name, str(tmp_path))
    assert good, note


def test_entry(spark):
    ranked = contract.entry(spark)
    assert ranked.count() == 10


def test_twins_belong_to_queries():
    assert set(contract._sensor_queries()) <= set(contract.oracle_sql())
