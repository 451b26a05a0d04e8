from __future__ import annotations

import math
import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazemill import domain
from hazemill import operators as op
from hazemill.functions import fnv1a_64
from hazemill.operators import joins
from hazemill.schemas import AGGREGATE, MEASUREMENT, STATION
from tests.conftest import at
from tests.test_functions import NAN, fnv

START = at("2024-01-01T00:00:00")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# Validation and cleaning.


def test_missing_columns_are_skipped(spark):
    df = spark.createDataFrame([("pm25", 10.0), ("pm25", -1.0)], "pollutant string, v double")
    judged = op.validate_frame(df, parameter="pollutant", value="v")
    assert [r["code"] for r in judged.collect()] == [0, 2]
    assert judged.columns == ["pollutant", "v", "code", "valid", "reason"]


def test_dedup_keeps_the_newest_version_whatever_the_order(aggregates):
    rows = [{"count": n, "avg": a} for n, a in [(1, 10.0), (2, 30.0), (2, 31.0), (None, 1.0), (1, float("nan")), (2, None)]]
    for order in (rows, rows[::-1]):
        kept = op.dedup(aggregates(*order, *order, {"parameter": "o3"}).repartition(3))
        assert kept.columns == AGGREGATE.fieldNames()
        assert kept.filter("parameter = 'pm25'").select("count", "avg").collect() == [(2, 30.0)]
        assert kept.count() == 2


def test_dedup_of_equal_versions_keeps_one_fixed_row(aggregates):
    rows = [{"location": name, "city": city, "sum": s} for name in ("A", None) for city in ("A", None) for s in (1.0, None, 0.0, float("nan"))]
    kept = {tuple(op.dedup(aggregates(*order).repartition(n)).select("location", "city").first()) for order in (rows, rows[::-1]) for n in (1, 5)}
    assert len(kept) == 1
    assert op.dedup(aggregates(*rows)).count() == 1


def test_dedup_decides_equal_versions_by_the_other_columns_in_their_order(aggregates):
    rng, rows, expected = random.Random(7), [], []
    shown = ["location_id", "city", "sum", "avg", "min"]
    for station in range(20):
        versions = [(f"st-{station}", city, total, mean, low) for city in (None, "A", "a") for total in (None, 1.0, NAN) for mean in (14.201, 14.202) for low in (63.09, 2.48)]
        versions = rng.sample(versions, 8)
        # The mean first, also below the hundredth that the rank holds; then NULL before values before NaN.
        key = [lambda v: (v is not None, v or "")] + [lambda v: (v is not None, v is not None and math.isnan(v), v or 0.0)] * 3
        expected.append(min(versions, key=lambda v: (v[3], *(k(x) for k, x in zip(key, v[1:])))))
        rows += [dict(zip(shown, v)) for v in versions]
    for order in (rows, rows[::-1] + rows):
        kept = op.dedup(aggregates(*order).repartition(3)).select(*shown)
        assert sorted(repr(tuple(r)) for r in kept.collect()) == sorted(map(repr, expected))


def test_tied_rows_of_a_key_are_reduced_before_their_shuffle(aggregates):
    plan = op.dedup(aggregates({}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_dedup_treats_missing_keys_as_equal(aggregates):
    assert op.dedup(aggregates({"location_id": None}, {"location_id": None})).count() == 1


def test_published_last_counts_among_equal_versions(aggregates):
    df = aggregates({"avg": 1.0}, {"avg": 2.0}, {"avg": 3.0, "count": 1}).withColumn(
        "published", F.when(F.col("avg") == 2.0, F.lit(at("2024-01-02T00:00:00"))).when(F.col("avg") == 3.0, F.lit(at("2025-01-01T00:00:00")))
    )
    assert [r["avg"] for r in op.dedup(df).collect()] == [2.0]


@pytest.mark.parametrize("operator", ["dedup", "latest_per_station", "aqi_map", "clean"])
def test_survivors_are_found_without_sorting(aggregates, operator, tmp_path):
    aggregates({}, {"location_id": "st-2"}).write.parquet(str(tmp_path / "rows"))
    df = aggregates({}).sparkSession.read.parquet(str(tmp_path / "rows"))
    plan = getattr(op, operator)(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_clean_and_its_report(aggregates):
    df = aggregates(
        {}, {}, {"parameter": "xx"}, {"parameter": "o3", "avg": -1.0}, {"parameter": "co"}
    )
    # co arrives with the unit of the others.
    assert [r["parameter"] for r in op.clean(df).collect()] == ["pm25"]
    assert op.clean_report(df).first().asDict() == {
        "raw_rows": 5,
        "duplicate_rows": 1,
        "invalid_rows": 3,
        "dropped_rows": 4,
        "clean_rows": 1,
    }


    assert op.clean_report(df, op.clean(df)).collect() == op.clean_report(df).collect()


def test_clean_report_of_nothing(aggregates):
    nothing = aggregates({}).limit(0)
    assert tuple(op.clean_report(nothing).first()) == (0, 0, 0, 0, 0)
    assert tuple(op.clean_report(nothing, nothing).first()) == (0, 0, 0, 0, 0)


def test_own_rules(spark, measurements):
    rules = spark.createDataFrame(
        [("pm25", "mg/m³", 5.0, 20.0), ("pm25", "mg/m³", 5.0, 20.0)],
        "parameter string, expected_unit string, min_value double, max_value double",
    )
    df = measurements(
        {"value": 10.0}, {"value": 10.0, "unit": ""}, {"value": 4.0}, {"parameter": "o3"}
    )
    judged = op.validate_frame(op.with_spec(df, rules), value="value")
    assert sorted(r["code"] for r in judged.collect()) == [0, 1, 3, 4]


def test_quality_counters(measurements):
    judged = op.validate_frame(measurements({}, {}, {"value": NAN}, {"parameter": "xx"}), value="value")
    assert [tuple(r) for r in op.quality_report(judged).select("code", "readings").collect()] == [
        (0, 2),
        (1, 1),
        (2, 1),
    ]
    windows = op.tumbling_aggregate(op.only_valid(judged))
    counters = {(r["counter"], r["label"]): r["total"] for r in op.collector_counters(judged, windows).collect()}
    assert counters[("measurements_total", "")] == 4
    assert counters[("aggregates_total", "")] == 1
    assert counters[("invalid_total", "unknown pollutant parameter")] == 1


# Roll-up.


def test_tumbling_window(measurements):
    df = measurements(
        *({"value": v, "timestamp": START + timedelta(seconds=i)} for i, v in enumerate([10.0, 20.0, 30.0])),
        {"parameter": "o3", "value": 50.0},
    )
    out = {r["parameter"]: r for r in op.tumbling_aggregate(df).collect()}
    pm = out["pm25"]
    assert (pm["count"], pm["sum"], pm["avg"], pm["min"], pm["max"]) == (3, 60.0, 20.0, 10.0, 30.0)
    assert (pm["aqi"], pm["aqi_category"]) == (68, "Moderate")
    assert (out["o3"]["aqi"], out["o3"]["aqi_category"]) == (25, "Good")
    assert pm["window_end"] - pm["window_start"] == timedelta(seconds=10)
    assert op.tumbling_aggregate(df).columns == AGGREGATE.fieldNames()


def test_no_readings_no_windows_but_the_schema(measurements):
    empty = op.tumbling_aggregate(measurements({}).limit(0))
    assert empty.count() == 0
    assert [f.dataType for f in empty.schema] == [f.dataType for f in AGGREGATE]


def test_index_comes_from_the_unrounded_mean(measurements):
    # The mean 12.004 lies in a gap, its rounded form 12.0 does not.
    out = op.tumbling_aggregate(measurements({"value": 12.004})).first()
    assert (out["avg"], out["aqi"]) == (12.0, 500)


def test_description_of_the_first_reading(measurements):
    df = measurements(
        {"location": "Late", "timestamp": START + timedelta(seconds=5)},
        {"location": "Twin B", "timestamp": START},
        {"location": "Twin A", "timestamp": START, "unit": ""},
    )
    out = op.tumbling_aggregate(df.repartition(3)).collect()
    assert [(r["location"], r["unit"], r["count"]) for r in out] == [("Twin A", "", 3)]


def test_windows_split_at_their_end(measurements):
    df = measurements(
        {"timestamp": START + timedelta(seconds=9, microseconds=999_999)},
        {"timestamp": START + timedelta(seconds=10)},
    )
    assert [r["count"] for r in op.tumbling_aggregate(df).collect()] == [1, 1]


def test_legacy_aggregates_are_completed(aggregates):
    old = aggregates({"location_id": "", "avg": 20.0}).drop("aqi", "aqi_category")
    done = op.with_aqi(old)
    assert done.columns == AGGREGATE.fieldNames()
    assert tuple(done.select("aqi", "aqi_category").first()) == (68, "Moderate")


# Reports.


def test_worst_stations(spark, aggregates):
    df = aggregates(
        {"location": "A", "aqi": 100, "avg": 30.0, "max": 40.0},
        {"location": "A", "aqi": 101, "avg": 31.0, "max": 50.0},
        {"location": "C", "aqi": 90},
        {"location": "B", "aqi": 90},
        {"location": "Z", "aqi": 400, "parameter": "o3"},
    )
    ranked = [tuple(r) for r in op.worst_stations(df, 2).collect()]
    assert ranked[0] == ("A", "Moscow", "RU", 100.5, 30.5, 50.0, 2)
    assert ranked[1][0] == "B"
    df.createOrReplaceTempView("some_windows")
    in_sql = op.worst_stations_sql(spark, "some_windows", 2)
    assert [tuple(r) for r in in_sql.collect()] == ranked


def test_summary_counts_windows_not_readings(aggregates):
    df = aggregates({"count": 7, "avg": 1.0}, {"count": 9, "avg": 2.0})
    out = op.pollutant_summary(df).first()
    assert (out["count"], out["mean"], out["sum"]) == (2, 1.5, 142.0)


def test_shares(aggregates):
    df = aggregates({}, {}, {"aqi_category": "Good"})
    assert [tuple(r) for r in op.aqi_category_share(df).collect()] == [
        ("Moderate", 2, 66.67),
        ("Good", 1, 33.33),
    ]
    assert [r["windows"] for r in op.aqi_category_breakdown(df).collect()] == [2, 1]


def test_matrix_fills_with_zero(aggregates):
    df = aggregates({"city": "B"}, {"city": "A", "parameter": "o3", "avg": 3.0}, {"city": "A", "parameter": "o3", "avg": 4.0})
    out = [r.asDict() for r in op.city_pollutant_matrix(df).collect()]
    assert [(r["city"], r["pm25"], r["o3"], r["co"]) for r in out] == [("A", 0.0, 3.5, 0.0), ("B", 14.2, 0.0, 0.0)]


def test_matrix_has_every_pollutant(aggregates):
    df = aggregates({"parameter": "bc", "avg": 2.0}, {"city": "A", "parameter": "pm1.0"}, {"parameter": None}, {"parameter": "bc", "avg": 3.0})
    matrix = op.city_pollutant_matrix(df)
    assert matrix.columns == ["city", *domain.PARAMETERS, "bc", "pm1.0"]
    assert [(r["city"], r["bc"], r["pm1.0"], r["pm25"]) for r in matrix.collect()] == [("A", 0.0, 14.2, 0.0), ("Moscow", 2.5, 0.0, 0.0)]
    assert op.city_pollutant_matrix(df, ["bc"]).columns == ["city", "bc"]
    with pytest.raises(ValueError, match="more than 1"):
        op.city_pollutant_matrix(df, most=1)
    assert op.city_pollutant_matrix(df.limit(0)).columns == ["city", *domain.PARAMETERS]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 100, 1001])
def test_distribution_against_numpy(aggregates, size):
    rng = random.Random(size)
    values = [round(rng.lognormvariate(3, 1), 2) for _ in range(size)]
    values[size // 2 :] = [round(v, 0) for v in values[size // 2 :]]
    out = op.pollutant_distribution(aggregates(*({"avg": v} for v in values))).first()
    q1, median, q3 = np.percentile(values, [25, 50, 75])
    inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    assert (out["q1"], out["median"], out["q3"]) == pytest.approx((q1, median, q3), abs=1e-6)
    assert (out["whisker_low"], out["whisker_high"]) == (min(inside), max(inside))
    assert (out["windows"], out["outliers"]) == (size, size - len(inside))


def test_approximate_distribution(aggregates):
    df = aggregates(*({"avg": float(v)} for v in range(101)))
    out = op.pollutant_distribution(df, approximate=True).first()
    assert (out["q1"], out["median"], out["q3"]) == (25.0, 50.0, 75.0)


# The present state.


def test_latest_and_key_figures(aggregates):
    later = START + timedelta(hours=1)
    df = aggregates(
        {"aqi": 200},
        {"aqi": 60, "window_end": later},
        {"location_id": "st-2", "city": "B", "aqi": 60},
        {"location_id": None, "city": "C", "aqi": 10},
        {"parameter": "o3", "aqi": 300},
    )
    latest = op.latest_per_station(df)
    assert latest.columns == df.columns
    assert latest.count() == 4
    figures = op.kpi_summary(df).first().asDict()
    assert figures == {
        "active_stations": 3,
        "aggregates_in_window": 5,
        "worst_pm25_aqi": 60,
        "worst_pm25_city": "B",
        "worst_pm25_location_id": "st-2",
    }
    assert op.kpi_summary(df, approximate=True).first()["active_stations"] == 3
    assert op.aqi_map(df).count() == 3


def test_key_figures_of_nothing(aggregates):
    figures = op.kpi_summary(aggregates({}).limit(0)).first()
    assert tuple(figures) == (0, 0, None, None, None)


def test_recent_windows(aggregates):
    df = aggregates(*({"window_end": START + timedelta(seconds=s), "city": c} for s in range(5) for c in "ab"))
    kept = op.recent_windows(df, 2)
    assert kept.columns == df.columns
    assert kept.count() == 4
    assert kept.agg(F.min("window_end")).first()[0] == df.agg(F.max("window_end") - timedelta(seconds=1)).first()[0]


def test_span_includes_both_ends(aggregates):
    now = START
    ages = [301, 300, 10, 0, -1, None]
    df = aggregates(
        *({"window_end": None if a is None else now - timedelta(seconds=a), "count": i} for i, a in enumerate(ages))
    )
    assert sorted(r["count"] for r in op.within_last(df, as_of=now).collect()) == [1, 2, 3]
    summary = op.rolling_summary(df, as_of=now).first()
    assert summary["windows"] == 3
    # The newest end is taken when no instant is given.
    assert op.within_last(df).count() == 3


def test_rolling_as_of_against_a_plain_loop(aggregates):
    rng = random.Random(11)
    rows = []
    for _ in range(400):
        # One city holds most rows, many of them at the same instant.
        city = "hot" if rng.random() < 0.7 else rng.choice("ab")
        end = START + timedelta(seconds=rng.randrange(0, 4000, 10))
        rows.append({"city": city, "window_end": end, "avg": round(rng.uniform(0, 90), 2), "aqi": rng.randrange(300), "max": float(rng.randrange(100))})
    df = aggregates(*rows)
    got = {
        (r["city"], r["at"]): (r["rolling_mean"], r["rolling_aqi"], r["peak"], r["windows"])
        for r in op.rolling_as_of(df, "5 minutes")
        .withColumn("at", F.unix_seconds("window_end"))
        .collect()
    }
    expected = {}
    for r in rows:
        seen = [s for s in rows if s["city"] == r["city"] and timedelta(0) <= r["window_end"] - s["window_end"] <= timedelta(minutes=5)]
        total = math.fsum(s["avg"] for s in seen)
        expected[(r["city"], int(r["window_end"].timestamp()))] = (
            int(total / len(seen) * 100 + 0.5) / 100,
            int(sum(s["aqi"] for s in seen) / len(seen) * 10 + 0.5) / 10,
            max(s["max"] for s in seen),
            len(seen),
        )
    assert got == expected


# Lookups.


def catalogue(spark, *rows):
    return spark.createDataFrame([(i, n, c, "RU", 1.0, 2.0) for i, n, c in rows], STATION)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_station_lookup(spark, measurements, threshold, tmp_path):
    """The same rows with a broadcast, which moves no fact, and with a join of salted hot keys."""
    facts = measurements(*({"location_id": i, "value": float(v)} for v in range(40) for i in ("hot", "b", "none")))
    facts = facts.select("location_id", "parameter", "value", "unit", "timestamp").repartition(3)
    facts.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    path = str(tmp_path / "stations")
    catalogue(spark, ("hot", "Hot", "H"), ("b", "B1", "B"), ("b", "B2", "B"), ("c", "C", "C")).write.parquet(path)
    stations = spark.read.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        joined = op.enrich_with_station(facts, stations)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (threshold != "-1")
        assert ("_salt" in plan) == (threshold == "-1")
        if threshold != "-1":
            above = plan[plan.index("BroadcastHashJoin") :].split("BroadcastExchange")[0]
            assert "Exchange" not in above.replace("BroadcastHashJoin", "")
        assert joined.columns == MEASUREMENT.fieldNames()
        counts = {r["location"]: r["count"] for r in joined.groupBy("location").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert counts == {"Hot": 40, "B2": 40}  # of the two rows of b a fixed one


def test_salt_spreads_copies_of_one_fact(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(4000).select(F.lit("hot").alias("k"), F.lit(1.0).alias("v")).repartition(40)
        dimension = spark.createDataFrame([("hot", "H")], "k string, name string")
        for how, columns in (("inner", 3), ("left", 3), ("left_semi", 2)):
            joined = op.join_dimension(facts, dimension, "k", how, salts=8)
            assert (joined.count(), len(joined.columns)) == (4000, columns)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_size_is_measured_not_estimated(spark, tmp_path):
    """140 MB that compress to nothing are no broadcast; a small table behind a generator is."""
    spark.range(2_000_000).select("id", F.lit("x" * 48).alias("name")).coalesce(2).write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    assert joins.measured_size(wide, 10 * 2**20) is None
    assert 140e6 < joins.measured_size(wide, 2**30) < 200e6
    facts = spark.range(1000).select((F.col("id") * 7).alias("id"))
    joined = op.join_dimension(facts, wide, "id")
    assert joined.count() == 1000
    small = spark.range(10).select(F.explode(F.array(F.col("id"), F.col("id") + 10)).alias("id"))
    assert joins.measured_size(small, 10 * 2**20) == 20 * 24
    nested = spark.range(3).select("id", F.array(F.lit("abc")).alias("a"), F.lit(None).cast("string").alias("s"))
    assert joins.measured_size(nested, 10_000) < 600
    assert joins.measured_size(nested.limit(0), 10_000) == 0 and joins.measured_size(nested, -1) is None


def test_only_hot_keys_are_salted(spark):
    facts = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    assert joins.hot_keys(facts, ["k"]) == [facts.filter("k = -1").select(F.xxhash64("k")).first()[0]]
    assert joins.hot_keys(spark.range(5000), ["id"]) == [] and joins.hot_keys(spark.range(0), ["id"]) == []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dimension = spark.range(-1, 9000).select(F.col("id").alias("k"), F.lit("d").alias("name"))
        joined = op.join_dimension(facts, dimension, "k")
        assert joined.count() == 9000 and "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()
        plain = op.join_dimension(spark.range(5000), dimension.withColumnRenamed("k", "id"), "id")
        assert plain.count() == 5000 and "_salt" not in plain._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_unsupported_lookup(spark):
    with pytest.raises(ValueError):
        op.join_dimension(spark.range(1), spark.range(1), "id", "full")


# Shards.

MEMBERS = ["collector-a", "collector-b", "collector-c"]


def stations(spark, n=200):
    return spark.range(n).select(F.concat(F.lit("st-"), F.sha1(F.col("id").cast("string")).substr(1, 8)).alias("location_id"))


def test_owner_has_the_highest_hash(spark):
    for row in op.assign_shards(stations(spark), MEMBERS).collect():
        scores = {m: fnv(m.encode() + b"\0" + row["location_id"].encode(), 64) for m in MEMBERS}
        assert row["owner"] == max(scores, key=scores.get)


def test_every_station_has_one_owner(spark):
    df = stations(spark)
    parts = [op.assigned_to(df, m, MEMBERS).count() for m in MEMBERS]
    assert sum(parts) == df.count()
    assert all(parts)
    sizes = {r["owner"]: r["stations"] for r in op.shard_sizes(df, MEMBERS).collect()}
    assert sizes == dict(zip(MEMBERS, parts))


def test_a_new_member_only_takes(spark):
    moves = op.shard_moves(stations(spark), MEMBERS, [*MEMBERS, "collector-d"]).filter("moved").collect()
    assert moves
    assert {m["new_owner"] for m in moves} == {"collector-d"}


def test_without_members_all_stations_are_ours(spark):
    df = stations(spark, 5)
    assert op.assigned_to(df, "me", []).count() == 5
    assert [r["owner"] for r in op.assign_shards(df, []).collect()] == [None] * 5


def test_readings_of_a_member(spark, measurements):
    ids = [r["location_id"] for r in stations(spark, 20).collect()]
    df = measurements(*({"location_id": i} for i in ids for _ in range(2)))
    total = sum(op.assigned_readings(df, stations(spark, 20), m, MEMBERS).count() for m in MEMBERS)
    assert total == 40


def test_scores_compare_as_unsigned(spark):
    high = spark.range(1).select(fnv1a_64(F.lit("foobar")).alias("h")).first()["h"]
    assert high["high"] > 2**31


def test_members_without_stations_are_listed(spark):
    stations = spark.createDataFrame([("st-1",)], "location_id string")
    sizes = op.shard_sizes(stations, ["a", "b", "c"]).collect()
    assert [r.owner for r in sizes] == ["a", "b", "c"]
    assert sorted(r.stations for r in sizes) == [0, 0, 1]


def test_a_missing_newest_index_is_not_replaced_by_an_older_one(aggregates):
    rows = aggregates(
        {"window_end": at("2024-01-01T00:00:10"), "aqi": 300},
        {"window_end": at("2024-01-01T00:00:20"), "aqi": None},
        {"window_end": at("2024-01-01T00:00:10"), "aqi": 2000, "location_id": "st-2"},
        {"window_end": at("2024-01-01T00:00:20"), "aqi": 40, "location_id": "st-2"},
    )
    assert op.kpi_summary(rows).first().worst_pm25_aqi == 40
