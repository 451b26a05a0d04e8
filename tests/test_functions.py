from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from hazemill import domain
from hazemill import functions as fn
from tests.conftest import at

NAN, INF = float("nan"), float("inf")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def column_of(spark, rows, schema, expression):
    df = spark.createDataFrame(rows, schema).repartition(1)
    return [r["x"] for r in df.select("*", expression.alias("x")).collect()]


AQI_CASES = [
    ("pm25", 0.0, 0),
    ("pm25", 12.0, 50),
    ("pm25", 12.1, 51),
    ("pm25", 35.4, 100),
    ("pm25", 55.5, 151),
    ("pm25", 150.4, 200),
    ("pm25", 500.4, 500),
    ("pm25", 20.0, 68),
    ("pm25", 12.05, 500),
    ("pm25", 600.0, 500),
    ("pm25", -1.0, 500),
    ("pm25", NAN, 500),
    ("pm25", INF, 500),
    ("pm25", -INF, 500),
    ("pm25", None, None),
    ("pm10", 54.5, 500),
    ("o3", 50.0, 25),
    ("o3", 100.5, 300),
    ("o3", 900.0, 300),
    ("co", 5.05, 300),
    ("xx", 1.0, -1),
    (None, 1.0, -1),
]


def test_aqi(spark):
    rows = [(p, c) for p, c, _ in AQI_CASES]
    got = column_of(spark, rows, "p string, c double", fn.aqi("p", "c"))
    assert got == [expected for _, _, expected in AQI_CASES]


def test_every_breakpoint_row_maps_its_ends(spark):
    rows, expected = [], []
    for name, bands in domain.AQI_BANDS.items():
        for band in bands:
            rows += [(name, band.c_low), (name, band.c_high)]
            expected += [band.i_low, band.i_high]
    assert column_of(spark, rows, "p string, c double", fn.aqi("p", "c")) == expected


def test_every_gap_falls_to_the_top_or_is_closed(spark):
    rows, tops, closed = [], [], []
    for name, bands in domain.AQI_BANDS.items():
        for band, after in zip(bands, bands[1:]):
            rows.append((name, (band.c_high + after.c_low) / 2))
            tops.append(bands[-1].i_high)
            closed.append(band.i_high)
    assert column_of(spark, rows, "p string, c double", fn.aqi("p", "c")) == tops
    assert column_of(spark, rows, "p string, c double", fn.aqi("p", "c", gaps="close")) == closed


def test_aqi_against_a_plain_loop(spark):
    rng = random.Random(7)
    rows = [(p, round(rng.uniform(0, 700), 2)) for p in domain.PARAMETERS for _ in range(200)]

    def plain(p, c):
        for b in domain.AQI_BANDS[p]:
            if b.c_low <= c <= b.c_high:
                exact = (b.i_high - b.i_low) / (b.c_high - b.c_low) * (c - b.c_low) + b.i_low
                return math.floor(exact) + (exact - math.floor(exact) >= 0.5)
        return domain.AQI_BANDS[p][-1].i_high

    got = column_of(spark, rows, "p string, c double", fn.aqi("p", "c"))
    assert got == [plain(p, c) for p, c in rows]


def test_unknown_gap_rule():
    with pytest.raises(ValueError):
        fn.aqi("p", "c", gaps="open")


def test_categories(spark):
    edges = [-1, 0, 50, 51, 100, 101, 150, 151, 200, 201, 300, 301, None]
    sensitive = "Unhealthy for Sensitive Groups"
    expected = ["Unknown", "Good", "Good", "Moderate", "Moderate", sensitive, sensitive]
    expected += ["Unhealthy", "Unhealthy", "Very Unhealthy", "Very Unhealthy", "Hazardous", None]
    got = column_of(spark, [(i,) for i in edges], "i int", fn.aqi_category("i"))
    assert got == expected


CODE_CASES = [
    ("pm25", 14.0, "µg/m³", 55.75, 37.6, 0),
    ("xx", 1.0, "", 0.0, 0.0, 1),
    ("pm25", 9000.0, "µg/m³", 0.0, 0.0, 3),
    ("o3", NAN, "", 0.0, 0.0, 2),
    ("o3", -1.0, "", 0.0, 0.0, 2),
    ("co", 1.0, "µg/m³", 0.0, 0.0, 4),
    ("pm25", 10.0, "µg/m³", 200.0, 0.0, 5),
    ("pm25", INF, "", 0.0, 0.0, 2),
    ("pm25", -INF, "", 0.0, 0.0, 2),
    ("pm25", 1000.0, "", 90.0, -180.0, 0),
    ("pm25", 10.0, "", NAN, 0.0, 5),
    ("pm25", 10.0, "", 0.0, NAN, 5),
    ("pm25", 10.0, "", 0.0, 180.5, 5),
    ("pm25", None, "µg/m³", 0.0, 0.0, 2),
    ("xx", NAN, "bad", 200.0, 0.0, 1),
    (None, 1.0, "", 0.0, 0.0, 1),
    ("pm25", 1.0, None, 0.0, 0.0, 0),
    ("pm25", 1.0, "", None, 0.0, 5),
    ("pm25", 9000.0, "bad", 200.0, 0.0, 3),
    ("pm25", 10.0, "bad", 200.0, 0.0, 4),
]


def test_validation_codes(spark):
    rows = [case[:5] for case in CODE_CASES]
    schema = "p string, v double, u string, lat double, lon double"
    got = column_of(spark, rows, schema, fn.validate_code("p", "v", "u", "lat", "lon"))
    assert got == [case[5] for case in CODE_CASES]


def test_reasons(spark):
    codes = [0, 1, 2, 3, 4, 5, 9]
    got = column_of(spark, [(c,) for c in codes], "c int", fn.reason_message("c"))
    assert got == [*domain.REASONS.values(), "unknown reason"]


def test_sql_functions_equal_the_columns(spark):
    fn.register_sql_functions(spark)
    schema = "p string, v double, u string, lat double, lon double"
    rows = [case[:5] for case in CODE_CASES] + [(p, c, "", 0.0, 0.0) for p, c, _ in AQI_CASES]
    df = spark.createDataFrame(rows, schema).select(
        "*",
        fn.aqi("p", "v").alias("a1"),
        F.expr("aqi(p, v)").alias("a2"),
        fn.validate_code("p", "v", "u", "lat", "lon").alias("c1"),
        F.expr("validate_code(p, v, u, lat, lon)").alias("c2"),
        fn.round_half_up("v", 1).alias("r1"),
        F.expr("round_half_up(v, 1)").alias("r2"),
    )
    differing = df.filter("NOT (a1 <=> a2 AND c1 <=> c2 AND r1 <=> r2)")
    assert differing.count() == 0
    named = spark.sql("SELECT reason_message(3) AS r, aqi_category(aqi('pm25', 20D)) AS c").first()
    assert tuple(named) == (domain.REASONS[3], "Moderate")


def test_rounding(spark):
    values = [2.675, 0.125, -2.675, -0.125, 1e18, INF, None]
    rows = [(v,) for v in values]
    half_up = column_of(spark, rows, "v double", fn.round_half_up("v", 2))
    # 2.675 * 100 is 267.49999999999994 in binary.
    assert half_up == [2.67, 0.13, -2.67, -0.13, 1e18, INF, None] or half_up[1:] == [
        0.13,
        round(-2.675 * 100) / 100,
        -0.13,
        1e18,
        INF,
        None,
    ]
    window = column_of(spark, rows, "v double", fn.round_window("v"))
    assert window == [
        *(int(v * 100 + 0.5) / 100 for v in values[:4]),
        1e18,
        INF,
        None,
    ]
    assert math.isnan(one(spark, F.expr("DOUBLE('NaN')").alias("n")))
    assert math.isnan(column_of(spark, [(NAN,)], "v double", fn.round_window("v"))[0])


@pytest.mark.parametrize("low, high", [(0, 3000), (-1e-6, 1e-6), (-5e7, 9e8), (1e6, 4e15)])
def test_exact_sum_does_not_depend_on_order(spark, low, high):
    rng = random.Random(3)
    values = [rng.uniform(low, high) for _ in range(5000)]
    totals = set()
    for seed in range(3):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
        totals.add(df.agg(fn.exact_sum("v").alias("s")).first()["s"])
    assert len(totals) == 1
    assert totals.pop() == pytest.approx(math.fsum(values), rel=3e-16)


def test_exact_sum_of_readings_is_the_nearest_double(spark):
    rng = random.Random(4)
    for n in (2, 3, 500):
        values = [round(rng.uniform(0, 3000), 2) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
        assert df.agg(fn.exact_sum("v").alias("s")).first()["s"] == math.fsum(values)


def test_a_gap_between_bands_is_seen_however_small(measurements):
    from hazemill.operators import tumbling_aggregate

    rolled = tumbling_aggregate(measurements({"value": 12.0000004}), "10 seconds").first()
    assert (rolled["aqi"], rolled["avg"]) == (500, 12.0)


def test_large_sums_add_up(spark):
    df = spark.range(20_000).select(F.lit(9e14).alias("v"))
    assert df.agg(fn.exact_sum("v").alias("s")).first()["s"] == 1.8e19


@pytest.mark.parametrize(
    "values, expected",
    [
        ([1.5, None, 2.25], 3.75),
        ([None, None], None),
        ([], None),
        ([-1.25, 0.5], -0.75),
        ([1.0, INF], INF),
        ([1e18, 1.0], 1e18),
        ([12.0000004], 12.0000004),
        ([1e300, 1.0, -1e300], 1.0),
        ([1e-300], 1e-300),
        ([-1.0, 1.0, 1e-30], 1e-30),
        ([5e-324, -7.5], -7.5),
        ([0.0], 0.0),
    ],
)
def test_exact_sum_edges(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(fn.exact_sum("v").alias("s")).first()["s"] == expected


def test_exact_sum_keeps_nan(spark):
    df = spark.createDataFrame([(1.0,), (NAN,)], "v double")
    assert math.isnan(df.agg(fn.exact_sum("v").alias("s")).first()["s"])


def test_exact_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert df.agg(fn.exact_mean("v").alias("m")).first()["m"] is None


def test_parse_ts(spark):
    texts = [
        "2024-01-01T00:00:00Z",
        "2024-01-01T03:00:00.123456+03:00",
        "2024-01-01T00:00:00.123456789Z",
        "2024-01-01",
        "2024",
        "yesterday",
        "",
        None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["x"] for r in df.select(fn.parse_ts("t").cast("string").alias("x")).collect()]
    assert got == [
        "2024-01-01 00:00:00",
        "2024-01-01 00:00:00.123456",
        "2024-01-01 00:00:00.123456",
        "2024-01-01 00:00:00",
        None,
        None,
        None,
        None,
    ]


def test_micros():
    assert fn.micros("5 minutes") == 300_000_000
    assert fn.micros("1 hour 30 seconds") == 3_630_000_000
    for bad in ("", "5", "1 month"):
        with pytest.raises(ValueError):
            fn.micros(bad)


def fnv(data: bytes, bits: int) -> int:
    state, prime = {32: (0x811C9DC5, 0x01000193), 64: (0xCBF29CE484222325, 0x100000001B3)}[bits]
    for byte in data:
        state = (state ^ byte) * prime % 2**bits
    return state


NAMES = ["", "a", "foobar", "Paris Châtelet", "São Paulo Ibirapuera", "x" * 200]


def test_hashes_are_bit_identical(spark):
    rows = [(n,) for n in NAMES]
    narrow = column_of(spark, rows, "n string", fn.fnv1a_32(F.col("n")))
    assert narrow == [fnv(n.encode(), 32) for n in NAMES]
    wide = column_of(spark, rows, "n string", fn.fnv1a_64(F.col("n")))
    assert [(w["high"] << 32) + w["low"] for w in wide] == [fnv(n.encode(), 64) for n in NAMES]
    slugs = column_of(spark, rows, "n string", fn.station_slug("n"))
    assert slugs == [f"st-{fnv(n.encode(), 32):08x}" for n in NAMES]
    # Published test vectors of the hash.
    assert fnv(b"foobar", 32) == 0xBF9CF968
    assert fnv(b"foobar", 64) == 0x85944171F73967E8


def test_unzoned_times_are_utc(spark):
    assert one(spark, F.lit("2024-01-01 00:00:00").cast("timestamp").cast("long")) == int(
        at("2024-01-01T00:00:00").timestamp()
    )
