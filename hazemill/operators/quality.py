"""Validation, deduplication and quality counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemill import domain
from hazemill.functions.checks import code_text, reason_message, spec_texts
from hazemill.operators.survivors import one_per_key, version_order, version_rank

WINDOW_KEYS = ["location_id", "parameter", "window_start"]


def _code(df: DataFrame, parameter: str, value: str, unit: str, lat: str, lon: str) -> Column:
    known = set(df.columns)
    spec = spec_texts(f"`{parameter}`")
    if set(spec) <= known:
        spec = {name: name for name in spec}
    return F.expr(
        code_text(
            spec,
            f"`{value}`",
            f"`{unit}`" if unit in known else "''",
            f"`{lat}`" if lat in known else "0D",
            f"`{lon}`" if lon in known else "0D",
        )
    )


def validate_frame(
    df: DataFrame,
    *,
    parameter: str = "parameter",
    value: str = "avg",
    unit: str = "unit",
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Add ``code``, ``valid`` and ``reason``.

    ``value`` is ``avg`` for window aggregates; pass ``value="value"`` for readings. A
    missing unit or coordinate column counts as empty or 0. Rules attached by
    ``with_spec`` are used instead of the built-in ones.
    """
    coded = df.withColumn("code", _code(df, parameter, value, unit, lat, lon))
    return coded.withColumns({"valid": F.col("code") == 0, "reason": reason_message("code")})


def only_valid(validated: DataFrame) -> DataFrame:
    """Rows with code 0."""
    return validated.filter(F.col("code") == 0)


def valid_readings(readings: DataFrame) -> DataFrame:
    """Readings that pass validation, without the verdict columns (the window's gate)."""
    code = _code(readings, "parameter", "value", "unit", "latitude", "longitude")
    return readings.filter(code == 0)


def dedup(df: DataFrame, keys: Sequence[str] = WINDOW_KEYS) -> DataFrame:
    """One row per key. Of aggregates it is the newest version (``version_rank``: a window that
    was published again with late readings has more of them), of equal versions the smallest by
    the other columns in their order; of other rows a fixed one.

    An aggregation of fixed-width ranks rather than ``row_number()`` over all rows: every task
    first reduces its own copies, so a group that holds a third of all rows is shuffled as one
    rank per task. Only rows of equal rank are put in order.
    """
    if not {"count", "avg"} <= set(df.columns):
        return one_per_key(df, keys)
    return one_per_key(df, keys, version_rank(df.columns), version_order(df.columns))


def clean(df: DataFrame) -> DataFrame:
    """Newest versions of aggregates without invalid rows, with the verdict columns."""
    return only_valid(validate_frame(dedup(df)))


def clean_report(df: DataFrame, cleaned: DataFrame | None = None) -> DataFrame:
    """How many rows ``clean`` drops and why.

    Only the keys of ``df`` are read and grouped; the survivors are counted in the already
    ``cleaned`` (stored) rows, or found again without them.
    """
    rows = df.groupBy(*WINDOW_KEYS).agg(F.count(F.lit(1)).alias("_copies"))
    kept = clean(df) if cleaned is None else cleaned
    valid = F.any_value(kept.agg(F.count(F.lit(1))).scalar())
    counts = rows.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("raw_rows"),
        F.count(F.lit(1)).alias("_unique"),
        F.coalesce(valid, F.lit(0)).alias("clean_rows"),
    )
    return counts.selectExpr(
        "raw_rows",
        "raw_rows - _unique AS duplicate_rows",
        "_unique - clean_rows AS invalid_rows",
        "raw_rows - clean_rows AS dropped_rows",
        "clean_rows",
    )


def quality_report(validated: DataFrame) -> DataFrame:
    """Rows per validation code."""
    counts = validated.groupBy("code").agg(F.count(F.lit(1)).alias("readings"))
    return counts.select("code", reason_message("code").alias("reason"), "readings").orderBy("code")


def _code_counts() -> list[Column]:
    rejected = (code for code in domain.REASONS if code)
    return [
        F.count(F.lit(1)).alias("measurements_total"),
        *(F.count(F.when(F.col("code") == code, 1)).alias(f"invalid_{code}") for code in rejected),
    ]


def collector_counters(validated: DataFrame, aggregates: DataFrame) -> DataFrame:
    """The collector's counters as rows ``counter, label, total``.

    One pass over the readings and one over the aggregates. A reason that never
    occurred has no row; ``untimed_total`` has valid readings without a time, which are in
    no window.
    """
    rows = ["'measurements_total', '', measurements_total"]
    for code, message in domain.REASONS.items():
        if code:
            rows.append(f"'invalid_total', '{message}', invalid_{code}")
    counts = _code_counts()
    if "timestamp" in validated.columns:
        untimed = (F.col("code") == 0) & F.col("timestamp").isNull()
        counts.append(F.count(F.when(untimed, 1)).alias("untimed"))
        rows.append("'untimed_total', '', untimed")
    stacked = f"stack({len(rows)}, {', '.join(rows)}) AS (counter, label, total)"
    seen = validated.agg(*counts).selectExpr(stacked)
    seen = seen.filter((F.col("counter") == "measurements_total") | (F.col("total") > 0))
    emitted = aggregates.agg(F.count(F.lit(1)).alias("total")).select(
        F.lit("aggregates_total").alias("counter"), F.lit("").alias("label"), "total"
    )
    return seen.unionByName(emitted)


def observe_quality(validated: DataFrame, name: str = "quality") -> DataFrame:
    """Attach the counters to a batch or stream as observed metrics (no extra pass)."""
    return validated.observe(name, *_code_counts())
