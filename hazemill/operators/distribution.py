"""Box-plot statistics of the window means per pollutant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazemill.functions.numeric import round_half_up

_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
_WHISKER = 1.5
_DIGITS = 6


def _position(quartile: str) -> str:
    """Zero-based position of a quartile among n sorted values; may lie between two."""
    return f"((n - 1) * {_QUARTILES[quartile]}D)"


def _value_at(rank: str) -> str:
    return f"max(CASE WHEN _below <= {rank} AND {rank} < _below + _n THEN _v END)"


def _exact_quartiles(values: DataFrame) -> DataFrame:
    """Quartiles with linear interpolation, from counts of distinct values.

    ``percentile`` would hold all distinct values of a pollutant in one buffer. Here
    each value's rank comes from two running counts: over unit-wide bins (a plausible
    concentration is at most 3000, so there are few) and over the values inside one
    bin. No window ever covers a whole pollutant's values.
    """
    bins = values.groupBy("parameter", "_bin").agg(F.sum("_n").alias("_bin_n"))
    starts = bins.selectExpr(
        "parameter",
        "_bin",
        "sum(_bin_n) OVER (PARTITION BY parameter ORDER BY _bin) - _bin_n AS _before",
        "sum(_bin_n) OVER (PARTITION BY parameter) AS n",
    )
    in_bin = values.selectExpr(
        "*", "sum(_n) OVER (PARTITION BY parameter, _bin ORDER BY _v) - _n AS _in_bin"
    )
    ranked = in_bin.join(starts, ["parameter", "_bin"]).selectExpr(
        "parameter", "n", "_v", "_n", "_before + _in_bin AS _below"
    )
    ends = []
    for name in _QUARTILES:
        ends.append(F.expr(_value_at(f"floor({_position(name)})")).alias(f"_{name}_low"))
        ends.append(F.expr(_value_at(f"ceil({_position(name)})")).alias(f"_{name}_high"))
    return (
        ranked.groupBy("parameter", "n")
        .agg(*ends)
        .selectExpr(
            "parameter",
            "n",
            *(
                f"_{q}_low + (_{q}_high - _{q}_low) * ({_position(q)} - floor({_position(q)})) AS {q}"
                for q in _QUARTILES
            ),
        )
    )


def _approximate_quartiles(values: DataFrame, accuracy: int) -> DataFrame:
    found = values.groupBy("parameter").agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("_v", list(_QUARTILES.values()), accuracy).alias("_q"),
    )
    return found.selectExpr(
        "parameter", "n", *(f"_q[{i}] AS {name}" for i, name in enumerate(_QUARTILES))
    )


def pollutant_distribution(
    df: DataFrame, approximate: bool = False, accuracy: int = 10_000
) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier count of ``avg`` per pollutant.

    Whiskers are the outermost values within 1.5 interquartile ranges of the box.
    ``approximate=True`` takes the quartiles from a sketch of bounded size, for values
    that repeat too rarely to be counted. Numbers are rounded to six decimals.
    """
    finite = df.filter("parameter IS NOT NULL AND abs(avg) < DOUBLE('Infinity')").selectExpr(
        "parameter", "avg AS _v"
    )
    # All branches below start from these counts. The bin is declared non-null, or the
    # joins would add different null filters and each branch would count for itself.
    values = (
        finite.groupBy("parameter", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
        .selectExpr("*", "coalesce(floor(_v), 0) AS _bin")
    )
    box = _approximate_quartiles(finite, accuracy) if approximate else _exact_quartiles(values)
    box = box.selectExpr(
        "*", f"q1 - {_WHISKER}D * (q3 - q1) AS _low", f"q3 + {_WHISKER}D * (q3 - q1) AS _high"
    )
    within = "_v BETWEEN _low AND _high"
    # The box of a pollutant is the same on all its rows, so it may serve as grouping key.
    whiskers = (
        values.join(box, "parameter")
        .groupBy(*box.columns)
        .agg(
            F.min("_v").alias("min"),
            F.expr(f"min(CASE WHEN {within} THEN _v END)").alias("whisker_low"),
            F.expr(f"max(CASE WHEN {within} THEN _v END)").alias("whisker_high"),
            F.max("_v").alias("max"),
            F.expr(f"sum(if({within}, 0L, _n))").alias("outliers"),
        )
    )
    numbers = ["min", "whisker_low", "q1", "median", "q3", "whisker_high", "max"]
    return whiskers.select(
        "parameter",
        F.col("n").alias("windows"),
        *(round_half_up(f"`{c}`", _DIGITS).alias(c) for c in numbers),
        "outliers",
    ).orderBy("parameter")
