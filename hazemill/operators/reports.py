"""Rankings, summaries and chart tables over window aggregates.

Means are unweighted means of window means and counts are numbers of windows, not of
readings, as in the reports these replace.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemill import domain
from hazemill.functions.numeric import (
    Parts,
    exact_mean,
    exact_mean_text,
    exact_sum_text,
    round_half_up,
)
from hazemill.functions.sql import register_sql_functions
from hazemill.session import shared_dir

STATION = ["location", "city", "country"]
#: Columns that a matrix may have.
MATRIX_COLUMNS = 500


def by_parameter(df: DataFrame, parameter: str = "pm25") -> DataFrame:
    """Rows of one pollutant (the predicate reaches the Parquet scan)."""
    return df.filter(F.col("parameter") == parameter)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """``n`` rows: the first in the order of the given columns, any without them."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of the columns, sorted."""
    return df.select(*columns).distinct().orderBy(*columns)


def worst_stations(df: DataFrame, top: int = domain.TOP_STATIONS) -> DataFrame:
    """Stations with the highest mean PM2.5 index; ties by station, city and country."""
    ranked = by_parameter(df).groupBy(*STATION).agg(
        round_half_up("avg(aqi)", 1).alias("avg_aqi"),
        round_half_up(exact_mean_text("avg"), 2).alias("avg_pm25"),
        F.max("max").alias("peak_pm25"),
        F.count(F.lit(1)).alias("windows"),
    )
    return ranked.orderBy(F.desc("avg_aqi"), *STATION).limit(top)


def worst_stations_sql(
    spark: SparkSession, view: str = "aggregates", top: int = domain.TOP_STATIONS
) -> DataFrame:
    """The same ranking in SQL over a registered view, without cleaning the rows first."""
    register_sql_functions(spark)
    parts = ", ".join(f"sum(part_{name}(avg))" for name in Parts._fields)
    return spark.sql(
        f"""
        SELECT location, city, country,
               round_half_up(avg(aqi), 1) AS avg_aqi,
               round_half_up(sum_total({parts}) / count(avg), 2) AS avg_pm25,
               max(max) AS peak_pm25,
               count(*) AS windows
        FROM IDENTIFIER(:view)
        WHERE parameter = 'pm25'
        GROUP BY location, city, country
        ORDER BY avg_aqi DESC, location, city, country
        LIMIT :top
        """,
        args={"view": view, "top": top},
    )


def pollutant_summary(df: DataFrame) -> DataFrame:
    """Mean, extremes, total and number of windows per pollutant."""
    return (
        df.groupBy("parameter")
        .agg(
            round_half_up(exact_mean_text("avg"), 2).alias("mean"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
            round_half_up(exact_sum_text("sum"), 1).alias("sum"),
            F.count(F.lit(1)).alias("count"),
        )
        .orderBy("parameter")
    )


def aqi_category_breakdown(df: DataFrame) -> DataFrame:
    """Windows per health category, most frequent first."""
    counts = df.groupBy("aqi_category").agg(F.count(F.lit(1)).alias("windows"))
    return counts.orderBy(F.desc("windows"), "aqi_category")


def aqi_category_share(df: DataFrame) -> DataFrame:
    """Windows and percentage per health category."""
    counts = df.groupBy("aqi_category").agg(F.count(F.lit(1)).alias("windows"))
    # One row per category is left here, so the window without keys is small.
    share = round_half_up("windows * 100D / sum(windows) OVER ()", 2)
    return counts.withColumn("share_percent", share).orderBy(F.desc("windows"), "aqi_category")


def city_pollutant_matrix(
    df: DataFrame, parameters: Sequence[str] | None = None, most: int = MATRIX_COLUMNS
) -> DataFrame:
    """Mean concentration per city, one column per pollutant, 0 where there is none.

    Without ``parameters`` there is a column for each of the usual pollutants and, after them,
    for every other one that the rows hold, by name. The rows are aggregated once, to one row
    per city and pollutant in the shared folder; the columns are found there. More than
    ``most`` pollutants are refused, not left out.
    """
    means = df.groupBy("city", "parameter").agg(exact_mean("avg").alias("mean"))
    if parameters is None:
        folder = shared_dir(df.sparkSession, "matrix")
        means.write.parquet(folder)
        means = df.sparkSession.read.schema(means.schema).parquet(folder)
        found = means.select("parameter").distinct().filter("parameter IS NOT NULL").limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"more than {most} pollutants; name those that get a column")
        parameters = [*domain.PARAMETERS, *sorted({r[0] for r in found} - set(domain.PARAMETERS))]
    wide = means.groupBy("city").pivot("parameter", list(parameters)).agg(F.max("mean"))
    return wide.fillna(0.0, subset=[f"`{p}`" if "." in p else p for p in parameters]).orderBy("city")


def aqi_timeseries(df: DataFrame) -> DataFrame:
    """PM2.5 index over time, one series per city."""
    series = by_parameter(df).select("city", "window_end", "location_id", "aqi")
    return series.orderBy("city", "window_end", "location_id")
