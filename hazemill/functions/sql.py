"""The same expressions as SQL functions.

``CREATE TEMPORARY FUNCTION ... RETURN <expression>`` is inlined by the analyzer, so a
call from SQL is optimised and compiled like the column builders.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from hazemill.functions.air import aqi_category_text, aqi_text
from hazemill.functions.checks import code_text, reason_text, spec_texts
from hazemill.functions.numeric import PART_TYPES, Parts, parts_text, round_half_up_text, total_text


def _definitions() -> dict[str, tuple[str, str, str]]:
    part = parts_text("v")
    return {
        "aqi": ("p STRING, c DOUBLE", "INT", aqi_text("p", "c")),
        "aqi_category": ("i INT", "STRING", aqi_category_text("i")),
        "validate_code": (
            "p STRING, v DOUBLE, u STRING, lat DOUBLE, lon DOUBLE",
            "INT",
            code_text(spec_texts("p"), "v", "u", "lat", "lon"),
        ),
        "reason_message": ("c INT", "STRING", reason_text("c")),
        "round_half_up": ("v DOUBLE, d INT", "DOUBLE", round_half_up_text("v", "d")),
        # Row parts and total of an exact sum: sum_total(sum(part_above(x)), ...).
        **{
            f"part_{name}": ("v DOUBLE", kind, text)
            for name, kind, text in zip(Parts._fields, PART_TYPES, part)
        },
        "sum_total": (
            ", ".join(f"{name} {kind}" for name, kind in zip(Parts._fields, PART_TYPES)),
            "DOUBLE",
            total_text(Parts(*Parts._fields)),
        ),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions in this session, unless it has them, and return their names."""
    definitions = _definitions()
    if not spark.catalog.functionExists("sum_total"):
        for name, (arguments, kind, body) in definitions.items():
            spark.sql(
                f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments})"
                f" RETURNS {kind} RETURN {body}"
            )
    return list(definitions)
