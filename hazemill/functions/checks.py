"""Validation of one reading as a CASE expression; the first rule that fails wins.

Arguments are SQL expressions, usually column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazemill import domain
from hazemill.functions.numeric import real


def _per_pollutant(p: str, values: dict[str, str]) -> str:
    # A constant map names p once; CASE p WHEN ... would repeat it for every pollutant.
    entries = ", ".join(f"'{name}', {value}" for name, value in values.items())
    return f"try_element_at(map({entries}), {p})"


def spec_texts(p: str) -> dict[str, str]:
    """Expected unit and range of a pollutant; NULL for an unknown one."""
    specs = domain.SPECS.items()
    return {
        "expected_unit": _per_pollutant(p, {name: f"'{s.unit}'" for name, s in specs}),
        "min_value": _per_pollutant(p, {name: real(s.low) for name, s in specs}),
        "max_value": _per_pollutant(p, {name: real(s.high) for name, s in specs}),
    }


def code_text(spec: dict[str, str], v: str, u: str, lat: str, lon: str) -> str:
    """Code of a reading against the spec expressions of its pollutant."""
    north, east = real(domain.LATITUDE_LIMIT), real(domain.LONGITUDE_LIMIT)
    on_earth = f"{lat} BETWEEN -{north} AND {north} AND {lon} BETWEEN -{east} AND {east}"
    return (
        f"CASE WHEN {spec['max_value']} IS NULL THEN 1"
        # NaN sorts above every number, so it must be caught before the range test.
        f" WHEN {v} IS NULL OR isnan({v}) OR abs({v}) = DOUBLE('Infinity') OR {v} < 0D THEN 2"
        f" WHEN {v} < {spec['min_value']} OR {v} > {spec['max_value']} THEN 3"
        # A missing or empty unit skips the unit test.
        f" WHEN {u} <> '' AND {u} <> {spec['expected_unit']} THEN 4"
        # NULL and NaN coordinates are not on earth either.
        f" WHEN {on_earth} THEN 0 ELSE 5 END"
    )


def reason_text(c: str) -> str:
    rows = " ".join(f"WHEN {number} THEN '{text}'" for number, text in domain.REASONS.items())
    return f"CASE {c} {rows} ELSE '{domain.UNKNOWN_REASON}' END"


def spec_columns(parameter: str) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in spec_texts(parameter).items()}


def validate_code(
    parameter: str, value: str, unit: str = "''", latitude: str = "0D", longitude: str = "0D"
) -> Column:
    """Code 0 for a valid reading, 1 to 5 for the first rule it breaks."""
    return F.expr(code_text(spec_texts(parameter), value, unit, latitude, longitude))


def reason_message(code: str) -> Column:
    """Message of a validation code."""
    return F.expr(reason_text(code))
