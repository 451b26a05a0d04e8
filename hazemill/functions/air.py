"""Air Quality Index of a concentration: CASE expressions written from the tables.

The text serves the column builders and the SQL functions alike. Arguments are SQL
expressions, usually column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazemill import domain
from hazemill.domain import Band
from hazemill.functions.numeric import real


class _Pieces:
    """Straight pieces slope * (c - start) + base, numbered in order of appearance."""

    def __init__(self) -> None:
        self.slope, self.start, self.base = [], [], []

    def add(self, base: int, slope: float = 0.0, start: float = 0.0) -> int:
        self.slope.append(slope)
        self.start.append(start)
        self.base.append(float(base))
        return len(self.base) - 1

    def add_band(self, band: Band) -> int:
        slope = (band.i_high - band.i_low) / (band.c_high - band.c_low)
        return self.add(band.i_low, slope, band.c_low)


def _piece_of(pieces: _Pieces, bands: list[Band], c: str, close_gaps: bool) -> str:
    """Number of the piece that holds a concentration of one pollutant.

    Rows and gaps come in ascending order, so each needs only its upper end. NaN and
    everything outside the table belong to the constant piece of its top index.
    """
    top = pieces.add(bands[-1].i_high)
    cases = [f"WHEN {c} < {real(bands[0].c_low)} THEN {top}"]
    for band, following in zip(bands, bands[1:] + [None]):
        cases.append(f"WHEN {c} <= {real(band.c_high)} THEN {pieces.add_band(band)}")
        if following is not None:
            gap = pieces.add(band.i_high) if close_gaps else top
            cases.append(f"WHEN {c} < {real(following.c_low)} THEN {gap}")
    return f"CASE {' '.join(cases)} ELSE {top} END"


def aqi_text(p: str, c: str, gaps: str = "reference") -> str:
    """One CASE finds the piece, one formula serves all of them.

    A formula per row would compile to a method above 8 KB, which the JVM leaves
    interpreted: four times slower.
    """
    if gaps not in ("reference", "close"):
        raise ValueError(f"gaps must be 'reference' or 'close', not {gaps!r}")
    pieces = _Pieces()
    unknown = pieces.add(domain.UNKNOWN_AQI)
    tables = " ".join(
        f"WHEN '{name}' THEN {_piece_of(pieces, bands, c, gaps == 'close')}"
        for name, bands in domain.AQI_BANDS.items()
    )
    piece = f"CASE {p} {tables} ELSE {unknown} END"

    def of_piece(values: list[float]) -> str:
        return f"get(array({', '.join(real(v) for v in values)}), {piece})"

    # Finite on constant pieces, where the slope of 0 must not meet NaN or infinity.
    # least and greatest skip NULL, but a missing concentration has no index.
    finite = f"if({c} IS NULL, NULL, greatest(least({c}, 1e6D), -1D))"
    index = f"{of_piece(pieces.slope)} * ({finite} - {of_piece(pieces.start)}) + {of_piece(pieces.base)}"
    return f"CAST(round({index}) AS INT)"


def aqi_category_text(i: str) -> str:
    rows = " ".join(f"WHEN {i} <= {upper} THEN '{name}'" for upper, name in domain.AQI_CATEGORIES)
    return (
        f"CASE WHEN {i} < 0 THEN '{domain.UNKNOWN_CATEGORY}' {rows}"
        f" WHEN {i} IS NOT NULL THEN '{domain.TOP_CATEGORY}' END"
    )


def aqi(parameter: str, concentration: str, gaps: str = "reference") -> Column:
    """Index of a concentration; -1 for a pollutant without a table.

    The breakpoint rows leave gaps (12.0 to 12.1 for pm25). With ``gaps="reference"``
    a concentration inside one gets the top index of its table, as the original rules
    do. ``gaps="close"`` extends each row up to the next one instead.
    """
    return F.expr(aqi_text(parameter, concentration, gaps))


def aqi_category(index: str) -> Column:
    """Health category of an index; NULL for NULL."""
    return F.expr(aqi_category_text(index))
