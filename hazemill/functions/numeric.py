"""Rounding and order-independent sums.

A double sum depends on the order in which partitions arrive, so a mean that lies on
a rounding tie could change from run to run. ``exact_sum`` cuts each double at fixed
powers of two, which loses nothing, and adds the pieces: four 64-bit integers hold the
whole part and the fraction, the few bits above and below them are doubles that are
multiples of one power of two and so add without rounding too. All buffers have a
fixed width (a decimal sum costs about twice as much time).

Arguments are SQL expressions, usually column names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of a piece: 2^39 pieces add up in 64 bits.
_BITS = 24


class Parts(NamedTuple):
    """A value (or a sum of values), cut at powers of 2^24.

    ``above`` is the multiple of 2^24 and carries NaN and infinities, ``whole`` the rest
    of the whole part; ``frac1`` to ``frac3`` count units of 2^-24, 2^-48 and 2^-72, and
    ``below`` is what is left. Pieces have the sign of the value. They are NULL for a
    NULL value, and so is the total of a group without values.
    """

    above: str
    whole: str
    frac1: str
    frac2: str
    frac3: str
    below: str


PART_TYPES = Parts("DOUBLE", "BIGINT", "BIGINT", "BIGINT", "BIGINT", "DOUBLE")
#: Column names of summed parts.
SUMS = Parts(*(f"_{name}" for name in Parts._fields))


def real(value: float) -> str:
    """A double literal."""
    return f"{value!r}D"


def parts_text(v: str) -> Parts:
    """The parts of a value. The remainder of a division by a power of two is exact."""

    def rest(cut: int) -> str:
        return f"nanvl({v} % {real(2.0**cut)}, 0D)"

    def piece(high: int, low: int) -> str:
        return f"floor(({rest(high)} - {rest(low)}) * {real(2.0**-low)})"

    return Parts(
        f"({v} - {rest(_BITS)})",
        *(piece(cut, cut - _BITS) for cut in (_BITS, 0, -_BITS, -2 * _BITS)),
        rest(-3 * _BITS),
    )


def total_text(sums: Parts) -> str:
    """The double closest to the summed parts.

    Carries are moved up first; then whole part and first fraction make one double
    without rounding (below 2^29), the two lower fractions another.
    """
    unit, mask = real(2.0**-_BITS), (1 << _BITS) - 1
    carry2 = f"({sums.frac2} + shiftright({sums.frac3}, {_BITS}))"
    carry1 = f"({sums.frac1} + shiftright({carry2}, {_BITS}))"
    upper = f"({sums.whole} + {carry1} * {unit})"
    lower = f"((({carry2} & {mask}L) + ({sums.frac3} & {mask}L) * {unit}) * {real(2.0 ** (-2 * _BITS))})"
    return f"({sums.above} + ({upper} + ({lower} + {sums.below})))"


def exact_sum_text(v: str) -> str:
    """Aggregate: the sum of a double column, the same in any order."""
    return total_text(Parts(*(f"sum({part})" for part in parts_text(v))))


def exact_mean_text(v: str) -> str:
    """Aggregate: ``exact_sum`` over the number of values."""
    return f"({exact_sum_text(v)} / nullif(count({v}), 0))"


def round_half_up_text(v: str, digits: int | str = 0) -> str:
    """Round the double itself, ties away from zero.

    ``round(v, 2)`` would work on the decimal text instead and turn 2.675 into 2.68;
    rounding to a whole number is the same either way.
    """
    factor = f"power(10D, {digits})" if isinstance(digits, str) else real(10.0**digits)
    return f"(round(({v}) * {factor}) / {factor})"


def round_window_text(v: str) -> str:
    """Two decimals the way the window roll-up writes them: add a half, cut off."""
    scaled = f"({v} * 100D + 0.5D)"
    return f"(({scaled} - nanvl({scaled} % 1D, 0D)) / 100D)"


def exact_sum(value: str) -> Column:
    return F.expr(exact_sum_text(value))


def exact_mean(value: str) -> Column:
    return F.expr(exact_mean_text(value))


def round_half_up(value: str, digits: int = 0) -> Column:
    return F.expr(round_half_up_text(value, digits))


def round_window(value: str) -> Column:
    return F.expr(round_window_text(value))
