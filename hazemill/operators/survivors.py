"""One row per key: a number that ranks the rows is reduced in hash tables, and the rows that
have the winning number are read by it afterwards. Only rows that tie are sorted, and only
where their order is stated."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a rank: what a decimal of 38 digits holds and Spark keeps in a fixed-width buffer.
RANK_BITS = 125
_RANK, _KEY, _HASH, _PLACE = "_rank", "_key_{}", "_hash", "_place"


def row_hash(df: DataFrame) -> Column:
    """64 bits of a whole row; which columns are NULL counts too."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    missing = [F.when(c.isNull(), F.lit(1 << (i % 62))).otherwise(F.lit(0)) for i, c in enumerate(columns)]
    return F.xxhash64(*columns, *(sum(missing[i : i + 62], F.lit(0)) for i in range(0, len(missing), 62)))


def newest_rank() -> list[tuple[Column, int]]:
    """Later window ends rank higher; rows without an end lowest."""
    micros = F.unix_micros(F.col("window_end").cast("timestamp"))
    return [(F.coalesce(micros + F.lit(1 << 61), F.lit(0)), 62)]


def version_rank(columns: Sequence[str]) -> list[tuple[Column, int]]:
    """Of a window's versions the one with the most readings ranks highest, then the one
    published last or, if that is not known, the one with the lowest mean, to the hundredth
    that is stored."""
    readings = F.greatest(F.coalesce("count", F.lit(0)), F.lit(0))
    if "published" in columns:
        micros = F.unix_micros(F.col("published").cast("timestamp"))
        return [(readings, 40), (F.coalesce(micros, F.lit(0)), 52)]
    highest = F.lit(float(1 << 42))
    mean = F.when(F.col("avg").isNull() | F.isnan("avg"), highest).otherwise(F.round(F.col("avg") * 100))
    low = highest - F.greatest(F.least(mean, highest), -highest)
    return [(readings, 40), (low.cast("bigint"), 44)]


def version_order(columns: Sequence[str]) -> list[Column]:
    """The order that ``version_rank`` cuts to whole numbers, in full: no caps, no rounding,
    and the mean counts among versions published at one time too."""
    mean = F.when(F.col("avg").isNull() | F.isnan("avg"), F.lit(1e300)).otherwise(F.col("avg"))
    published = [F.col("published").desc_nulls_last()] if "published" in columns else []
    return [F.col("count").desc_nulls_last(), *published, mean.asc()]


def _packed(df: DataFrame, rank: list[tuple[Column, int]], hashed: bool) -> Column:
    """Parts of a rank and, below them, bits of the row's hash (if ``hashed``) as one number;
    each part is cut off at its bits."""
    left = min(RANK_BITS - sum(bits for _, bits in rank), 62)
    below = [(row_hash(df).bitwiseAND(F.lit((1 << left) - 1)), left)] if hashed else []
    if not rank:
        return below[0][0]
    parts = [(F.least(column, F.lit((1 << bits) - 1)), bits) for column, bits in [*rank, *below]]

    def joined(total: Column, part: tuple[Column, int]) -> Column:
        column, bits = part
        shifted = (total * F.lit(1 << bits).cast("decimal(20,0)")).cast("decimal(38,0)")
        return (shifted + column.cast("decimal(20,0)")).cast("decimal(38,0)")

    return reduce(joined, parts[1:], parts[0][0].cast("decimal(38,0)"))


def one_per_key(
    df: DataFrame,
    keys: Sequence[str],
    rank: Sequence[tuple[Column, int]] = (),
    order: Sequence[Column] = (),
) -> DataFrame:
    """The row of each key with the highest ``rank``. Of equal ranks it is the first by
    ``order`` and then by the other columns, each ascending with NULL first; without an order
    the one with the highest hash of all its columns. NULL is a key like any other, equal rows
    are one.

    ``rank`` has non-negative whole numbers and their bits, the most important first; an
    ``order`` may refine it, not contradict it. Every task reduces its rows to one number per
    key before the shuffle, in hash tables since the number has a fixed width; only then the
    rows themselves are met, by key and number. Where few rows win, that is a broadcast of the
    winners and moves no row. With an order each task then passes on the first of its rows that
    tie, so a key whose rows all tie is shuffled as one row per task.
    """
    ranked = df.withColumn(_RANK, _packed(df, list(rank), hashed=not order))
    won = ranked.groupBy(*keys).agg(F.max(_RANK).alias(_HASH))
    won = won.select(_HASH, *(F.col(k).alias(_KEY.format(i)) for i, k in enumerate(keys)))
    same = F.col(_RANK) == F.col(_HASH)
    for i, k in enumerate(keys):
        same = same & ranked[k].eqNullSafe(won[_KEY.format(i)])
    top = ranked.join(won, same, "left_semi").select(*df.columns)
    if not order:
        return top.distinct()
    rest = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns if c not in keys]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return top.withColumn(_PLACE, place).filter(F.col(_PLACE) == 1).drop(_PLACE)
