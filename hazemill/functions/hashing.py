"""FNV-1a hashes, station slugs and rendezvous owners as column expressions.

The 64-bit state is kept as two 32-bit halves in BIGINT columns: the products then
never overflow, so ANSI mode needs no exception and the result is bit-identical to
unsigned 64-bit arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of FNV-1a.
_OFFSET_32, _PRIME_32 = 2166136261, 16777619
_OFFSET_64, _PRIME_64 = 14695981039346656037, 1099511628211
_PRIME_64_LOW = _PRIME_64 - 2**40  # the prime is 2**40 + 435

_MASK_32 = 0xFFFFFFFF
_MASK_64 = 0xFFFFFFFFFFFFFFFF


def _bytes(text: Column) -> Column:
    """UTF-8 bytes of a string as an array of BIGINT."""
    pairs = F.regexp_extract_all(F.hex(text), F.lit("(..)"), F.lit(1))
    return F.transform(pairs, lambda pair: F.conv(pair, 16, 10).cast("bigint"))


def fnv1a_32(text: Column) -> Column:
    """32-bit FNV-1a of the UTF-8 bytes, as a BIGINT."""
    return F.aggregate(
        _bytes(text),
        F.lit(_OFFSET_32).cast("bigint"),
        lambda state, byte: (state.bitwiseXOR(byte) * _PRIME_32).bitwiseAND(_MASK_32),
    )


def _step_64(state: Column, byte: Column) -> Column:
    low = state["low"].bitwiseXOR(byte)
    product = low * _PRIME_64_LOW
    high = state["high"] * _PRIME_64_LOW + F.shiftright(product, 32) + F.shiftleft(low, 8)
    return F.struct(
        high.bitwiseAND(_MASK_32).alias("high"), product.bitwiseAND(_MASK_32).alias("low")
    )


def _state_64(value: int) -> Column:
    return F.struct(
        F.lit(value >> 32).cast("bigint").alias("high"),
        F.lit(value & _MASK_32).cast("bigint").alias("low"),
    )


def fnv1a_64(text: Column) -> Column:
    """64-bit FNV-1a as struct<high, low>; comparing the structs compares the numbers."""
    return F.aggregate(_bytes(text), _state_64(_OFFSET_64), _step_64)


def _prefix_state(prefix: bytes) -> int:
    """State after hashing a short constant prefix, folded into the plan as a literal."""
    state = _OFFSET_64
    for byte in prefix:
        state = ((state ^ byte) * _PRIME_64) & _MASK_64
    return state


def station_slug(name: Column | str) -> Column:
    """Stable id of a station name: ``st-`` and eight hex digits."""
    text = F.col(name) if isinstance(name, str) else name
    return F.concat(F.lit("st-"), F.lpad(F.lower(F.hex(fnv1a_32(text))), 8, "0"))


def rendezvous_owner(station_id: Column | str, members: Sequence[str]) -> Column:
    """The member with the highest hash(member, NUL, station); NULL without members.

    A pure projection: neither a join with the members nor a shuffle.
    """
    if not members:
        return F.lit(None).cast("string")
    text = F.col(station_id) if isinstance(station_id, str) else station_id
    data = _bytes(text)
    candidates = F.array(
        *(
            F.struct(
                _state_64(_prefix_state(member.encode() + b"\0")).alias("state"),
                # The first of the sorted members wins a tie.
                F.lit(-place).alias("order"),
                F.lit(member).alias("member"),
            )
            for place, member in enumerate(sorted(set(members)))
        )
    )
    scored = F.transform(
        candidates,
        lambda m: F.struct(
            F.aggregate(data, m["state"], _step_64).alias("score"), m["order"], m["member"]
        ),
    )
    return F.array_max(scored)["member"]
