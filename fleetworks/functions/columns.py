"""Small expression helpers shared by the plans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def lookup(table: Mapping, key: Column, default=None, cast: str | None = None) -> Column:
    """Value of ``key`` in a literal map; NULL, or ``default``, where the key is absent."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    value = F.try_element_at(F.create_map(*entries), key)
    if cast:
        value = value.cast(cast)
    return value if default is None else F.coalesce(value, F.lit(default))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL, not an error, over a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0))


def prorate(amount: Column, part: Column, whole: Column) -> Column:
    """``amount * part / whole`` to the cent, halves away from zero, for money with two decimals.

    Computed on whole cents, so no digit of an intermediate quotient can tip a half-cent the wrong way.
    """
    def cents(x: Column, digits: int) -> Column:
        return (x * 100).cast(f"decimal({digits},0)")

    product = cents(amount, 16) * cents(part, 18)
    divisor = cents(whole, 18)
    rounded = F.call_function("div", F.abs(product) * 2 + F.abs(divisor), F.abs(divisor) * 2)
    sign = F.when((product < 0) != (divisor < 0), F.lit(-1)).otherwise(F.lit(1))
    return ((rounded * sign).cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)")


def logistic(x: Column, low: float, high: float, midpoint: float, steepness: float) -> Column:
    """S-curve from ``low`` to ``high`` centred on ``midpoint``."""
    return F.lit(low) + F.lit(high - low) / (F.lit(1.0) + F.exp(F.lit(-steepness) * (x - F.lit(midpoint))))


def hash24(key: Column, salt: int = 0) -> Column:
    """Multiplicative hash of an integer key into [0, 2^24), in plain integer arithmetic.

    It stands in for random draws: the same key gives the same draw on every run and partitioning.
    The key is reduced below 2^31 first, so the product always fits a long.
    """
    reduced = F.pmod(key.cast("bigint") + F.lit(salt * 7919).cast("bigint"), F.lit(2147483648).cast("bigint"))
    mixed = F.pmod(reduced * F.lit(2654435761).cast("bigint"), F.lit(4294967296).cast("bigint"))
    return F.shiftright(mixed, 8)


def draw(key: Column, salt: int, n: Column | int) -> Column:
    """Deterministic pick of an index in [0, n)."""
    size = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(hash24(key, salt), size.cast("bigint"))


def coin(key: Column, salt: int, rate: float) -> Column:
    """True for about ``rate`` of the keys, always the same ones."""
    return hash24(key, salt) < F.lit(round(rate * 16777216)).cast("bigint")
