"""Exact money. Prices rest as doubles and are summed as whole ten-thousandths in two longs.

A sum of doubles depends on the order of its rows, which a shuffle does not fix. An amount is
``high * 2**28 + low`` ten-thousandths with ``low`` from 0 to 2**28 - 1, so sums of both halves
stay in longs, and no decimal is needed for each row. A price may have 20 digits before the
point; a larger one, or one that is no number, stops the job, and so does a sum beyond 2 * 10**23
or of more than 3 * 10**10 rows, with and without ANSI arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(24,4)"
_BITS = 28
_LOW = (1 << _BITS) - 1
# Up to here a double tells any two amounts of four places apart.
_PLAIN = 1e15


def _pair(high: Column, low: Column) -> Column:
    return F.struct(high.alias("high"), low.alias("low"))


def exact(price: Column) -> Column:
    """The price as a pair of longs; of a NULL price both are NULL.

    Prices of four places at most are scaled as doubles, which is exact for them. All
    others are rounded as decimals.
    """
    price = price.cast("double")
    scaled = F.rint(price * 10000.0)
    plain = (F.abs(scaled) < _PLAIN) & (scaled / 10000.0 == price)
    wide = price.try_cast(_EXACT)
    message = F.concat(F.lit("not an amount of money: "), price.cast("string"))
    units = (F.coalesce(wide, F.raise_error(message).cast(_EXACT)) * 10000).cast("decimal(28,0)")
    rest = F.pmod(units, F.lit(1 << _BITS)).cast("decimal(28,0)")
    high = ((units - rest) / (1 << _BITS)).cast("long")
    whole = scaled.cast("long")
    return _pair(
        F.when(plain, F.shiftright(whole, _BITS)).when(price.isNotNull(), high),
        F.when(plain, whole.bitwiseAND(_LOW)).when(price.isNotNull(), rest.cast("long")),
    )


def where(condition: Column, value: Column) -> Column:
    """The amount where the condition holds and there is one, else 0."""
    zero = F.lit(0).cast("long")
    return _pair(
        F.when(condition, F.coalesce(value["high"], zero)).otherwise(zero),
        F.when(condition, F.coalesce(value["low"], zero)).otherwise(zero),
    )


def settled(high: Column, low: Column, rows: Column) -> Column:
    """The amount of two sums, which are NULL where they were too large; NULL without ``rows``."""
    lost = (rows > 0) & (high.isNull() | low.isNull())
    stop = F.raise_error(F.lit("a sum of money is too large")).cast("long")
    carried = F.try_add(high, F.shiftright(low, _BITS))
    return _pair(
        F.when(lost | (carried.isNull() & (rows > 0)), stop).otherwise(carried),
        low.bitwiseAND(_LOW),
    )


def total(value: Column) -> Column:
    """Sum of amounts; NULL if all are."""
    rows = F.count(value["high"])
    return settled(F.try_sum(value["high"]), F.try_sum(value["low"]), rows)


def amount(value: Column) -> Column:
    """The nearest double."""
    high, low = value["high"], value["low"]
    # Below 2**53 the quotient of two doubles is the nearest one.
    plain = F.shiftleft(high, _BITS) + low
    wide = high.cast("decimal(20,0)") * F.lit(1 << _BITS).cast("decimal(9,0)") + low
    ten_thousandth = F.lit("0.0001").cast("decimal(4,4)")
    small = F.abs(high) < 1 << (52 - _BITS)
    return F.when(small, plain / 10000.0).otherwise((wide * ten_thousandth).cast("double"))


def average(total: Column, count: Column) -> Column:
    """Amount per order; NULL where there are no orders."""
    return F.try_divide(total, count.cast("double"))
