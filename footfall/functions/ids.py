"""Unsigned ids of eight bytes in signed longs.

An id above 2**63 - 1 rests as itself less 2**64, so every id has eight bytes, equal ids are
equal, and joins stay on longs. Only order and text need the functions here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LEAST, _LARGEST = 1 << 63, (1 << 64) - 1


def _up_to(digits: str) -> str:
    """A pattern of the numbers from 0 to ``digits``, with as many places."""
    if not digits:
        return ""
    first, rest = int(digits[0]), digits[1:]
    same = f"{first}{_up_to(rest)}"
    return f"(?:[0-{first - 1}][0-9]{{{len(rest)}}}|{same})" if first else same


_PLACES = 19  # a number with fewer is a long
_DIGITS = rf"^ *\+?0*([0-9]{{1,{_PLACES}}}|{_up_to(str(_LARGEST))}) *$"


def from_text(text: Column) -> Column:
    """The id that a text of digits names, NULL if it names none from 0 to 2**64 - 1.

    A cast that fails takes many times as long as one that holds (a million in two tasks: 3.9 s
    and 0.2 s), so long texts are taken by a pattern first. One pattern for all of it keeps a row of many ids a method that the
    JVM compiles.
    """
    large = F.conv(F.regexp_extract(text, _DIGITS, 1), 10, -10).try_cast("bigint")
    small = text.try_cast("bigint")
    return F.coalesce(
        F.when(F.length(text) >= _PLACES, large), F.when(small >= 0, small)
    )


def to_text(stored: Column) -> Column:
    """The id as the text that it came from."""
    large = F.conv(F.hex(stored), 16, 10)
    return F.when(stored >= 0, stored.cast("string")).otherwise(large)


def in_order(stored: Column) -> Column:
    """A long that sorts as the id does."""
    return stored.bitwiseXOR(F.lit(-_LEAST))


def as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the ids in some of its columns as text."""
    return df.withColumns({name: to_text(F.col(name)) for name in columns})


def last_text(df: DataFrame, key: str, column: str) -> DataFrame:
    """Per ``key`` the id of ``column`` whose text sorts last.

    Of ids with as many digits that is the largest one, so most rows are told apart as longs,
    which takes no sort of texts.
    """
    stored, digits = F.col(column), f"{column}_digits"
    largest = df.groupBy(key, F.length(to_text(stored)).alias(digits)).agg(
        F.max(in_order(stored)).alias(column)
    )
    return largest.groupBy(key).agg(F.max(to_text(in_order(F.col(column)))).alias(column))
