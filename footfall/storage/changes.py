"""What each write of a table touched: small numbered files in the table's own folder.

A note is written before the write it tells of is moved in, so a run that dies in between
leaves a note too many and never one too few. Whoever keeps something derived from the table
remembers the number of the last note it has seen.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from footfall.storage import files

FOLDER = "_changes"  # Spark's readers leave such names out
GAINED = "_gained"


@dataclass(frozen=True)
class Changes:
    """``last`` is the newest note's number, 0 without any.

    ``touched`` names partition directories that were added to, rewritten or emptied, and
    ``gained`` those that rows were loaded into, or what the writer told instead, such as
    their days. Both are None where the whole table was
    replaced.
    """

    last: int
    touched: frozenset[str] | None
    gained: frozenset[str] | None


def are_kept(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path}/{FOLDER}")


def begin(spark: SparkSession, path: str) -> None:
    """Begins to keep the changes of a table that is there already: all of it counts as new."""
    if files.exists(spark, path) and not are_kept(spark, path):
        note(spark, path, 1, None)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in files.names(spark, f"{path}/{FOLDER}"))


def last(spark: SparkSession, path: str) -> int:
    return max(_numbers(spark, path), default=0)


def note(
    spark: SparkSession,
    folder: str,
    number: int,
    touched: Iterable[str] | None,
    gained: Iterable[str] | None = None,
) -> None:
    """Note ``number`` in ``folder``, the table's or one that is about to become it."""
    found = None if touched is None else sorted(touched)
    loaded = found if gained is None else sorted(gained)
    text = json.dumps({"touched": found, "gained": loaded})
    files.write_text(spark, f"{folder}/{FOLDER}/{number:010d}", text)


def since(spark: SparkSession, path: str, seen: int) -> Changes:
    """What the notes after number ``seen`` tell, together."""
    found = _numbers(spark, path)
    touched, gained = set(), set()
    whole = bool(found) and seen > found[-1]  # another table than the one that was seen
    for number in found:
        if number <= seen:
            continue
        told = json.loads(files.read_text(spark, f"{path}/{FOLDER}/{number:010d}") or "{}")
        # An empty note is of a write that died before it began.
        if told and told["touched"] is None:
            whole = True
        else:
            touched.update(told.get("touched", ()))
            gained.update(told.get("gained", ()))
    newest = max(found, default=0)
    if whole:
        return Changes(newest, None, None)
    return Changes(newest, frozenset(touched), frozenset(gained))


def seen(spark: SparkSession, marks: str) -> int | None:
    """The number that ``set_seen`` has put down last; None without any."""
    return max((int(name) for name in files.names(spark, marks)), default=None)


def set_seen(spark: SparkSession, marks: str, number: int) -> None:
    """Remembers a note as seen, by the name of a folder in the folder ``marks``."""
    before = files.names(spark, marks)
    if str(number) not in before:
        files.make_dirs(spark, f"{marks}/{number}")
    for name in before:
        if int(name) != number:
            files.delete(spark, f"{marks}/{name}")
