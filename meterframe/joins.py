"""Joins of many rows with facts about their keys, where one key may hold a
large share of the rows.

``facts`` has one row per key and says how many rows hold the key.  At most
``HEAVY`` keys can hold more than a share of 1 / HEAVY of the rows: their facts
are broadcast and the rows stay where they are.  All other rows meet their
facts by a shuffle, in which no key is larger than that share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY = 256
BROADCAST_ROWS = 200_000  # of about 100 bytes; more are joined by shuffles


def apart(rows: DataFrame, facts: DataFrame, on: list[str], count: str = "n") -> tuple[DataFrame, DataFrame | None, DataFrame, DataFrame]:
    """Rows with a heavy key, the facts of these keys (None: there is none), the
    other rows, though rows without a fact may be among either, and their facts."""
    seen = facts.agg(F.sum(count).alias("total"), F.max(count).alias("most")).first()
    border = (seen["total"] or 0) // HEAVY
    if (seen["most"] or 0) <= max(border, 1):
        return rows, None, rows, facts
    heavy = facts.where(F.col(count) > border)
    others = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    return rows, heavy, others, facts.where(F.col(count) <= border)


def meet(rows: DataFrame, facts: DataFrame, on: list[str], count: str = "n") -> DataFrame:
    """Inner join.  ``facts`` is a written table; keys are not null."""
    of_heavy, heavy, of_light, light = apart(rows, facts, on, count)
    if heavy is None:
        return of_light.join(light, on)
    return of_heavy.join(F.broadcast(heavy), on).unionByName(of_light.join(light, on))


def small(rows: DataFrame) -> DataFrame:
    """A hint to broadcast a written table whose rows were counted; the joined
    rows are the same either way."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
