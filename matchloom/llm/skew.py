"""A fact of each key brought back to the rows of that key, where one key may hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import fresh

#: A key with one row in so many is sent to all executors: there are at most that many of them.
SHARE = 1000


def join_back(rows: DataFrame, facts: DataFrame, on: Sequence[str], total: int, weight: str) -> DataFrame:
    """``rows`` left-joined with ``facts`` (one row a key; ``weight``: how many rows have the key; dropped).

    Keys that hold a 1000th of ``total`` rows or more, so 1000 keys at most, are broadcast; rows that meet one are
    spread over all tasks of the exchange in which the other rows meet theirs, so a task holds no key with more than a
    1000th of the rows. Null keys meet nothing. ``facts`` is read twice: pass a materialised one.
    """
    found = [c for c in facts.columns if c not in (*on, weight)]
    taken = [*rows.columns, *facts.columns]
    hit, deal = fresh(taken, "_hit"), fresh(taken, "_deal")
    much = facts.where(F.col(weight) * SHARE >= total).select(*on, *[F.col(c).alias(f"{c}{hit}") for c in found], F.lit(True).alias(hit))
    little = facts.where(F.col(weight) * SHARE < total).select(*on, *found, F.lit(0).alias(deal))
    met = rows.join(F.broadcast(much), list(on), "left")
    spread = met.withColumn(deal, F.when(F.col(hit), 1 + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20))).otherwise(0).cast("int"))
    both = spread.join(little, [*on, deal], "left")
    return both.select(*rows.columns, *[F.coalesce(f"{c}{hit}", c).alias(c) for c in found])
