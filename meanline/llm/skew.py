"""Joining many rows with one row for each key, where a few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one in so many rows is broadcast; there can be no more such keys than this.
PARTS = 1024


def join_totals(rows: DataFrame, totals: DataFrame, key: str, held: str, how: str = "inner") -> DataFrame:
    """``rows`` with the other columns of ``totals``, which has each ``key`` at most once, never null.

    ``held`` is the column of ``totals`` with the number of rows of its key.  Keys of more than one in
    ``PARTS`` rows, at most ``PARTS`` of them, are joined by broadcast; the others by a shuffle, in
    which their rows are no large group.  Both inputs are read twice: pass tables, not long plans.
    """
    every = totals.agg(F.coalesce(F.sum(held), F.lit(0))).first()[0]
    frequent = F.col(held) * PARTS > F.lit(every)
    large = totals.where(frequent)
    here = rows.join(F.broadcast(large), key, "inner")
    others = rows.join(F.broadcast(large.select(key)), key, "left_anti")
    return here.unionByName(others.join(totals.where(~frequent), key, how), allowMissingColumns=False)
