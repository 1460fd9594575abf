"""Choosing, ordering, previewing and describing columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Years that a month filter writes out as date ranges.
_MOST_YEARS = 50


def label_first(df: DataFrame, label: str, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The label as a double named ``label``, then the features as doubles, then columns kept as they are."""
    return df.select(
        F.col(f"`{label}`").cast("double").alias("label"),
        *[F.col(f"`{name}`").cast("double").alias(name) for name in features],
        *keep,
    )


def filter_month(df: DataFrame, ts: str, month: int) -> DataFrame:
    """Rows of one calendar month of any year.

    ``month(ts) = m`` alone reaches no file statistics.  With the years that
    occur (one pass over this column) it becomes date ranges, which do.  Dates
    far off make too many ranges; then the test on the month stands alone.
    """
    span = df.agg(F.min(F.year(ts)).alias("low"), F.max(F.year(ts)).alias("high")).first()
    kind = df.schema[ts].dataType
    if span["low"] is not None and span["high"] - span["low"] >= _MOST_YEARS:
        return df.where(F.month(ts) == month)
    ranges = F.lit(False)
    for year in range(span["low"] or 0, (span["high"] or -1) + 1):
        start = F.lit(f"{year:04d}-{month:02d}-01").cast(kind)
        end = F.lit(f"{year + month // 12:04d}-{month % 12 + 1:02d}-01").cast(kind)
        ranges = ranges | ((F.col(ts) >= start) & (F.col(ts) < end))
    return df.where(ranges)


def preview(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in a stated order (a per-task top-n, never a full sort)."""
    return df.orderBy(*order_by).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """(position, column, type, n_rows, n_null) per column; the counts take one pass."""
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(f"`{field.name}`").isNull()).alias("n_null"),
        )
        for position, field in enumerate(df.schema)
    ]
    return df.agg(F.array(*entries).alias("_s")).select(F.inline("_s"))
