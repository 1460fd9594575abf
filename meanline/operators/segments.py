"""Customer segments and count anomalies."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meanline.operators.order import Wanted, add_ntiles, order_statistics
from meanline.operators.totals import total_of
from meanline.sources.storage import shared_table


def rfm_segments(
    df: DataFrame, customer: str, date: str, amount: str, as_of: str, tiles: int = 5, scale: int | None = None
) -> DataFrame:
    """Recency, frequency and monetary value per customer, each cut into ``tiles``.

    Tile 1 holds the smallest values on every axis.  The customer table is kept
    once; the tiles come from a few cut keys per axis, not from sorting it.
    """
    customers = shared_table(
        df.groupBy(customer).agg(
            F.date_diff(F.lit(as_of).cast("date"), F.to_date(F.max(date))).alias("recency"),
            F.count(F.lit(1)).alias("frequency"),
            total_of(df, amount, scale).alias("monetary"),
        ),
        "customers",
    )
    axes = {"recency": "r_tile", "frequency": "f_tile", "monetary": "m_tile"}
    tiled = add_ntiles(customers, axes, customer, tiles)
    segment = F.concat_ws("-", *[F.col(tile).cast("string") for tile in axes.values()])
    return tiled.select("*", segment.alias("segment"))


#: A day farther from the quartiles of all days than a year and so many times their distance is a stray one.
_REACH = 8


def usual_days(df: DataFrame, ts: str) -> tuple[datetime.date, datetime.date] | None:
    """First and last day of the table without stray dates, None if there are no days.

    The quartiles of the rows' days are exact ranks, which up to a quarter of stray rows on either side
    does not move far.
    """
    days = df.where(F.col(ts).isNotNull()).select(F.to_date(ts).alias("day"))
    total = days.count()
    if not total:
        return None
    ranks = [max(1, total // 4), min(total, total - total // 4 + 1)]
    low, high = (place.value for place in order_statistics(days, [Wanted("day", rank, total) for rank in ranks]))
    reach = 366 + _REACH * (high - low).days
    near = (F.datediff(F.lit(low), "day") <= reach) & (F.datediff("day", F.lit(high)) <= reach)
    row = days.where(near).agg(F.min("day"), F.max("day")).first()
    return row[0], row[1]


def hourly_counts(df: DataFrame, ts: str, days: tuple[datetime.date, datetime.date] | None = None) -> DataFrame:
    """(day, hr, n) for every hour from the first of ``days`` to the last, as found by `usual_days` if not given.

    Hours without rows count 0; rows of other days are left out.
    """
    days = days or usual_days(df, ts)
    day, hr = F.to_date(ts), F.hour(ts)
    if days is None:
        return df.limit(0).select(day.alias("day"), hr.alias("hr"), F.lit(0).cast("bigint").alias("n"))
    first, last = F.lit(days[0]), F.lit(days[1])
    counts = df.where(day.between(first, last)).groupBy(day.alias("day"), hr.alias("hr")).agg(F.count(F.lit(1)).alias("n"))
    # the days are numbered task by task, so that no task lays out a long range alone
    length = (days[1] - days[0]).days + 1
    cells = df.sparkSession.range(length).select(
        F.date_add(first, F.col("id").cast("int")).alias("day"), F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hr")
    )
    return cells.join(counts, ["day", "hr"], "left").select("day", "hr", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def count_anomalies(
    df: DataFrame, ts: str, threshold: float = 2.5, *, robust: bool = False, days: tuple[datetime.date, datetime.date] | None = None
) -> DataFrame:
    """Hours whose count is far from the usual count at that hour of day: (day, hr, n, z).

    Events are counted per hour first.  Centre and spread of the 24 hours of day are a grouped table joined
    back, so no hour has to fit one task.  They are mean and standard deviation or, with ``robust``, median
    and median deviation (times 1.4826, its ratio to a normal's standard deviation), which a few wild hours
    do not move.  Stray dates do not stretch the calendar; see `usual_days`.
    """
    counts = hourly_counts(df, ts, days)
    if robust:
        centres = counts.groupBy("hr").agg(F.median("n").alias("_centre"))
        distance = counts.join(F.broadcast(centres), "hr").withColumn("_far", F.abs(F.col("n") - F.col("_centre")))
        usual = distance.groupBy("hr", "_centre").agg((F.median("_far") * 1.4826).alias("_spread"))
    else:
        usual = counts.groupBy("hr").agg(F.avg("n").alias("_centre"), F.stddev_samp("n").alias("_spread"))
    z = (F.col("n") - F.col("_centre")) / F.nullif(F.col("_spread"), F.lit(0.0))
    scored = counts.join(F.broadcast(usual), "hr").select("day", "hr", "n", z.alias("z"))
    return scored.where(F.abs("z") > threshold)
