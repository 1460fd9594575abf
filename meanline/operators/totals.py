"""Totals per user and per day, and checks on sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meanline.functions.clean import exact

def total_of(df: DataFrame, column: str, scale: int | None = None) -> Column:
    """The sum of an amount as it is.

    Decimals and integers add up exactly.  Doubles do in any order only as decimals: name the ``scale``
    that holds every value; without it they are summed as doubles.
    """
    kind, amount = df.schema[column].dataType, F.col(f"`{column}`")
    if scale is not None and not isinstance(kind, T.DecimalType):
        return F.sum(exact(amount, scale))
    return F.sum(amount)


def sum_per_user(
    df: DataFrame, user: str, amount: str, attributes: Sequence[str], scale: int | None = None
) -> DataFrame:
    """Total per user with descriptive attributes, each the smallest one seen for the user."""
    return df.groupBy(user).agg(
        total_of(df, amount, scale).alias("total"), *[F.min(name).alias(name) for name in attributes]
    )


def equal_rows(df: DataFrame, by: Sequence[str], label: str = "label", *, extremes: bool = False) -> DataFrame:
    """(by…, label, n_rows, label_var): one row for the rows that agree in ``by``, with their mean label.

    Least squares and regression trees see of such rows only their number, their mean label and, in squared
    errors, its population variance within the group.  With ``extremes`` also label_min and label_max.  A
    null label among them makes the group's label null, so that a fit refuses it as it would the row.
    """
    taken = {"label", "n_rows", "label_var", "label_min", "label_max"} & set(by)
    if taken:
        raise ValueError(f"rename the columns {', '.join(sorted(taken))} first")
    whole = F.count(label) == F.count(F.lit(1))
    measures = [
        F.when(whole, F.avg(F.col(label).cast("double"))).alias("label"), F.count(F.lit(1)).alias("n_rows"),
        F.var_pop(F.col(label).cast("double")).alias("label_var"),
    ]
    if extremes:
        measures += [F.min(label).alias("label_min"), F.max(label).alias("label_max")]
    return df.groupBy(*by).agg(*measures)


def daily_rollup(df: DataFrame, ts: str, value: str, scale: int | None = None) -> DataFrame:
    """(day, n, total, mean_value) per date of ``ts``; the mean is over the values that are there."""
    total = total_of(df, value, scale)
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        total.alias("total"),
        (total.cast("double") / F.nullif(F.count(value), F.lit(0))).alias("mean_value"),
    )


def sum_check(df: DataFrame, parts: Sequence[str], whole: str | Column, tolerance: float = 0.0) -> DataFrame:
    """(n_rows, n_bad): rows where the parts do not add up to the whole."""
    target = F.col(whole) if isinstance(whole, str) else whole
    gap = F.abs(sum((F.col(part) for part in parts[1:]), F.col(parts[0])) - target)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(gap > tolerance).alias("n_bad"))


def max_scale(df: DataFrame, column: str, output: str, maximum: float | None = None) -> DataFrame:
    """``column`` divided by a fixed maximum, or by its own (one more aggregation)."""
    if maximum is None:
        maximum = float(df.agg(F.max(column).alias("m")).first()["m"])
    return df.select("*", (F.col(column) / F.lit(float(maximum))).alias(output))
