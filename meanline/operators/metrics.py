"""Regression metrics as one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Names of the columns `metric_columns` gives.
METRICS = ("n", "rmse", "r2")


def metric_columns(label: str = "label", prediction: str = "prediction") -> list[Column]:
    """n, rmse and r2 = 1 - SSres / SStot (not the squared correlation; may be negative)."""
    y, error = F.col(label), F.col(label) - F.col(prediction)
    n, residual = F.count(error), F.sum(error * error)
    total = F.var_pop(F.when(error.isNotNull(), y)) * n
    return [
        n.alias("n"),
        F.sqrt(residual / F.nullif(n, F.lit(0))).alias("rmse"),
        (1 - residual / F.nullif(total, F.lit(0.0))).alias("r2"),
    ]


def group_metric_columns(label: str = "label", prediction: str = "prediction", centre: float = 0.0) -> list[Column]:
    """The same of the rows behind groups from `totals.equal_rows`, whose rows share a prediction.

    Labels are taken from ``centre``, best their mean, lest their squares outweigh their variance.
    """
    n_rows, within = F.col("n_rows"), F.col("label_var")
    y, error = F.col(label) - F.lit(centre), F.col(label) - F.col(prediction)
    n, residual = F.sum(n_rows), F.sum(n_rows * (error * error + within))
    total = F.sum(n_rows * (y * y + within)) - F.sum(n_rows * y) * F.sum(n_rows * y) / n
    return [
        n.alias("n"),
        F.sqrt(residual / n).alias("rmse"),
        (1 - residual / F.nullif(total, F.lit(0.0))).alias("r2"),
    ]


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """(by…, n, rmse, r2)."""
    return df.groupBy(*by).agg(*metric_columns(label, prediction))


def residuals(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The scored rows with ``residual`` = label - prediction."""
    return df.select("*", (F.col(label) - F.col(prediction)).alias("residual"))
