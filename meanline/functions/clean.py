"""Missing values and constant columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FRACTIONAL = (T.FloatType, T.DoubleType)


def fill_empty(column: str | Column, default: str = "0") -> Column:
    """Empty, blank or null text becomes ``default``, read as a double."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(default)).cast("double")


def exact(column: str | Column, scale: int) -> Column:
    """A number as a decimal with ``scale`` places, which the caller knows to be enough.

    Sums of decimals are exact in any order of addition; a value too large stops the job.
    """
    value = F.col(column) if isinstance(column, str) else column
    return value.cast(f"decimal(18,{scale})")


def null_nan_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls and NaNs per column, all columns in one pass: (feature, n_null, n_nan)."""
    columns = list(columns or df.columns)
    sums = []
    for name in columns:
        value = F.col(f"`{name}`")
        nan = F.isnan(value) if isinstance(df.schema[name].dataType, _FRACTIONAL) else F.lit(False)
        sums.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.count_if(value.isNull()).alias("n_null"),
                F.count_if(nan).alias("n_nan"),
            )
        )
    return df.agg(F.array(*sums).alias("_p")).select(F.inline("_p"))


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns with at most one distinct value, found by min = max in one pass."""
    columns = list(columns or df.columns)
    bounds = df.agg(
        *[
            F.min(F.col(f"`{name}`")).eqNullSafe(F.max(F.col(f"`{name}`"))).alias(str(position))
            for position, name in enumerate(columns)
        ],
        *[
            F.count_if(F.col(f"`{name}`").isNull()).alias(f"n{position}")
            for position, name in enumerate(columns)
        ],
        F.count(F.lit(1)).alias("n"),
    ).first()
    return [
        name
        for position, name in enumerate(columns)
        if bounds[str(position)] and bounds[f"n{position}"] in (0, bounds["n"])
    ]


def drop_constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Leave out columns that carry one value, as a month column does after a month filter."""
    return df.drop(*constant_columns(df, columns))
