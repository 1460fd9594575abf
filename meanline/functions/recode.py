"""Rule and table recodes as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def binary_code(column: str | Column, first: str) -> Column:
    """1.0 for ``first``, 2.0 for anything else (null included)."""
    value = F.col(column) if isinstance(column, str) else column
    return F.when(value == first, 1.0).otherwise(2.0)


def ordered_code(column: str | Column, codes: Mapping[str, float], otherwise: float) -> Column:
    """A code per listed value, ``otherwise`` for the rest."""
    value = F.col(column) if isinstance(column, str) else column
    chain = F
    for key, code in codes.items():
        chain = chain.when(value == key, float(code))
    return chain.otherwise(float(otherwise))


#: Age bands; the two bands between 46 and 55 share a code.
AGE_CODES = {"0-17": 1.0, "18-25": 2.0, "26-35": 3.0, "36-45": 4.0, "46-50": 5.0, "51-55": 5.0}
CITY_CODES = {"A": 1.0, "B": 2.0}


def gender_code(column: str | Column) -> Column:
    return binary_code(column, "F")


def age_code(column: str | Column) -> Column:
    return ordered_code(column, AGE_CODES, 6.0)


def city_code(column: str | Column) -> Column:
    return ordered_code(column, CITY_CODES, 3.0)


def marital_code(column: str | Column) -> Column:
    return binary_code(column, "0")


def topcoded_years(column: str | Column, top: str = "4+", top_code: float = 5.0) -> Column:
    """``top`` becomes ``top_code``; any other text is a number, plus one."""
    value = F.col(column) if isinstance(column, str) else column
    return F.when(value == top, top_code).otherwise(value.cast("double") + 1.0)


def shift_code(column: str | Column, by: float = -1.0) -> Column:
    """A code that counts from another origin (1..4 to 0..3)."""
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("double") + F.lit(float(by))


def recode_fixed(
    df: DataFrame,
    column: str,
    table: Mapping[float, float],
    output: str | None = None,
    *,
    on_unknown: str = "error",
    default: float = 0.0,
) -> DataFrame:
    """Replace ``column`` by its code in a fixed table.

    The table is small by nature, so it travels as a broadcast join side.
    ``on_unknown``: ``error`` stops the job at the first unlisted value, ``null``
    leaves it empty, ``default`` uses ``default``.
    """
    output = output or column
    lookup = df.sparkSession.createDataFrame(
        [(float(key), float(code)) for key, code in table.items()], "_key double, _code double"
    )
    joined = df.join(F.broadcast(lookup), F.col(column).cast("double") == F.col("_key"), "left")
    code = F.col("_code")
    if on_unknown == "default":
        code = F.coalesce(code, F.lit(default))
    elif on_unknown == "error":
        message = F.concat(F.lit(f"{column}: no code for "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
        code = F.when(code.isNull(), F.raise_error(message).cast("double")).otherwise(code)
    elif on_unknown != "null":
        raise ValueError(f"on_unknown: {on_unknown}")
    kept = [F.col(f"`{name}`") for name in df.columns if name != output]
    if output in df.columns:
        kept = [code.alias(output) if name == output else F.col(f"`{name}`") for name in df.columns]
        return joined.select(*kept)
    return joined.select(*kept, code.alias(output))
