"""Writing results as delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_text(df: DataFrame, path: str, *, separator: str = ",", mode: str = "append") -> None:
    """One line per row.  Nulls are written as empty fields so positions hold."""
    fields = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in df.columns]
    df.select(F.concat_ws(separator, *fields).alias("value")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, *, header: bool = True, mode: str = "errorifexists") -> None:
    """Delimited text, one part file per partition, each with its header line."""
    df.write.mode(mode).option("header", header).csv(path)
