"""Reading delimited text and tables with declared schemas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _doubles(names: str) -> list[T.StructField]:
    return [T.StructField(name, T.DoubleType()) for name in names.split()]


#: Hourly rentals: record index, date, eleven calendar and weather columns, counts.
HOURLY_SCHEMA = T.StructType(
    [T.StructField("instant", T.IntegerType()), T.StructField("dteday", T.DateType())]
    + _doubles("season yr mnth hr holiday weekday workingday weathersit temp atemp hum windspeed")
    + [T.StructField("casual", T.IntegerType()), T.StructField("registered", T.IntegerType())]
    + _doubles("cnt")
)

#: Daily rentals: the hourly schema without the hour.
DAILY_SCHEMA = T.StructType([field for field in HOURLY_SCHEMA if field.name != "hr"])

#: Purchases: one row per user and product.
PURCHASES_SCHEMA = T.StructType(
    [
        T.StructField("User_ID", T.StringType()),
        T.StructField("Product_ID", T.StringType()),
        T.StructField("Gender", T.StringType()),
        T.StructField("Age", T.StringType()),
        T.StructField("Occupation", T.IntegerType()),
        T.StructField("City_Category", T.StringType()),
        T.StructField("Stay_In_Current_City_Years", T.StringType()),
        T.StructField("Marital_Status", T.StringType()),
        T.StructField("Product_Category_1", T.IntegerType()),
        T.StructField("Product_Category_2", T.IntegerType()),
        T.StructField("Product_Category_3", T.IntegerType()),
        T.StructField("Purchase", T.IntegerType()),
    ]
)


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One Parquet table; columns and filters are pruned by the caller's plan."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores before work that passes over them many times.

    A table with at least as many splits as cores is left alone; a small file
    that arrives as a few tasks is dealt out round-robin.  For plans without a
    shuffle: those are cheap to ask for their number of partitions.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    header: bool = True,
    infer: bool = False,
    strict: bool = True,
) -> DataFrame:
    """Delimited text with a declared schema.

    ``infer=True`` costs one more pass over the text and is for exploration.
    ``strict`` stops at a malformed record; otherwise its fields become null.
    """
    reader = spark.read.option("header", header).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text lines in a column named ``value``."""
    return spark.read.text(path)


def drop_header_rows(lines: DataFrame, first_field: str, *, separator: str = ",", column: str = "value") -> DataFrame:
    """Lines whose first field is not the header's first name (every part file may have one)."""
    return lines.where(F.substring_index(column, separator, 1) != first_field)


def parse_fields(
    lines: DataFrame,
    fields: Mapping[str, tuple[int, str]],
    *,
    separator: str = ",",
    strict: bool = True,
    column: str = "value",
) -> DataFrame:
    """Pick fields by position and cast them: ``{"hr": (5, "double"), ...}``.

    ``strict`` raises on a value that does not cast; otherwise it becomes null.
    The split is evaluated once per line, not once per field.
    """
    parts = lines.select(F.split(F.col(column), f"\\Q{separator}\\E", -1).alias("_parts"))

    def pick(position: int, kind: str) -> Column:
        field = F.col("_parts")[position] if strict else F.get("_parts", F.lit(position))
        return field.cast(kind) if strict else field.try_cast(kind)

    return parts.select(*[pick(*where).alias(name) for name, where in fields.items()])


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """A handful of rows typed in by hand."""
    return spark.createDataFrame(list(rows), schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind ``df`` to a named schema: reorder by name, widen types, fail on a missing column."""
    return df.to(schema)
