"""Input views over the given tables, shaped like the rental and purchase tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meanline.functions.calendar import calendar_columns, weekday
from meanline.functions.clean import exact
from meanline.functions.fixed_values import FELT_TEMPERATURE_RANK, WIND_BIN
from meanline.sources.readers import read_table

#: Age bands, dealt to customers by key.
AGES = ("0-17", "18-25", "26-35", "36-45", "46-50", "51-55", "55+")

#: First calendar year of the order tables.
BASE_YEAR = 1995

#: The twelve features of an hourly row, in order.
TRIP_FEATURES = (
    "season", "yr", "mnth", "hr", "holiday", "weekday", "workingday", "weathersit",
    "temp", "atemp", "hum", "windspeed",
)


def hourly_view(spark: SparkSession, directory: str) -> DataFrame:
    """`events` as hourly readings: instant, hr, weekday, workingday, weather, hum, value."""
    events = read_table(spark, directory, "events")
    ts = F.col("ts")
    return events.select(
        F.col("event_id").alias("instant"),
        "ts",
        F.hour(ts).alias("hr"),
        weekday(ts).alias("weekday"),
        weekday(ts).between(1, 5).cast("int").alias("workingday"),
        F.col("event_type").alias("weather"),
        (F.get_json_object("props", "$.k").cast("int") / F.lit(100.0)).alias("hum"),
        exact("value", 2).alias("value"),
    )


def monthly_view(spark: SparkSession, directory: str) -> DataFrame:
    """`orders` with year and month."""
    date = F.col("o_orderdate")
    return read_table(spark, directory, "orders").select(
        "o_orderkey", F.year(date).alias("yr"), F.month(date).alias("mnth"), "o_orderpriority", "o_orderstatus",
        exact("o_totalprice", 2).alias("total"), "o_orderdate",
    )


def measures_view(spark: SparkSession, directory: str) -> DataFrame:
    """`lineitem` as keyed readings with the price as label."""
    return read_table(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag",
        exact("l_extendedprice", 2).alias("price"),
    )


def charged() -> Column:
    """The charged price of an order line, exact: a decimal with six places."""
    price, discount, tax = (
        F.col(c).cast(kind) for c, kind in
        (("l_extendedprice", "decimal(12,2)"), ("l_discount", "decimal(4,2)"), ("l_tax", "decimal(4,2)"))
    )
    return (price * (1 - discount) * (1 + tax)).cast("decimal(20,6)")


def _listed(table: Mapping[float, float], step: Column) -> Column:
    """The value at a place in the ascending list of a fixed table's values; places beyond it take the last."""
    readings = sorted(table)
    place = F.least(F.greatest(step, F.lit(0)), F.lit(len(readings) - 1)).cast("int")
    return F.array(*map(F.lit, readings))[place]


def trips_view(spark: SparkSession, directory: str) -> DataFrame:
    """`lineitem` with the hourly table's twelve features and a label that depends on them.

    Shipping dates give the calendar, the line number the slot of the day, flags
    the weather, quantity, price, discount and tax the four readings, which are
    values that the fixed tables list; the count is the charged price in thousands.
    """
    lines = read_table(spark, directory, "lineitem")
    price = F.col("l_extendedprice")
    weather = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    charged = price * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) / 1000.0
    season, yr, mnth, _, holiday, day, working = calendar_columns(F.col("l_shipdate"), BASE_YEAR)
    return lines.select(
        F.col("l_orderkey").alias("key"),
        F.col("l_shipdate").alias("dteday"),
        season, yr, mnth, F.col("l_linenumber").alias("hr"), holiday, day, working,
        weather.alias("weathersit"),
        F.round(F.col("l_quantity") / 50, 2).alias("temp"),
        _listed(FELT_TEMPERATURE_RANK, F.floor(price / 1600)).alias("atemp"),
        F.round(F.col("l_discount") * 10, 2).alias("hum"),
        _listed(WIND_BIN, F.round(F.col("l_tax") * 100)).alias("windspeed"),
        charged.alias("cnt"),
    )


def purchases_view(spark: SparkSession, directory: str) -> DataFrame:
    """Order lines with their order's customer, shaped like the purchase table.

    Both sides are partitioned on the order key once.
    """
    orders = read_table(spark, directory, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )
    lines = read_table(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice"
    )
    ages = F.array(*[F.lit(age) for age in AGES])
    stay = F.when(F.col("l_linenumber") >= 4, "4+").otherwise(F.col("l_linenumber").cast("string"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("User_ID"),
        F.col("l_orderkey").alias("Order_ID"),
        F.col("l_linenumber").alias("Line_ID"),
        F.col("o_orderstatus").alias("Gender"),
        ages[F.pmod("o_custkey", F.lit(len(AGES))).cast("int")].alias("Age"),
        F.col("l_linenumber").alias("Occupation"),
        F.translate("l_returnflag", "NR", "CB").alias("City_Category"),
        stay.alias("Stay_In_Current_City_Years"),
        F.when(F.col("l_linestatus") == "F", "0").otherwise("1").alias("Marital_Status"),
        F.col("l_linenumber").cast("string").alias("Product_Category_1"),
        F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_linenumber").cast("string"))
        .alias("Product_Category_2"),
        F.when(F.col("l_linestatus") == "O", "").otherwise("7").alias("Product_Category_3"),
        F.col("l_extendedprice").alias("Purchase"),
    )
