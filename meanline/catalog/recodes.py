"""Rule and fixed-table recodes, calendar columns and scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meanline.catalog.registry import query, values
from meanline.functions import calendar, fixed_values, recode
from meanline.operators.totals import max_scale
from meanline.sources.readers import read_table
from meanline.sources.views import hourly_view, monthly_view, purchases_view

_AGE_SQL = "case o_custkey % 7 when 6 then 6 when 5 then 5 else o_custkey % 7 + 1 end"


@query(
    "recode_purchases",
    f"""select o_custkey as user_id, l_orderkey, l_linenumber,
          cast(case when o_orderstatus = 'F' then 1 else 2 end as double) as gender,
          cast({_AGE_SQL} as double) as age,
          cast(case l_returnflag when 'A' then 1 when 'R' then 2 else 3 end as double) as city,
          cast(least(l_linenumber, 4) + 1 as double) as years,
          cast(case when l_linestatus = 'F' then 1 else 2 end as double) as marital
        from lineitem join orders on l_orderkey = o_orderkey""",
)
def recode_purchases(spark: SparkSession, directory: str) -> DataFrame:
    return purchases_view(spark, directory).select(
        F.col("User_ID").alias("user_id"),
        F.col("Order_ID").alias("l_orderkey"),
        F.col("Line_ID").alias("l_linenumber"),
        recode.gender_code("Gender").alias("gender"),
        recode.age_code("Age").alias("age"),
        recode.city_code("City_Category").alias("city"),
        recode.topcoded_years("Stay_In_Current_City_Years").alias("years"),
        recode.marital_code("Marital_Status").alias("marital"),
    )


@query(
    "recode_topcoded",
    """select l_orderkey, l_linenumber,
          case when l_linenumber >= 4 then cast(5 as double) else l_linenumber + cast(1 as double) end as years
        from lineitem""",
)
def recode_topcoded(spark: SparkSession, directory: str) -> DataFrame:
    stay = F.when(F.col("l_linenumber") >= 4, "4+").otherwise(F.col("l_linenumber").cast("string"))
    return read_table(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", recode.topcoded_years(stay).alias("years")
    )


@query(
    "recode_shift",
    "select l_orderkey, l_linenumber, cast(l_linenumber - 1 as double) as code from lineitem",
)
def recode_shift(spark: SparkSession, directory: str) -> DataFrame:
    return read_table(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", recode.shift_code("l_linenumber").alias("code")
    )


def _table_sql(table: dict, key: str, source: str, keep: str) -> str:
    rows = values((float(k), float(v)) for k, v in table.items())
    return f"""with t(k, code) as (values {rows}), d as (select {keep}, {key} as v from {source})
        select {keep}, v, code from d left join t on v = k"""


@query("recode_fixed_table", _table_sql(fixed_values.HOUR_RANK, "cast(hour(ts) as double)", "events", "event_id"))
def recode_hour(spark: SparkSession, directory: str) -> DataFrame:
    rows = hourly_view(spark, directory).select(F.col("instant").alias("event_id"), F.col("hr").cast("double").alias("v"))
    return recode.recode_fixed(rows, "v", fixed_values.HOUR_RANK, "code")


def _month_rows(spark: SparkSession, directory: str) -> DataFrame:
    return monthly_view(spark, directory).select("o_orderkey", F.col("mnth").cast("double").alias("v"))


_MONTH_KEY = "cast(month(o_orderdate) as double)"


@query("recode_month_rank", _table_sql(fixed_values.MONTH_RANK, _MONTH_KEY, "orders", "o_orderkey"))
def recode_month(spark: SparkSession, directory: str) -> DataFrame:
    return recode.recode_fixed(_month_rows(spark, directory), "v", fixed_values.MONTH_RANK, "code")


@query(
    "recode_month_rank_fractional",
    _table_sql(fixed_values.MONTH_RANK_FRACTIONAL, _MONTH_KEY, "orders", "o_orderkey"),
)
def recode_month_fractional(spark: SparkSession, directory: str) -> DataFrame:
    return recode.recode_fixed(_month_rows(spark, directory), "v", fixed_values.MONTH_RANK_FRACTIONAL, "code")


@query(
    "recode_temperature_rank",
    _table_sql(fixed_values.TEMPERATURE_RANK, "round(l_quantity / 50, 2)", "lineitem", "l_orderkey, l_linenumber"),
)
def recode_temperature(spark: SparkSession, directory: str) -> DataFrame:
    rows = read_table(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_quantity") / 50, 2).alias("v")
    )
    return recode.recode_fixed(rows, "v", fixed_values.TEMPERATURE_RANK, "code")


@query(
    "recode_felt_temperature_rank",
    _table_sql(fixed_values.FELT_TEMPERATURE_RANK, "round(p_size / 66.0::double, 4)", "part", "p_partkey"),
)
def recode_felt_temperature(spark: SparkSession, directory: str) -> DataFrame:
    rows = read_table(spark, directory, "part").select(
        "p_partkey", F.round(F.col("p_size") / F.lit(66.0), 4).alias("v")
    )
    return recode.recode_fixed(rows, "v", fixed_values.FELT_TEMPERATURE_RANK, "code", on_unknown="null")


@query(
    "recode_humidity_rank",
    _table_sql(
        fixed_values.HUMIDITY_RANK, "cast(json_extract_string(props, '$.k') as integer) / 100.0::double", "events",
        "event_id",
    ),
)
def recode_humidity(spark: SparkSession, directory: str) -> DataFrame:
    rows = hourly_view(spark, directory).select(F.col("instant").alias("event_id"), F.col("hum").alias("v"))
    return recode.recode_fixed(rows, "v", fixed_values.HUMIDITY_RANK, "code", on_unknown="null")


@query(
    "recode_wind_bin",
    f"""with t(k, code) as (values {values(fixed_values.WIND_BIN.items())}),
        d as (select p_partkey, round(p_size / 67.0::double, 4) as v from part)
        select p_partkey, v, coalesce(code, cast(0 as double)) as code from d left join t on v = k""",
)
def recode_wind(spark: SparkSession, directory: str) -> DataFrame:
    rows = read_table(spark, directory, "part").select(
        "p_partkey", F.round(F.col("p_size") / F.lit(67.0), 4).alias("v")
    )
    return recode.recode_fixed(rows, "v", fixed_values.WIND_BIN, "code", on_unknown="default")


@query(
    "calendar_features",
    f"""with d as (select o_orderkey, o_orderdate as d, month(o_orderdate) * 100 + day(o_orderdate) as md from orders)
        select o_orderkey,
          case when md >= 1221 or md < 321 then 1 when md < 621 then 2 when md < 923 then 3 else 4 end as season,
          cast(year(d) - 1995 as integer) as yr, cast(month(d) as integer) as mnth, cast(hour(d) as integer) as hr,
          cast(md in {calendar.FIXED_HOLIDAYS} as integer) as holiday,
          cast(dayofweek(d) as integer) as weekday,
          cast(dayofweek(d) between 1 and 5 and md not in {calendar.FIXED_HOLIDAYS} as integer) as workingday
        from d""",
)
def calendar_features(spark: SparkSession, directory: str) -> DataFrame:
    orders = read_table(spark, directory, "orders")
    return orders.select("o_orderkey", *calendar.calendar_columns(F.col("o_orderdate"), 1995))


@query(
    "max_scale",
    """select l_orderkey, l_linenumber, l_quantity / 41 as fixed_scale,
          l_quantity / (select max(l_quantity) from lineitem) as own_scale from lineitem""",
)
def max_scales(spark: SparkSession, directory: str) -> DataFrame:
    lines = read_table(spark, directory, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    scaled = max_scale(lines, "l_quantity", "fixed_scale", fixed_values.SCALE_MAX["temp"])
    return max_scale(scaled, "l_quantity", "own_scale").drop("l_quantity")
