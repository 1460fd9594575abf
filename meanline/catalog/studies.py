"""Column studies and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meanline.catalog.registry import query, values
from meanline.functions import calendar
from meanline.functions.fixed_values import MONTH_DAYS
from meanline.operators import study
from meanline.sources.readers import read_table
from meanline.sources.storage import shared_table
from meanline.sources.views import charged, hourly_view, measures_view, monthly_view


def _study_sql(key: str, label: str, table: str, order: str = "mean_label, key") -> str:
    return f"""select * from (
        select {key} as key, cast(sum(cast({label} as decimal(18,2))) as double) / count(*) as mean_label,
               count(*) as n from {table} group by 1) s order by {order}"""


@query("mean_by_key", _study_sql("hour(ts)", "value", "events", "key"))
def mean_by_key(spark: SparkSession, directory: str) -> DataFrame:
    return study.mean_by_key(hourly_view(spark, directory), "hr", "value")


@query("study_by_mean", _study_sql("hour(ts)", "value", "events"))
def study_by_mean(spark: SparkSession, directory: str) -> DataFrame:
    return study.study_by_mean(hourly_view(spark, directory), "hr", "value")


_CHARGED_SQL = """cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))
    * (1 + cast(l_tax as decimal(4,2)))"""


@query(
    "study_charged",
    f"""select l_quantity as key, cast(sum({_CHARGED_SQL}) as double) / count(*) as mean_label, count(*) as n
        from lineitem group by 1""",
)
def study_charged(spark: SparkSession, directory: str) -> DataFrame:
    """A label with six decimals, by mean."""
    rows = read_table(spark, directory, "lineitem").select("l_quantity", charged().alias("charged"))
    return study.study_by_mean(rows, "l_quantity", "charged")


@query("study_by_key", _study_sql("l_quantity", "l_extendedprice", "lineitem", "key"))
def study_by_key(spark: SparkSession, directory: str) -> DataFrame:
    return study.study_by_key(measures_view(spark, directory), "l_quantity", "price")


@query("study_month", _study_sql("month(o_orderdate)", "o_totalprice", "orders"))
def study_month(spark: SparkSession, directory: str) -> DataFrame:
    return study.study_by_mean(monthly_view(spark, directory), "mnth", "total")


@query("study_year", _study_sql("year(o_orderdate)", "o_totalprice", "orders"))
def study_year(spark: SparkSession, directory: str) -> DataFrame:
    return study.study_by_mean(monthly_view(spark, directory), "yr", "total")


_SEASON_SQL = """case when month({0}) * 100 + day({0}) >= 1221 or month({0}) * 100 + day({0}) < 321 then 1
    when month({0}) * 100 + day({0}) < 621 then 2 when month({0}) * 100 + day({0}) < 923 then 3 else 4 end"""


@query("study_season", _study_sql(_SEASON_SQL.format("o_orderdate"), "o_totalprice", "orders"))
def study_season(spark: SparkSession, directory: str) -> DataFrame:
    rows = monthly_view(spark, directory)
    return study.study_by_mean(rows, calendar.season(F.col("o_orderdate")), "total")


@query("study_working_day", _study_sql("cast(dayofweek(ts) between 1 and 5 as integer)", "value", "events"))
def study_working_day(spark: SparkSession, directory: str) -> DataFrame:
    return study.study_by_mean(hourly_view(spark, directory), "workingday", "value")


@query("study_weather", _study_sql("event_type", "value", "events"))
def study_weather(spark: SparkSession, directory: str) -> DataFrame:
    return study.study_by_mean(hourly_view(spark, directory), "weather", "value")


@query("study_humidity", _study_sql("cast(json_extract_string(props, '$.k') as integer) / 100.0::double", "value", "events"))
def study_humidity(spark: SparkSession, directory: str) -> DataFrame:
    return study.study_by_mean(hourly_view(spark, directory), "hum", "value")


@query("study_temperature", _study_sql("l_quantity", "l_extendedprice", "lineitem"))
def study_temperature(spark: SparkSession, directory: str) -> DataFrame:
    return study.study_by_mean(measures_view(spark, directory), "l_quantity", "price")


@query("study_felt_temperature", _study_sql("l_discount", "l_extendedprice", "lineitem"))
def study_felt_temperature(spark: SparkSession, directory: str) -> DataFrame:
    return study.study_by_mean(measures_view(spark, directory), "l_discount", "price")


@query("study_wind", _study_sql("l_tax", "l_extendedprice", "lineitem", "key"))
def study_wind(spark: SparkSession, directory: str) -> DataFrame:
    return study.study_by_key(measures_view(spark, directory), "l_tax", "price")


@query(
    "multi_column_study",
    " union all ".join(
        f"""select '{name}' as feature, {number} as num_key, {whole} as int_key, {text} as text_key, count(*) as n,
            cast(sum(cast(l_extendedprice as decimal(18,2))) as double) / count(*) as mean_label
            from lineitem group by {name}"""
        for name, number, whole, text in [
            ("l_quantity", "l_quantity", "null", "null"),
            ("l_discount", "l_discount", "null", "null"),
            ("l_linenumber", "null", "cast(l_linenumber as bigint)", "null"),
            ("l_returnflag", "null", "null", "l_returnflag"),
        ]
    ),
)
def multi_column_study(spark: SparkSession, directory: str) -> DataFrame:
    columns = ["l_quantity", "l_discount", "l_linenumber", "l_returnflag"]
    return study.multi_column_study(measures_view(spark, directory), columns, "price").drop("sum_label")


@query(
    "month_mean_per_day",
    f"""with days(m, d) as (values {values((m, float(d)) for m, d in MONTH_DAYS.items())}),
        o as (select month(o_orderdate) as mnth, cast(o_totalprice as decimal(18,2)) as y,
                     cast(o_orderdate as date) as day from orders)
        select mnth, count(*) as n, count(distinct day) as n_days,
               cast(sum(y) as double) / (count(*) * any_value(d)) as per_row_day,
               cast(sum(y) as double) / count(distinct day) as per_day
        from o join days on m = mnth group by mnth""",
)
def month_mean_per_day(spark: SparkSession, directory: str) -> DataFrame:
    return study.month_mean_per_day(monthly_view(spark, directory), "o_orderdate", "total")


@query(
    "summary_profile",
    " union all ".join(
        f"""select '{c}' as feature, count({c}) as n, round(avg({c}), 6) as mean,
            round(stddev_samp({c}), 6) as stddev, min({c}) as min, round(quantile_cont({c}, 0.25), 6) as p25,
            round(quantile_cont({c}, 0.5), 6) as p50, round(quantile_cont({c}, 0.75), 6) as p75, max({c}) as max
            from lineitem"""
        for c in ("l_quantity", "l_discount", "l_tax")
    )
    + """ union all select 'l_extendedprice' as feature, count(l_extendedprice) as n,
            round(avg(l_extendedprice), 6) as mean,
            round(stddev_samp(l_extendedprice), 6) as stddev, min(l_extendedprice) as min,
            round(quantile_cont(l_extendedprice, 0.25), 6) as p25,
            round(quantile_cont(l_extendedprice, 0.5), 6) as p50,
            round(quantile_cont(l_extendedprice, 0.75), 6) as p75, max(l_extendedprice) as max from lineitem""",
)
def summary_profile(spark: SparkSession, directory: str) -> DataFrame:
    columns = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    profile = study.summary_profile(read_table(spark, directory, "lineitem"), columns)
    rounded = [F.round(c, 6).alias(c) for c in ("mean", "stddev", "p25", "p50", "p75")]
    return profile.select("feature", "n", "min", "max", *rounded)


_PROFILED = ("l_quantity", "l_discount", "l_tax", "l_extendedprice")


@query(
    "summary_profile_sketched",
    " union all ".join(
        f"""select '{c}' as feature, count({c}) as n, count(distinct l_shipdate) as n_periods, round(avg({c}), 6) as mean,
            cast(min({c}) as double) as min, cast(max({c}) as double) as max, cast(3 as bigint) as n_quantiles,
            true as within_bound from lineitem"""
        for c in _PROFILED
    ),
)
def summary_profile_sketched(spark: SparkSession, directory: str) -> DataFrame:
    """Profiles merged from sketches of every day; the exact ranks of their quantiles are within the sketches' bound."""
    lines = read_table(spark, directory, "lineitem")
    daily = shared_table(study.sketched_by(lines, _PROFILED, {"day": F.col("l_shipdate")}), "daily-sketches")
    profile = shared_table(study.merged_profile(daily), "profile")
    errors = study.rank_errors(lines, profile).groupBy("feature").agg(
        F.count("value").alias("n_quantiles"), (F.max("error") <= study.RANK_ERROR).alias("within_bound")
    )
    return profile.join(errors, "feature").select(
        "feature", "n", "n_periods", F.round("mean", 6).alias("mean"), "min", "max", "n_quantiles", "within_bound"
    )
