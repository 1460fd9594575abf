"""Global ranks and rank bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meanline.catalog.registry import query
from meanline.operators import order
from meanline.sources.readers import read_table

_RANKED = """with r as (select row_number() over (order by o_totalprice, o_orderkey) as rnk, o_orderkey, o_totalprice
    from orders), n as (select count(*) as c from orders)"""


def _orders(spark: SparkSession, directory: str) -> DataFrame:
    return read_table(spark, directory, "orders").select("o_orderkey", "o_totalprice")


@query(
    "global_rank",
    "select row_number() over (order by value, event_id) as rnk, event_id, value from events",
)
def global_rank(spark: SparkSession, directory: str) -> DataFrame:
    events = read_table(spark, directory, "events").select("event_id", "value")
    return order.global_rank(events, ["value", "event_id"])


@query("rank_band_first", f"{_RANKED} select rnk, o_orderkey, o_totalprice from r where rnk <= 100")
def rank_band_first(spark: SparkSession, directory: str) -> DataFrame:
    return order.rank_first(_orders(spark, directory), ["o_totalprice", "o_orderkey"], 100)


@query(
    "rank_band_middle",
    f"""{_RANKED} select rnk, o_orderkey, o_totalprice from r, n
        where rnk between c // 2 - 49 and c // 2 + 50""",
)
def rank_band_middle(spark: SparkSession, directory: str) -> DataFrame:
    return order.rank_middle(_orders(spark, directory), ["o_totalprice", "o_orderkey"], 100)


@query("rank_band_last", f"{_RANKED} select rnk, o_orderkey, o_totalprice from r, n where rnk >= c - 99")
def rank_band_last(spark: SparkSession, directory: str) -> DataFrame:
    return order.rank_last(_orders(spark, directory), ["o_totalprice", "o_orderkey"], 100)


_TIED = "l_returnflag, l_quantity, l_orderkey, l_linenumber, l_extendedprice"


@query(
    "rank_band_middle_ties",
    f"""with r as (select row_number() over (order by {_TIED}) as rnk, {_TIED} from lineitem),
          n as (select count(*) as c from lineitem)
        select r.* from r, n where rnk between c // 2 - 49 and c // 2 + 50""",
)
def rank_band_middle_ties(spark: SparkSession, directory: str) -> DataFrame:
    columns = _TIED.split(", ")
    return order.rank_middle(read_table(spark, directory, "lineitem").select(*columns), columns, 100)


@query(
    "rank_band_middle_odd",
    f"""{_RANKED} select rnk, o_orderkey, o_totalprice from r, n
        where rnk between c // 2 - 48 and c // 2 + 50""",
)
def rank_band_middle_odd(spark: SparkSession, directory: str) -> DataFrame:
    return order.rank_middle(_orders(spark, directory), ["o_totalprice", "o_orderkey"], 99)


@query(
    "rank_band_middle_dates",
    """with r as (select row_number() over (order by o_orderdate, o_orderkey) as rnk, o_orderkey, o_orderdate from orders),
          n as (select count(*) as c from orders)
        select rnk, o_orderkey, cast(o_orderdate as date) as day from r, n where rnk between c // 2 - 49 and c // 2 + 50""",
)
def rank_band_middle_dates(spark: SparkSession, directory: str) -> DataFrame:
    orders = read_table(spark, directory, "orders").select("o_orderkey", "o_orderdate")
    band = order.rank_middle(orders, ["o_orderdate", "o_orderkey"], 100)
    return band.select("rnk", "o_orderkey", F.to_date("o_orderdate").alias("day"))
