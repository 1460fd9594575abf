"""Per-user totals, daily roll-ups, customer segments and anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meanline.catalog.registry import query
from meanline.operators import neighbours, segments, totals
from meanline.sources.readers import read_table
from meanline.sources.views import charged, hourly_view


@query(
    "sum_per_user",
    """select o_custkey as user_id, sum(cast(l_extendedprice as decimal(18,2))) as total,
          min(o_orderstatus) as gender, min(coalesce(nullif(l_returnflag, 'N'), '0')) as city,
          min(l_linestatus) as marital
        from lineitem join orders on l_orderkey = o_orderkey group by o_custkey""",
)
def sum_per_user(spark: SparkSession, directory: str) -> DataFrame:
    lines = read_table(spark, directory, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_extendedprice").alias("amount"),
        F.coalesce(F.nullif("l_returnflag", F.lit("N")), F.lit("0")).alias("city"),
        F.col("l_linestatus").alias("marital"),
    )
    # per order first: the same exchange serves the join, and a large order is one row by then
    per_order = totals.sum_per_user(lines, "o_orderkey", "amount", ["city", "marital"], scale=2)
    orders = read_table(spark, directory, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("gender")
    )
    joined = per_order.join(orders, "o_orderkey")
    return totals.sum_per_user(joined, "user_id", "total", ["gender", "city", "marital"])


@query(
    "charged_per_order",
    """select l_orderkey as order_id, sum(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))
          * (1 + cast(l_tax as decimal(4,2)))) as total, min(l_returnflag) as flag from lineitem group by 1""",
)
def charged_per_order(spark: SparkSession, directory: str) -> DataFrame:
    """Totals of an amount with six decimals."""
    lines = read_table(spark, directory, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), charged().alias("amount"), F.col("l_returnflag").alias("flag")
    )
    return totals.sum_per_user(lines, "order_id", "amount", ["flag"])


@query(
    "daily_rollup",
    """select cast(ts as date) as day, count(*) as n, sum(cast(value as decimal(18,2))) as total,
          cast(sum(cast(value as decimal(18,2))) as double) / count(*) as mean_value
        from events group by 1""",
)
def daily_rollup(spark: SparkSession, directory: str) -> DataFrame:
    return totals.daily_rollup(read_table(spark, directory, "events"), "ts", "value", scale=2)


@query(
    "sum_check",
    """with d as (select l_shipdate, count(*) filter (where l_linestatus = 'F') as casual,
                    count(*) filter (where l_linestatus = 'O' and l_returnflag <> 'R') as registered, count(*) as cnt
                  from lineitem group by 1)
        select count(*) as n_rows, count(*) filter (where casual + registered <> cnt) as n_bad from d""",
)
def sum_check(spark: SparkSession, directory: str) -> DataFrame:
    daily = read_table(spark, directory, "lineitem").groupBy("l_shipdate").agg(
        F.count_if(F.col("l_linestatus") == "F").alias("casual"),
        F.count_if((F.col("l_linestatus") == "O") & (F.col("l_returnflag") != "R")).alias("registered"),
        F.count(F.lit(1)).alias("cnt"),
    )
    return totals.sum_check(daily, ["casual", "registered"], "cnt")


@query(
    "rfm_segments",
    """with c as (select o_custkey, datediff('day', cast(max(o_orderdate) as date), date '2001-08-02') as recency,
              count(*) as frequency, sum(cast(o_totalprice as decimal(18,2))) as monetary
            from orders group by o_custkey),
          t as (select *, ntile(5) over (order by recency, o_custkey) as r_tile,
              ntile(5) over (order by frequency, o_custkey) as f_tile,
              ntile(5) over (order by monetary, o_custkey) as m_tile from c)
        select o_custkey, cast(recency as integer) as recency, frequency, monetary, cast(r_tile as integer) as r_tile,
          cast(f_tile as integer) as f_tile, cast(m_tile as integer) as m_tile,
          r_tile || '-' || f_tile || '-' || m_tile as segment from t""",
)
def rfm_segments(spark: SparkSession, directory: str) -> DataFrame:
    orders = read_table(spark, directory, "orders")
    return segments.rfm_segments(orders, "o_custkey", "o_orderdate", "o_totalprice", "2001-08-02", scale=2)


@query(
    "count_anomalies",
    """with g as (select cast(ts as date) as day, hour(ts) as hr, count(*) as n from events group by 1, 2),
          c as (select cast(unnest(generate_series((select min(day) from g)::timestamp, (select max(day) from g)::timestamp, interval 1 day)) as date) as day),
          h as (select c.day, k.hr, coalesce(g.n, 0) as n from c, (select cast(unnest(range(24)) as bigint) as hr) k
                left join g on g.day = c.day and g.hr = k.hr),
          z as (select day, hr, n, (n - avg(n) over (partition by hr)) / stddev_samp(n) over (partition by hr) as z
                from h)
        select day, hr, n, round(z, 6) as z from z where abs(z) > 2.5""",
)
def count_anomalies(spark: SparkSession, directory: str) -> DataFrame:
    found = segments.count_anomalies(hourly_view(spark, directory), "ts")
    return found.withColumn("z", F.round("z", 6))


@query(
    "knn_topk",
    """with e as (select vec_id, label, unnest(embedding) as x, generate_subscripts(embedding, 1) as slot
                  from embeddings),
          c as (select label, slot, avg(cast(x as double)) as m from e group by label, slot),
          d as (select c.label, e.vec_id, sqrt(sum((e.x - c.m) * (e.x - c.m))) as distance
                from e join c on e.slot = c.slot group by c.label, e.vec_id),
          r as (select *, row_number() over (partition by label order by distance, vec_id) as rank from d)
        select cast(label as bigint) as query_id, cast(rank as integer) as rank, vec_id as row_id,
               round(distance, 6) as distance from r where rank <= 10""",
)
def knn_topk(spark: SparkSession, directory: str) -> DataFrame:
    """The ten rows nearest to the centre of each label."""
    rows = read_table(spark, directory, "embeddings")
    found = neighbours.nearest(rows, "vec_id", "embedding", neighbours.centres(rows, "embedding", "label"), 10)
    return found.withColumn("distance", F.round("distance", 6))
