"""Mean, rank and bin encoders; splits and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meanline.catalog.registry import query
from meanline.functions.clean import exact
from meanline.operators import encode, split
from meanline.operators.metrics import regression_metrics
from meanline.sources.readers import read_table
from meanline.sources.views import charged, hourly_view, measures_view


_CHARGED_SQL = """cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))
    * (1 + cast(l_tax as decimal(4,2)))"""


def _mean(label: str) -> str:
    return f"cast(sum(cast({label} as decimal(18,2))) as double) / count(*)"


@query(
    "target_encode_apply",
    f"""with d as (select event_id, hour(ts) as hr, event_type as weather,
                     cast(json_extract_string(props, '$.k') as integer) as k, value from events),
          f as (select * from d where hr <> 7),
          h as (select hr, {_mean("value")} as m from f group by hr),
          w as (select weather, {_mean("value")} as m from f group by weather),
          u as (select k, {_mean("value")} as m from f group by k)
        select event_id, coalesce(h.m, 0) as hr_mean, coalesce(w.m, 0) as weather_mean, coalesce(u.m, 0) as hum_mean
        from d left join h on d.hr = h.hr left join w on d.weather = w.weather left join u on d.k = u.k""",
)
def target_encode_apply(spark: SparkSession, directory: str) -> DataFrame:
    rows = hourly_view(spark, directory)
    encoding = encode.fit_means(rows.where("hr <> 7"), ["hr", "weather", "hum"], "value")
    encoded = encoding.apply(rows, {"hr": "hr_mean", "weather": "weather_mean", "hum": "hum_mean"})
    return encoded.select(F.col("instant").alias("event_id"), "hr_mean", "weather_mean", "hum_mean")


@query(
    "target_encode_train_test",
    f"""with d as (select l_orderkey, l_linenumber, l_quantity as q, l_discount as s, l_extendedprice as y,
                     l_orderkey % 5 < 4 as train from lineitem),
          f as (select * from d where train and q <> 7),
          a as (select q, {_mean("y")} as m from f group by q), b as (select s, {_mean("y")} as m from f group by s)
        select l_orderkey, l_linenumber, train, coalesce(a.m, 0) as quantity_mean, coalesce(b.m, 0) as discount_mean
        from d left join a on d.q = a.q left join b on d.s = b.s""",
)
def target_encode_train_test(spark: SparkSession, directory: str) -> DataFrame:
    rows = measures_view(spark, directory).withColumn("train", split.is_train("l_orderkey"))
    fitted_on = rows.where(F.col("train") & (F.col("l_quantity") != 7))
    encoding = encode.fit_means(fitted_on, ["l_quantity", "l_discount"], "price")
    encoded = encoding.apply(rows, {"l_quantity": "quantity_mean", "l_discount": "discount_mean"})
    return encoded.select("l_orderkey", "l_linenumber", "train", "quantity_mean", "discount_mean")


@query(
    "target_encode_large_key",
    f"""with d as (select l_orderkey, l_linenumber, l_partkey, l_extendedprice as y, l_orderkey % 5 < 4 as train
                   from lineitem),
          a as (select l_partkey as p, {_mean("y")} as m from d where train group by 1),
          o as (select {_mean("y")} as m from d where train)
        select l_orderkey, l_linenumber, coalesce(a.m, o.m) as part_mean
        from d left join a on l_partkey = p, o where not train""",
)
def target_encode_large_key(spark: SparkSession, directory: str) -> DataFrame:
    rows = read_table(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", exact("l_extendedprice", 2).alias("price")
    )
    train, test = split.hash_split(rows, "l_orderkey")
    encoding = encode.fit_means(train, ["l_partkey"], "price")
    encoded = encoding.apply(test, {"l_partkey": "part_mean"}, unseen="mean", broadcast_rows=0)
    return encoded.select("l_orderkey", "l_linenumber", "part_mean")


@query(
    "target_encode_many_large_keys",
    f"""with d as (select l_orderkey, l_linenumber, l_partkey as p, l_suppkey as s, l_quantity as q, {_CHARGED_SQL} as y,
                     l_orderkey % 5 < 4 as train from lineitem),
          a as (select p, cast(sum(y) as double) / count(*) as m from d where train group by p),
          b as (select s, cast(sum(y) as double) / count(*) as m from d where train group by s),
          c as (select q, cast(sum(y) as double) / count(*) as m from d where train group by q)
        select l_orderkey, l_linenumber, coalesce(a.m, 0) as part_mean, coalesce(b.m, 0) as supplier_mean,
          coalesce(c.m, 0) as quantity_mean
        from d left join a on d.p = a.p left join b on d.s = b.s left join c on d.q = c.q""",
)
def target_encode_many_large_keys(spark: SparkSession, directory: str) -> DataFrame:
    """Three columns by shuffle joins; the label has six decimals."""
    rows = read_table(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", charged().alias("charged")
    )
    columns = {"l_partkey": "part_mean", "l_suppkey": "supplier_mean", "l_quantity": "quantity_mean"}
    encoding = encode.fit_means(rows.where(split.is_train("l_orderkey")), list(columns), "charged")
    encoded = encoding.apply(rows, columns, broadcast_rows=0)
    return encoded.select("l_orderkey", "l_linenumber", *columns.values())


_HOUR_RANKS = f"""e as (select hour(ts) as hr, {_mean("value")} as m from events where hour(ts) <> 7 group by 1),
    r as (select hr, cast(row_number() over (order by m, hr) - 1 as double) as code from e)"""


@query(
    "rank_encode_fit",
    f"with {_HOUR_RANKS} select hr, code from r",
)
def rank_encode_fit(spark: SparkSession, directory: str) -> DataFrame:
    rows = hourly_view(spark, directory).where("hr <> 7")
    table = encode.fit_ranks(rows, ["hr"], "value").table
    return table.select(F.col("int_key").alias("hr"), "code")


@query(
    "rank_encode_apply",
    f"""with {_HOUR_RANKS} select event_id, coalesce(code, 0) as hr_rank
        from events left join r on hour(ts) = r.hr""",
)
def rank_encode_apply(spark: SparkSession, directory: str) -> DataFrame:
    rows = hourly_view(spark, directory)
    encoding = encode.fit_ranks(rows.where("hr <> 7"), ["hr"], "value")
    return encoding.apply(rows, {"hr": "hr_rank"}).select(F.col("instant").alias("event_id"), "hr_rank")


@query(
    "rank_encode_default",
    f"""with e as (select event_type as w, {_mean("value")} as m from events where event_type <> 'signup' group by 1),
          r as (select w, row_number() over (order by m, w) - 1 as code from e)
        select event_id, cast(least(coalesce(code, 3), 3) as double) as weather_slot
        from events left join r on event_type = w""",
)
def rank_encode_default(spark: SparkSession, directory: str) -> DataFrame:
    rows = hourly_view(spark, directory)
    encoding = encode.fit_ranks(rows.where("weather <> 'signup'"), ["weather"], "value")
    encoded = encoding.apply(rows, {"weather": "weather_slot"}, unseen=3.0)
    slot = F.least("weather_slot", F.lit(3.0)).alias("weather_slot")
    return encoded.select(F.col("instant").alias("event_id"), slot)


@query(
    "rank_bins",
    f"""with e as (select l_quantity as q, {_mean("l_extendedprice")} as m from lineitem group by 1)
        select q, cast(greatest(1, floor((row_number() over (order by m, q) - 1) / 2)) as double) as bin
        from e""",
)
def rank_bins(spark: SparkSession, directory: str) -> DataFrame:
    table = encode.fit_rank_bins(measures_view(spark, directory), ["l_quantity"], "price").table
    return table.select(F.col("num_key").alias("q"), F.col("code").alias("bin"))


@query(
    "random_split",
    "select count(*) as n_rows, count(*) as n_keys, cast(0 as bigint) as n_in_both, true as about_80_percent from orders",
)
def random_split(spark: SparkSession, directory: str) -> DataFrame:
    """Every row falls into exactly one part, about four fifths into the first."""
    orders = read_table(spark, directory, "orders").select("o_orderkey")
    train, test = split.random_split(orders, [0.8, 0.2], 7000)
    parts = train.select("o_orderkey", F.lit(1).alias("train")).unionByName(
        test.select("o_orderkey", F.lit(0).alias("train"))
    )
    per_key = parts.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.avg("train").alias("train"))
    return per_key.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(~F.col("train").isin(0.0, 1.0)).alias("n_in_both"),
        F.avg("train").between(0.75, 0.85).alias("about_80_percent"),
    )


@query("hash_split", "select o_orderkey, o_orderkey % 5 < 4 as train from orders")
def hash_split(spark: SparkSession, directory: str) -> DataFrame:
    orders = read_table(spark, directory, "orders").select("o_orderkey")
    train, test = split.hash_split(orders, "o_orderkey")
    return train.withColumn("train", F.lit(True)).unionByName(test.withColumn("train", F.lit(False)))


@query(
    "hash_split_seeded",
    "select count(*) as n_rows, true as about_80_percent, cast(0 as bigint) as n_moved from orders",
)
def hash_split_seeded(spark: SparkSession, directory: str) -> DataFrame:
    """A seeded split by key, and how many keys change sides when the rows are dealt out anew."""
    orders = read_table(spark, directory, "orders").select("o_orderkey")
    side = split.is_train("o_orderkey", 0.8, 7000).cast("int")
    both = orders.select("o_orderkey", side.alias("train")).unionByName(
        orders.repartition(7).select("o_orderkey", side.alias("train"))
    )
    per_key = both.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("train").alias("low"), F.max("train").alias("high")
    )
    return per_key.agg(
        (F.sum("n") / 2).cast("bigint").alias("n_rows"),
        F.avg("low").between(0.75, 0.85).alias("about_80_percent"),
        F.count_if(F.col("low") != F.col("high")).alias("n_moved"),
    )


@query("kfold_assign", "select o_orderkey, cast(o_orderkey % 10 as integer) as fold from orders")
def kfold_assign(spark: SparkSession, directory: str) -> DataFrame:
    return split.with_fold(read_table(spark, directory, "orders").select("o_orderkey"), "o_orderkey", 10)


@query(
    "kfold_cv_mean_model",
    """with d as (select l_orderkey % 3 as fold, l_quantity as q, cast(l_extendedprice as decimal(18,2)) as y
                  from lineitem),
          k as (select fold, q, sum(y) as s, count(*) as n from d group by fold, q),
          t as (select q, sum(y) as s, count(*) as n from d group by q),
          p as (select d.fold, cast(d.y as double) as y, cast(t.s - k.s as double) / (t.n - k.n) as p
                from d join k on d.fold = k.fold and d.q = k.q join t on d.q = t.q)
        select cast(fold as integer) as fold, count(*) as n, round(sqrt(avg((y - p) * (y - p))), 3) as rmse,
               round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 9) as r2
        from p group by fold""",
)
def kfold_cv_mean_model(spark: SparkSession, directory: str) -> DataFrame:
    rows = split.with_fold(measures_view(spark, directory), "l_orderkey", 3)
    predicted = encode.held_out_means(rows, "l_quantity", "price", "fold", "prediction")
    scored = predicted.select("fold", F.col("price").cast("double").alias("label"), "prediction")
    metrics = regression_metrics(scored, by=["fold"])
    return metrics.select("fold", "n", F.round("rmse", 3).alias("rmse"), F.round("r2", 9).alias("r2"))


@query(
    "rmse_r2_eval",
    f"""with d as (select l_quantity as q, l_extendedprice as y, l_orderkey % 5 < 4 as train from lineitem),
          e as (select q, {_mean("y")} as p from d where train group by q),
          s as (select y, coalesce(p, 0) as p from d left join e on d.q = e.q where not train)
        select count(*) as n, round(sqrt(avg((y - p) * (y - p))), 3) as rmse,
               round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 9) as r2 from s""",
)
def rmse_r2_eval(spark: SparkSession, directory: str) -> DataFrame:
    train, test = split.hash_split(measures_view(spark, directory), "l_orderkey")
    scored = encode.fit_means(train, ["l_quantity"], "price").apply(test, {"l_quantity": "prediction"})
    metrics = regression_metrics(scored.select(F.col("price").cast("double").alias("label"), "prediction"))
    return metrics.select("n", F.round("rmse", 3).alias("rmse"), F.round("r2", 9).alias("r2"))
