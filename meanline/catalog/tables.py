"""Scans, projections, filters, cleaning and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meanline.catalog.registry import query, values
from meanline.functions.clean import drop_constant_columns, fill_empty, null_nan_profile
from meanline.functions.fixed_values import TOY_ROWS
from meanline.operators import project
from meanline.sources import readers, sinks
from meanline.sources.readers import read_table
from meanline.sources.storage import new_path
from meanline.sources.views import monthly_view, purchases_view


@query(
    "scan_project",
    """select l_orderkey, l_linenumber, l_quantity, l_extendedprice from lineitem where l_quantity >= 25""",
)
def scan_project(spark: SparkSession, directory: str) -> DataFrame:
    lines = read_table(spark, directory, "lineitem")
    return lines.where(F.col("l_quantity") >= 25).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )


_ORDER_FIELDS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)


@query("csv_roundtrip", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def csv_roundtrip(spark: SparkSession, directory: str) -> DataFrame:
    path = new_path(spark, "csv")
    sinks.write_csv(read_table(spark, directory, "orders").select(*_ORDER_FIELDS.names), path)
    return readers.read_csv(spark, path, _ORDER_FIELDS)


@query(
    "csv_inferred",
    """select o_orderstatus, count(*) as n, cast(sum(o_custkey) as bigint) as sum_custkey, max(o_totalprice) as max_price
       from orders group by o_orderstatus""",
)
def csv_inferred(spark: SparkSession, directory: str) -> DataFrame:
    path = new_path(spark, "csv")
    sinks.write_csv(read_table(spark, directory, "orders").select(*_ORDER_FIELDS.names), path)
    typed = readers.read_csv(spark, path, infer=True)
    return typed.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_custkey").cast("bigint")).alias("sum_custkey"),
        F.max("o_totalprice").alias("max_price"),
    )


@query("drop_header_rows", "select o_orderkey, o_totalprice from orders")
def drop_header_rows(spark: SparkSession, directory: str) -> DataFrame:
    path = new_path(spark, "text")
    sinks.write_csv(read_table(spark, directory, "orders").select(*_ORDER_FIELDS.names), path)
    lines = readers.drop_header_rows(readers.read_lines(spark, path), "o_orderkey")
    return readers.parse_fields(lines, {"o_orderkey": (0, "bigint"), "o_totalprice": (3, "double")})


@query(
    "parse_fields",
    "select l_orderkey, l_quantity, cast(l_linenumber as double) as slot, l_returnflag from lineitem",
)
def parse_fields(spark: SparkSession, directory: str) -> DataFrame:
    lines = read_table(spark, directory, "lineitem").select(
        F.concat_ws(",", "l_orderkey", "l_returnflag", "l_linenumber", "l_quantity").alias("value")
    )
    return readers.parse_fields(
        lines,
        {
            "l_orderkey": (0, "bigint"),
            "l_quantity": (3, "double"),
            "slot": (2, "double"),
            "l_returnflag": (1, "string"),
        },
    )


@query(
    "parse_fields_lenient",
    """select l_orderkey, case when l_returnflag = 'N' then null else cast(l_linenumber as double) end as slot,
              cast(null as double) as missing from lineitem""",
)
def parse_fields_lenient(spark: SparkSession, directory: str) -> DataFrame:
    slot = F.when(F.col("l_returnflag") == "N", "n/a").otherwise(F.col("l_linenumber").cast("string"))
    lines = read_table(spark, directory, "lineitem").select(F.concat_ws(",", "l_orderkey", slot).alias("value"))
    return readers.parse_fields(
        lines,
        {"l_orderkey": (0, "bigint"), "slot": (1, "double"), "missing": (5, "double")},
        strict=False,
    )


@query(
    "literal_rows",
    f"""with toy(number, word) as (values {values(TOY_ROWS)})
        select number, word, count(p_partkey) as n_parts
        from toy left join part on p_size = number group by number, word""",
)
def literal_rows(spark: SparkSession, directory: str) -> DataFrame:
    toy = readers.literal_rows(spark, TOY_ROWS, "number int, word string")
    per_size = read_table(spark, directory, "part").groupBy("p_size").agg(F.count("p_partkey").alias("n"))
    joined = toy.join(per_size, F.col("p_size") == F.col("number"), "left")
    return joined.select("number", "word", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_parts"))


@query(
    "text_sink_roundtrip",
    """select cast(l_orderkey as varchar) || ',' || cast(l_linenumber as varchar) || ',' || l_returnflag as value
       from lineitem""",
)
def text_sink_roundtrip(spark: SparkSession, directory: str) -> DataFrame:
    path = new_path(spark, "lines")
    lines = read_table(spark, directory, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    first = F.col("l_returnflag") == "A"
    sinks.write_text(lines.where(first), path)
    sinks.write_text(lines.where(~first), path, mode="append")
    return readers.read_lines(spark, path)


@query(
    "preview_n",
    "select o_orderkey, o_totalprice from orders order by o_totalprice, o_orderkey limit 30",
)
def preview_n(spark: SparkSession, directory: str) -> DataFrame:
    orders = read_table(spark, directory, "orders").select("o_orderkey", "o_totalprice")
    return project.preview(orders, 30, ["o_totalprice", "o_orderkey"])


@query(
    "schema_report",
    " union all ".join(
        f"""select {position} as position, '{name}' as "column", '{kind}' as type, count(*) as n_rows,
            count(*) - count({name}) as n_null from events"""
        for position, (name, kind) in enumerate(
            [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
             ("value", "double"), ("props", "string")]
        )
    ),
)
def schema_report(spark: SparkSession, directory: str) -> DataFrame:
    return project.schema_report(read_table(spark, directory, "events"))


@query(
    "label_first",
    """select l_extendedprice as label, l_quantity, l_discount, cast(l_linenumber as double) as l_linenumber
       from lineitem""",
)
def label_first(spark: SparkSession, directory: str) -> DataFrame:
    lines = read_table(spark, directory, "lineitem")
    return project.label_first(lines, "l_extendedprice", ["l_quantity", "l_discount", "l_linenumber"])


@query("drop_columns", "select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def drop_columns(spark: SparkSession, directory: str) -> DataFrame:
    return read_table(spark, directory, "orders").drop("o_custkey", "o_orderdate")


_PURCHASE_TYPES = T.StructType(
    [
        T.StructField("Purchase", T.DoubleType()),
        T.StructField("User_ID", T.LongType()),
        T.StructField("Occupation", T.LongType()),
        T.StructField("City_Category", T.StringType()),
    ]
)


@query(
    "conform_schema",
    """select l_extendedprice as "Purchase", o_custkey as "User_ID", cast(l_linenumber as bigint) as "Occupation",
              translate(l_returnflag, 'NR', 'CB') as "City_Category"
       from lineitem join orders on l_orderkey = o_orderkey""",
)
def conform_schema(spark: SparkSession, directory: str) -> DataFrame:
    return readers.conform(purchases_view(spark, directory), _PURCHASE_TYPES)


@query("filter_month", "select o_orderkey, o_totalprice from orders where month(o_orderdate) = 6")
def filter_month(spark: SparkSession, directory: str) -> DataFrame:
    orders = read_table(spark, directory, "orders")
    return project.filter_month(orders, "o_orderdate", 6).select("o_orderkey", "o_totalprice")


_FILLED = """
    select l_orderkey, l_linenumber,
           cast(case when l_returnflag = 'N' then 0 else l_linenumber end as double) as category_2,
           cast(case when l_linestatus = 'O' then 0 else 7 end as double) as category_3
    from lineitem join orders on l_orderkey = o_orderkey"""


@query("fill_empty", _FILLED)
def fill_empty_fields(spark: SparkSession, directory: str) -> DataFrame:
    return purchases_view(spark, directory).select(
        F.col("Order_ID").alias("l_orderkey"),
        F.col("Line_ID").alias("l_linenumber"),
        fill_empty("Product_Category_2").alias("category_2"),
        fill_empty("Product_Category_3").alias("category_3"),
    )


@query(
    "null_nan_profile",
    """with d as (select case when l_returnflag = 'N' then null else l_quantity end as quantity,
                         l_tax, l_returnflag,
                         case when l_discount = 0.05 then cast('nan' as double) else l_discount end as discount
                  from lineitem)
       select 'quantity' as feature, count(*) - count(quantity) as n_null,
              count(*) filter (where isnan(quantity)) as n_nan from d
       union all select 'l_tax', count(*) - count(l_tax), count(*) filter (where isnan(l_tax)) from d
       union all select 'l_returnflag', count(*) - count(l_returnflag), cast(0 as bigint) from d
       union all select 'discount', count(*) - count(discount), count(*) filter (where isnan(discount)) from d""",
)
def null_nan(spark: SparkSession, directory: str) -> DataFrame:
    lines = read_table(spark, directory, "lineitem")
    holes = lines.select(
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("quantity"),
        "l_tax",
        "l_returnflag",
        F.when(F.col("l_discount") == 0.05, float("nan")).otherwise(F.col("l_discount")).alias("discount"),
    )
    return null_nan_profile(holes)


@query(
    "drop_constant_columns",
    """select o_orderkey, yr, o_orderpriority from (
         select o_orderkey, year(o_orderdate) as yr, o_orderpriority from orders where month(o_orderdate) = 6) d""",
)
def drop_constants(spark: SparkSession, directory: str) -> DataFrame:
    june = monthly_view(spark, directory).where("mnth = 6")
    return drop_constant_columns(june.select("o_orderkey", "yr", "mnth", "o_orderpriority"))


@query(
    "row_count",
    """select 'lineitem' as name, count(*) as n from lineitem union all select 'orders', count(*) from orders
       union all select 'events', count(*) from events""",
)
def row_count(spark: SparkSession, directory: str) -> DataFrame:
    counts = [
        read_table(spark, directory, name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        for name in ("lineitem", "orders", "events")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
