"""Keys with many rows: sketches against exact counts, and what they do to the tasks of a rank or join."""

from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from meanline.operators import encode, order
from meanline.operators.frequent import default_share, frequent_keys


@pytest.fixture(scope="module")
def many(spark):
    """100,000 rows: 50 keys of 0.3 % each, the others once."""
    i = F.col("id")
    hot = i % 1000 < 150
    return spark.range(100_000).select(
        F.when(hot, i % 50).otherwise(i + 1_000_000).alias("k"),
        F.when(hot, F.concat(F.lit("t"), i % 50)).otherwise(F.concat(F.lit("u"), i)).alias("name"), "id",
    ).repartition(6)


def test_all_keys_above_the_share_are_found(many):
    want = {(k, n) for k, n in Counter(r["k"] for r in many.collect()).items() if n * 1000 > 100_000}
    assert len(want) == 50
    found = frequent_keys(many, {"k": [F.col("k")], "both": [F.col("name"), F.col("k")], "id": [F.col("id")]}, 1000)
    assert set(found["k"]) == want
    assert set(found["both"]) == {(f"t{k}", k, n) for k, n in want}
    assert found["id"] == []


@pytest.mark.parametrize("kind", ["string", "double", "date", "boolean", "decimal(20,3)", "timestamp", "binary"])
def test_keys_of_any_type_and_nulls(spark, kind):
    i = F.col("id")
    base = F.when(i % 4 == 0, None).otherwise(F.when(i % 4 == 1, 1).otherwise(0))
    column = F.date_add(F.lit("2020-01-01"), base).cast(kind) if kind in ("date", "timestamp") else (
        base.cast("string").cast("binary") if kind == "binary" else base.cast(kind))
    got = frequent_keys(spark.range(400).select(column.alias("v")), {"v": [F.col("v")]}, 10)["v"]
    assert sorted(n for *_, n in got) == [100, 100, 200]
    assert sum(value is None for value, _ in got) == 1


def test_no_rows_and_no_repeats(spark):
    assert frequent_keys(spark.range(0), {"id": [F.col("id")]}) == {"id": []}
    assert frequent_keys(spark.range(100_000), {"id": [F.col("id")]}, 300) == {"id": []}
    assert default_share(spark) == 256


def test_ranks_with_many_hot_keys_are_even_and_right(spark, many, monkeypatch):
    """With a hundred tasks of 1 % each, no task of the rank has more than twice the rows of the median."""
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    tables = []
    kept = order.shared_table
    monkeypatch.setattr(order, "shared_table", lambda df, name: tables.append((name, kept(df, name))) or tables[-1][1])
    try:
        ranked = order.global_rank(many.select("name", "k"), ["name", "k"]).collect()
        assert sorted(r["rnk"] for r in ranked) == list(range(1, 100_001))
        assert [(r["name"], r["k"]) for r in sorted(ranked, key=lambda r: r["rnk"])] == sorted(
            (r["name"], r["k"]) for r in many.collect()
        )
        for name, table in tables:
            sizes = [r["n"] for r in table.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
            assert max(sizes) <= 2 * median(sizes), name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookup_of_a_large_table_counts_no_rare_key(spark, many):
    encoding = encode.fit_means(many.withColumn("label", F.col("id") * 1.0), ["k", "name"], "label")
    got = encoding.apply(many, {"k": "a", "name": "b"}, broadcast_rows=0)
    want = encoding.apply(many, {"k": "a", "name": "b"})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
