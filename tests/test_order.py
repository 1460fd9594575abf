"""Ranks and order statistics against sorting everything on the driver."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meanline.operators import order


def _sorted(df, columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("bracket", [3, 100_000])
def test_order_statistics_with_a_third_of_copies(skewed, bracket):
    values = sorted(r["label"] for r in skewed.select("label").collect())
    ranks = [1, 2, 9_999, 15_000, 29_999, 30_000]
    found = order.order_statistics(skewed, [order.Wanted("label", r) for r in ranks], bracket_rows=bracket)
    for rank, at in zip(ranks, found):
        assert at.value == values[rank - 1]
        assert at.n_less == sum(v < at.value for v in values)
        assert at.n_equal == sum(v == at.value for v in values)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60), st.integers(0, 10**6))
def test_order_statistics_any_values(spark, values, pick):
    rank = pick % len(values) + 1
    df = spark.createDataFrame([(v,) for v in values], "v int")
    at = order.order_statistics(df, [order.Wanted("v", rank)], bracket_rows=2)[0]
    assert at.value == sorted(values)[rank - 1]


@pytest.mark.parametrize("first,last", [(1, 100), (9_950, 10_049), (14_951, 15_050), (29_901, 30_000)])
@pytest.mark.parametrize("columns", [["label", "id"], ["name", "label", "id"], ["label", "name", "id"]])
def test_rank_slice_is_the_sorted_slice(skewed, columns, first, last):
    rows = order.rank_slice(skewed.select(*columns), columns, first, last).orderBy("rnk").collect()
    assert [r["rnk"] for r in rows] == list(range(first, last + 1))
    assert [tuple(r[c] for c in columns) for r in rows] == _sorted(skewed, columns)[first - 1 : last]


def test_rank_slice_within_bounds_only(spark):
    df = spark.range(10)
    assert order.rank_slice(df, ["id"], 8, 20).count() == 3
    assert order.rank_slice(df, ["id"], 11, 20).count() == 0
    assert [r["id"] for r in order.rank_middle(df, ["id"], 4).orderBy("rnk").collect()] == [3, 4, 5, 6]


def test_global_rank_spreads_copies_and_keeps_every_row(skewed):
    columns = ["label", "name", "id"]
    ranked = order.global_rank(skewed.select(*columns), columns).orderBy("rnk").collect()
    assert [r["rnk"] for r in ranked] == list(range(1, 30_001))
    assert [tuple(r[c] for c in columns) for r in ranked] == _sorted(skewed, columns)


def test_global_rank_parts_copies_over_tasks(spark):
    """A third of the rows agree in every ordering column and a tenth have none of them."""
    i = F.col("id")
    rows = spark.range(0, 9_000, 1, 6).select(
        F.when(i % 3 == 0, 5).when(i % 10 == 1, None).otherwise(i % 89).cast("int").alias("a"),
        F.when(i % 3 == 0, "x").when(i % 10 == 1, None).otherwise((i % 71).cast("string")).alias("b"),
        i,
    )
    assert len(order._frequent_keys(rows, ["a", "b"])) == 2
    ranked = order.global_rank(rows, ["a", "b"]).collect()
    assert sorted(r["rnk"] for r in ranked) == list(range(1, 9_001))
    assert sorted(r["id"] for r in ranked) == list(range(9_000))

    def key(r):
        return (r["a"] is not None, r["a"] or 0, r["b"] is not None, r["b"] or "")

    ordered = sorted(ranked, key=lambda r: r["rnk"])
    assert [key(r) for r in ordered] == sorted(key(r) for r in ranked)


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 4, 8)] + [(None,)], "v double")
    assert order.exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 1.0]) == {"v": [1.0, 1.75, 3.0, 8.0]}


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert order.exact_quantiles(df, ["v"], [0.5]) == {"v": [None]}


@pytest.mark.parametrize("n,tiles", [(10, 3), (3, 5), (30_000, 5)])
def test_tiles_match_the_window_function(spark, n, tiles):
    df = spark.range(n).select((F.col("id") % 7).alias("v"), F.col("id"))
    got = order.add_ntiles(df, {"v": "tile"}, "id", tiles)
    df.createOrReplaceTempView("tiled")
    want = spark.sql(f"select id, ntile({tiles}) over (order by v, id) as tile from tiled")
    assert {(r["id"], r["tile"]) for r in got.collect()} == {(r["id"], r["tile"]) for r in want.collect()}


def test_first_and_last(spark):
    df = spark.range(250)
    assert {(r["rnk"], r["id"]) for r in order.rank_first(df, ["id"], 3).collect()} == {(1, 0), (2, 1), (3, 2)}
    assert {(r["rnk"], r["id"]) for r in order.rank_last(df, ["id"], 2).collect()} == {(250, 249), (249, 248)}
