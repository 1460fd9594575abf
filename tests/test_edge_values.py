"""Values that are rare in tables but break loose assumptions."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from meanline.operators import encode, order, segments, study, totals
from meanline.operators.project import filter_month
from meanline.operators.split import hash_split, is_train


def test_totals_keep_small_and_negative_amounts(spark):
    rows = spark.createDataFrame([(1, 0.004), (1, -0.001), (2, -0.005), (2, None)], "u int, amount double")
    plain = {r["u"]: r["total"] for r in totals.sum_per_user(rows, "u", "amount", []).collect()}
    assert plain == {1: pytest.approx(0.003), 2: -0.005}
    exact = {r["u"]: float(r["total"]) for r in totals.sum_per_user(rows, "u", "amount", [], scale=3).collect()}
    assert exact == {1: 0.003, 2: -0.005}
    days = rows.withColumn("ts", F.lit("2024-05-01").cast("timestamp"))
    row = totals.daily_rollup(days, "ts", "amount").first()
    assert (row["n"], row["total"], row["mean_value"]) == (4, pytest.approx(-0.002), pytest.approx(-0.002 / 3))


def test_tiny_labels_rank_by_mean(spark):
    rows = spark.createDataFrame([("a", 3e-7), ("b", 2e-7), ("c", 1e-7), (None, 1.5e-7)], "k string, y double")
    codes = {r["text_key"]: r["code"] for r in encode.fit_ranks(rows, ["k"], "y").table.collect()}
    assert codes == {"a": 2.0, "b": 1.0, "c": 0.0}
    assert [r["key"] for r in study.study_by_mean(rows.where("k is not null"), "k", "y").collect()] == ["c", "b", "a"]


@pytest.mark.parametrize("n", [1, 2, 3, 50, 99])
def test_middle_slice_has_n_rows(spark, n):
    got = order.rank_middle(spark.range(1000), ["id"], n).orderBy("rnk").collect()
    first = 500 - n // 2 + 1
    assert [(r["rnk"], r["id"]) for r in got] == [(k, k - 1) for k in range(first, first + n)]


def test_one_row_slice_by_two_columns(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("a"), "id")
    assert [tuple(r) for r in order.rank_slice(rows, ["a", "id"], 5, 5).collect()] == [(5, 0, 12)]


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_slices_refuse_what_has_no_place(spark, bad):
    rows = spark.createDataFrame([(1.0, 1), (bad, 2), (3.0, 3)], "v double, id int")
    with pytest.raises(ValueError, match="1 rows"):
        order.rank_slice(rows, ["v", "id"], 2, 2)


def test_slices_of_zoned_times(spark):
    base = datetime.datetime(2024, 3, 30, 12)
    rows = spark.createDataFrame(
        [(base + datetime.timedelta(minutes=37 * (i % 211), microseconds=i), i) for i in range(400)], "t timestamp, id int"
    )
    want = sorted((r["t"], r["id"]) for r in rows.collect())[190:210]
    got = order.rank_slice(rows, ["t", "id"], 191, 210).orderBy("rnk").collect()
    assert [(r["t"], r["id"]) for r in got] == want


def test_month_filter_survives_stray_dates(spark):
    days = [datetime.date(1, 6, 3), datetime.date(2020, 6, 30), datetime.date(9999, 6, 1), datetime.date(2020, 7, 1), None]
    rows = spark.createDataFrame([(d,) for d in days], "d date")
    began = time.time()
    assert filter_month(rows, "d", 6).count() == 3
    assert time.time() - began < 30
    assert filter_month(rows.where("year(d) = 2020"), "d", 7).count() == 1
    assert filter_month(rows.where("d is null"), "d", 7).count() == 0


def test_any_ratio_splits(spark):
    rows = spark.range(200_000)
    assert rows.where(is_train("id", 0.805)).count() == 161_000
    assert 0 < rows.where(is_train("id", 0.00004, seed=3)).count() < 40
    train, test = hash_split(rows, "id", 1 / 3)
    assert abs(train.count() / 200_000 - 1 / 3) < 0.01 and train.count() + test.count() == 200_000


def test_hours_without_rows_count(spark):
    times = [f"2024-01-{day:02d} {hour:02d}:10:00" for day in range(1, 15) for hour in (8, 9) for _ in range(20)]
    times = [t for t in times if not t.startswith("2024-01-07 08")]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    found = segments.count_anomalies(rows, "ts").collect()
    assert [(r["day"], r["hr"], r["n"]) for r in found] == [(datetime.date(2024, 1, 7), 8, 0)]


def test_many_large_columns_read_the_rows_once_each_way(spark, skewed):
    rows = skewed.withColumn("other", (F.col("id") % 501).cast("int")).withColumn("third", (F.col("id") % 77).cast("int"))
    columns = ["key", "other", "third"]
    encoding = encode.fit_means(rows, columns, "label")
    outputs = {c: f"{c}_mean" for c in columns}
    wide = encoding.apply(rows, outputs, broadcast_rows=0)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 30000") == 1
    assert plan.count("Union") == 0
    narrow = encoding.apply(rows, outputs)
    assert wide.exceptAll(narrow).isEmpty() and narrow.exceptAll(wide).isEmpty()


def test_extreme_ratios_without_a_seed_leave_no_part_empty(spark):
    rows = spark.range(200_000)
    assert [d.count() for d in hash_split(rows, "id", 0.00003)] == [6, 199_994]
    assert [d.count() for d in hash_split(rows, "id", 0.99998)] == [199_996, 4]
    assert [d.count() for d in hash_split(rows, "id", 0.33333)] == [66_667, 133_333]
    with pytest.raises(ValueError, match="ratio"):
        is_train("id", 1e-12)


@pytest.mark.parametrize("robust", [False, True])
def test_stray_dates_stretch_no_calendar(spark, robust):
    """Two rows of the years 1 and 9999 leave the anomalies of the others as they were."""
    draw = [(day * 7 + hour * 3) % 5 for day in range(40) for hour in range(24)]
    times = [
        f"{datetime.date(2024, 1, 1) + datetime.timedelta(day)} {hour:02d}:10:00"
        for day in range(40) for hour in range(24) for _ in range(10 + draw[day * 24 + hour] + (50 if (day, hour) == (20, 5) else 0))
    ]
    at = F.col("t").cast("timestamp").alias("ts")
    plain = spark.createDataFrame([(t,) for t in times], "t string").select(at)
    strays = spark.createDataFrame([("0001-01-01 05:00:00",), ("9999-12-31 05:00:00",), (None,)], "t string").select(at)
    want = segments.count_anomalies(plain, "ts", 5.0, robust=robust).collect()
    assert [(r["day"], r["hr"]) for r in want] == [(datetime.date(2024, 1, 21), 5)]
    got = segments.count_anomalies(plain.unionByName(strays), "ts", 5.0, robust=robust).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert segments.hourly_counts(plain.unionByName(strays), "ts").count() == 40 * 24


def test_anomalies_of_no_rows(spark):
    empty = spark.createDataFrame([(None,)], "ts timestamp")
    assert segments.usual_days(empty, "ts") is None
    assert segments.count_anomalies(empty, "ts").count() == 0


def test_a_spread_that_few_hours_cannot_move(spark):
    """Median and median deviation by hand: counts 8, 10, 10, 12, 40 have centre 10 and deviation 2."""
    rows = [(f"2024-03-{day:02d} 09:00:00",) for day, n in enumerate((8, 10, 10, 12, 40), 1) for _ in range(n)]
    df = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp").alias("ts"))
    got = segments.count_anomalies(df, "ts", 1.0, robust=True).collect()
    assert [(r["day"].day, r["n"], round(r["z"], 6)) for r in got] == [(5, 40, round(30 / (2 * 1.4826), 6))]


def test_each_thread_removes_its_own_tables(spark):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    from meanline.sources.storage import scratch, shared_table

    both = Barrier(2)

    def work(size):
        with scratch(spark) as keep:
            both.wait()
            held = shared_table(spark.range(size), "thread")
            both.wait()
            kept = keep(held.selectExpr("id + 1 as id"), "kept")
        both.wait()
        with pytest.raises(Exception, match="(?i)exist|not.found"):
            spark.read.parquet(held.inputFiles()[0])
        return kept.count()

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(work, [10, 20])) == [10, 20]
