"""Quantile sketches per period, merged, against exact ranks."""

import pytest
from pyspark.sql import functions as F

from meanline.operators import study


@pytest.fixture(scope="module")
def rows(spark):
    """60,000 rows in 30 periods that differ much; a third of one column is one value, some are null or NaN."""
    i = F.col("id")
    value = F.when(i % 3 == 0, 5.0).otherwise(F.pmod(F.xxhash64(i), F.lit(100_000)) / 7 + (i % 30) * 1000)
    odd = F.when(i % 50 == 1, None).when(i % 50 == 2, float("nan")).otherwise(F.exp(F.pmod(F.xxhash64(i, i), F.lit(900)) / 100))
    return spark.range(60_000).select((i % 30).alias("day"), value.alias("a"), odd.alias("b"))


def test_merged_sketches_keep_to_their_bound(rows):
    fractions = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    daily = study.sketched_by(rows, ["a", "b"], {"day": F.col("day")}).cache()
    assert daily.count() == 60
    assert daily.agg(F.max(F.octet_length("sketch"))).first()[0] < 20_000
    profile = study.merged_profile(daily, fractions)
    got = {r["feature"]: r for r in profile.collect()}
    want = rows.where("not isnan(b)").agg(F.avg("b"), F.min("b"), F.max("b"), F.count("b")).first()
    assert (got["a"]["n"], got["b"]["n"], got["a"]["n_periods"]) == (60_000, want[3], 30)
    assert got["b"]["mean"] == pytest.approx(want[0])
    assert (got["b"]["min"], got["b"]["max"]) == (want[1], want[2])
    errors = study.rank_errors(rows, profile, fractions).collect()
    assert len(errors) == 14
    assert max(r["error"] for r in errors) <= study.RANK_ERROR


def test_errors_are_counted_exactly(spark):
    rows = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    profile = spark.createDataFrame([("v", 100, [10.0, 90.0])], "feature string, n bigint, quantiles array<double>")
    got = {r["fraction"]: r["error"] for r in study.rank_errors(rows, profile, [0.1, 0.5]).collect()}
    assert got == {0.1: 0.0, 0.5: pytest.approx(0.39)}


def test_periods_put_together_by_month(rows):
    by_third = study.sketched_by(rows, ["a"], {"day": F.col("day")}).withColumn("third", F.col("day") % 3)
    parts = {r["third"]: r for r in study.merged_profile(by_third, [0.5], ["third"]).collect()}
    assert sorted(parts) == [0, 1, 2]
    assert all(r["n"] == 20_000 and r["n_periods"] == 10 for r in parts.values())


def test_no_rows(spark, rows):
    daily = study.sketched_by(rows.limit(0), ["a"], {"day": F.col("day")})
    assert study.merged_profile(daily).count() == 0
    assert study.rank_errors(rows, study.merged_profile(daily)).count() == 0
