"""Tuning: the route by moments, the fold loop and Spark's own cross-validator must agree."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from meanline.operators.encode import MeanEncoder
from meanline.operators.split import with_fold
from meanline.plans import models
from meanline.plans.moments import moment_rows, tune_linear
from meanline.sources.views import TRIP_FEATURES, trips_view

FEATURES = ["hr", "temp", "atemp", "hum", "holiday"]


@pytest.fixture(scope="module")
def frame(spark, small):
    rows = with_fold(trips_view(spark, small).withColumnRenamed("cnt", "label"), "key", 3)
    return models.assembler(FEATURES, "features").transform(rows).cache()


def small_grid(regression):
    return (
        models.ParamGridBuilder()
        .addGrid(regression.regParam, [0.1, 1.0])
        .addGrid(regression.elasticNetParam, [0.0, 0.4, 1.0])
        .addGrid(regression.fitIntercept, [True, False])
        .build()
    )


@pytest.mark.parametrize("metric", ["r2", "rmse"])
def test_tuning_on_moments_equals_tuning_on_the_rows(frame, metric):
    regression = LinearRegression()
    grid = small_grid(regression)
    spark_cv = CrossValidator(
        estimator=regression, estimatorParamMaps=grid, evaluator=models.evaluator(metric), numFolds=3, foldCol="fold"
    ).fit(frame)
    loop = models.cross_validate(frame, regression, grid, metric, 3)
    once, _ = tune_linear(frame, FEATURES, small_grid, metric, 3)
    assert loop.avgMetrics == pytest.approx(spark_cv.avgMetrics, rel=1e-9)
    assert once.avgMetrics == pytest.approx(spark_cv.avgMetrics, rel=1e-6)
    want = spark_cv.bestModel
    assert once.bestModel.coefficients.toArray() == pytest.approx(want.coefficients.toArray(), rel=1e-5, abs=1e-7)
    assert once.bestModel.intercept == pytest.approx(want.intercept, rel=1e-5)


def test_compact_rows_have_the_same_moments(frame):
    rows = frame.select("fold", "label", *FEATURES).toPandas()
    compact = moment_rows(frame, FEATURES).toPandas()
    for fold, part in rows.groupby("fold"):
        small = compact[compact["fold"] == fold]
        points = np.column_stack([np.stack([v.toArray() for v in small["features"]]), small["label"]])
        full = part[[*FEATURES, "label"]].to_numpy(dtype=float)
        weight = small["weight"].to_numpy()
        assert weight.sum() == pytest.approx(len(part))
        assert np.average(points, axis=0, weights=weight) == pytest.approx(full.mean(axis=0))
        covariance = np.cov(points.T, aweights=weight, bias=True)
        assert covariance == pytest.approx(np.cov(full.T, bias=True), abs=1e-9, rel=1e-9)


def test_missing_fold_is_refused(frame):
    with pytest.raises(ValueError, match="folds present"):
        tune_linear(frame.where("fold < 2"), FEATURES, small_grid, "r2", 3)


def test_grids(spark):
    regression = LinearRegression()
    assert len(models.elastic_net_grid(regression)) == 36
    assert len(models.elastic_net_grid(regression, intercept=False)) == 18
    assert len(models.ridge_grid(regression)) == 2
    assert models.default_grid() == [{}]


def test_metrics_table_and_best_row(spark):
    regression = LinearRegression()
    grid = models.elastic_net_grid(regression)
    table = models.metrics_table(spark, grid, [float(i % 7) - 9 for i in range(36)])
    assert table.count() == 36
    assert models.best_row(table, True).first()["point"] == 6
    assert models.best_row(table, False).first()["point"] == 0
    assert models.best_row(table, True).first()["avg_metric"] == -3.0


def test_indexer_orders_codes_and_keeps_new_values(spark):
    rows = spark.createDataFrame([(0.26,), (0.24,), (0.0,)], "hum double")
    prepared = models.preparation(["hum"], 10).fit(rows)
    codes = {r["hum"]: r["features"][0] for r in prepared.transform(rows).collect()}
    assert codes == {0.0: 0.0, 0.24: 1.0, 0.26: 2.0}
    new = prepared.transform(spark.createDataFrame([(0.5,)], "hum double")).first()
    assert new["features"][0] == 3.0


def test_tree_cross_validation(spark, small):
    rows = with_fold(trips_view(spark, small).withColumnRenamed("cnt", "label"), "key", 3)
    ready = models.preparation(TRIP_FEATURES, 24).fit(rows).transform(rows).select("features", "label", "fold").cache()
    tuned = models.cross_validate(ready, models.tree(), models.default_grid(), "rmse", 3)
    assert len(tuned.avgMetrics) == 1
    spread = ready.agg(F.stddev_samp("label")).first()[0]
    assert tuned.avgMetrics[0] < spread / 2


def test_pipeline_with_an_encoder_is_refitted_per_fold(spark):
    """With a label of pure noise per key, an encoder fitted on all rows would look good; a refitted one must not."""
    rows = spark.range(300).select(
        (F.col("id") / 2).cast("int").alias("key"),
        F.rand(3).alias("label"),
        (F.col("id") % 2).cast("int").alias("fold"),
    ).cache()
    encoder = MeanEncoder(inputCols=["key"], outputCols=["key_mean"], unseen="mean")
    pipeline = models.Pipeline(stages=[encoder, models.assembler(["key_mean"], "features"), models.tree()])
    tuned = models.cross_validate(rows, pipeline, models.default_grid(), "r2", 2)
    assert tuned.avgMetrics[0] < 0.1
    spark_cv = CrossValidator(
        estimator=pipeline, estimatorParamMaps=[{}], evaluator=models.evaluator("r2"), numFolds=2, foldCol="fold"
    ).fit(rows)
    assert tuned.avgMetrics == pytest.approx(spark_cv.avgMetrics)
