"""Composite jobs on small frames."""

import pytest
from pyspark.sql import functions as F

from meanline.catalog import QUERIES, regressions
from meanline.catalog.regressions import FLAGSHIP, JOBS
from meanline.operators.split import is_train
from meanline.operators.totals import equal_rows
from meanline.plans import jobs, models, moments
from meanline.plans.moments import moment_rows, tune_linear
from meanline.sources.views import trips_view


@pytest.fixture(scope="module")
def trips(spark, small):
    return trips_view(spark, small).cache()


def test_features_do_not_see_test_labels(trips):
    job = JOBS[FLAGSHIP]
    bent = trips.withColumn("cnt", F.when(is_train("key"), F.col("cnt")).otherwise(F.col("cnt") * 1000 + 7))
    for part in (0, 1):
        want = jobs.encoded_parts(jobs.select_rows(trips, job, "cnt"), job)[part].drop("label")
        got = jobs.encoded_parts(jobs.select_rows(bent, job, "cnt"), job)[part].drop("label")
        assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def test_month_by_date_and_by_number_agree(trips):
    job = JOBS["job_tree_month_hour_rank"]
    by_date = jobs.select_rows(trips, job, "cnt")
    by_number = jobs.select_rows(trips.drop("dteday"), job, "cnt")
    assert by_date.count() == by_number.count() == trips.where("mnth = 5").count()


def test_scored_rows_are_the_test_rows(spark, trips):
    job = jobs.RegressionJob(["temp", "atemp"], "tree", "default", "rmse", 2, means=["temp", "atemp"])
    run = jobs.run_job(trips, job)
    assert run.scored.count() == trips.where(~is_train("key")).count() == run.quality.first()["n_test"]
    assert run.metrics.count() == 1
    assert run.quality.first()["r2_test"] > 0.9


def test_linear_job_reports_every_grid_point(trips):
    job = jobs.RegressionJob(["temp", "atemp", "hum"], "linear", "half", "r2", 2, 12)
    run = jobs.run_job(trips, job)
    assert run.metrics.count() == 18
    best = run.metrics.agg(F.max("avg_metric")).first()[0]
    assert run.quality.first()["cv_value"] == pytest.approx(best)


@pytest.mark.parametrize("regressor", ["tree", "linear"])
def test_the_tuning_figure_of_a_noise_label_promises_nothing(spark, regressor):
    i = F.col("id")
    rows = spark.range(1500).select(
        i.alias("key"), F.pmod(F.xxhash64(i), F.lit(500)).cast("double").alias("place"),
        (F.pmod(F.xxhash64(i, F.lit(9)), F.lit(1000)) / 100).alias("cnt"),
    )
    job = jobs.RegressionJob(["place"], regressor, "full", "r2", 3, None, means=["place"])
    quality = jobs.run_job(rows, job).quality.first()
    assert quality["cv_value"] < 0.1
    assert quality["r2_test"] < 0.1


@pytest.mark.parametrize("name", ["job_tree_year_means", "job_linear_year_means", "job_tree_raw"])
def test_models_are_fitted_on_groups_of_equal_rows(spark, trips, name, monkeypatch):
    job, sizes, fit = JOBS[name], [], jobs._tune

    def counted(prepared, job):
        sizes.append((prepared.count(), prepared.agg(F.sum("n_rows")).first()[0]))
        return fit(prepared, job)

    monkeypatch.setattr(jobs, "_tune", counted)
    copies = trips.crossJoin(spark.range(40).withColumnRenamed("id", "copy"))
    copies = copies.withColumn("key", F.col("key") + F.col("copy") * 1_000_000).drop("copy").where("dteday < '1996-01-01'")
    jobs.run_job(copies, job)
    train = copies.where(is_train("key"))
    (groups, rows), = sizes
    assert rows == train.count()
    assert groups <= train.select(*job.features).distinct().count() * job.folds < rows


@pytest.mark.parametrize("metric", ["rmse", "r2"])
def test_groups_give_the_models_and_metrics_of_their_rows(spark, metric):
    i = F.col("id")
    rows = spark.range(3000).select(
        (i % 7).cast("double").alias("a"), (F.pmod(F.xxhash64(i), F.lit(5)) * 0.5).alias("b"),
        F.pmod(F.xxhash64(i, F.lit(2)), F.lit(3)).cast("int").alias("fold"),
        (1e4 + i % 7 * 3 + F.pmod(F.xxhash64(i), F.lit(5)) + F.pmod(F.xxhash64(i, F.lit(3)), F.lit(100)) / 10).alias("label"),
    ).cache()
    groups = equal_rows(rows, ["a", "b", "fold"])
    assert groups.count() < 120
    grid, tuned = models.default_grid(), []
    for frame, grouped in ((rows, False), (groups, True)):
        ready = models.assembler(["a", "b"], "features").transform(frame).cache()
        tree = models.cross_validate(ready, models.tree(grouped=grouped), grid, metric, 3, grouped=grouped)
        linear, _ = tune_linear(frame, ["a", "b"], lambda r: models.elastic_net_grid(r), metric, 3, grouped=grouped)
        moments = moment_rows(frame, ["a", "b"], grouped=grouped).groupBy("fold").agg(F.sum("weight").alias("n")).orderBy("fold")
        tuned.append((tree.avgMetrics, tree.bestModel.toDebugString.split("\n", 1)[1], linear.avgMetrics, moments.toPandas().n.tolist()))
    (tree, nodes, linear, n), (group_tree, group_nodes, group_linear, group_n) = tuned
    assert group_tree == pytest.approx(tree, rel=1e-9)
    assert group_nodes.count("Predict") == nodes.count("Predict")
    assert group_linear == pytest.approx(linear, rel=1e-7)
    assert group_n == pytest.approx(n)


def test_matrices_weigh_groups_as_well(spark, monkeypatch):
    i = F.col("id")
    rows = spark.range(2000).select(
        (i % 3).cast("double").alias("x"), (i % 2).cast("int").alias("fold"), (i % 11 + i % 3).cast("double").alias("label")
    ).cache()
    monkeypatch.setattr(moments, "WRITTEN_OUT", 0)
    measures = [F.sum("weight"), F.sum(F.col("weight") * F.col("label") ** 2)]
    want = moment_rows(rows, ["x"]).agg(*measures).first()
    assert moment_rows(equal_rows(rows, ["x", "fold"]), ["x"], grouped=True).agg(*measures).first() == pytest.approx(want)


def test_a_row_without_a_label_is_refused_in_a_group_too(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (1.0, None)], "x double, label double")
    assert equal_rows(rows, ["x"]).first()["label"] is None


@pytest.mark.parametrize("name", ["job_purchases_per_user", "job_purchases_filled"])
def test_purchases_are_joined_once(spark, small, name, monkeypatch):
    views, read = [], regressions.purchases_view

    def counted(spark, directory):
        seen = spark.sparkContext.accumulator(0)
        views.append(seen)
        rows = read(spark, directory)

        def pass_on(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return rows.mapInArrow(pass_on, rows.schema)

    monkeypatch.setattr(regressions, "purchases_view", counted)
    QUERIES[name](spark, small).collect()
    assert [v.value for v in views] == [read(spark, small).count()]
