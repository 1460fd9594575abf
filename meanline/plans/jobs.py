"""Complete regression jobs: prepare, split, encode, tune, score, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from meanline.functions.recode import recode_fixed
from meanline.operators.encode import fit_means, held_out_codes
from meanline.operators.metrics import metric_columns
from meanline.operators.order import rank_first, rank_last, rank_middle
from meanline.operators.project import filter_month, label_first
from meanline.operators.split import hash_split, with_fold
from meanline.operators.totals import equal_rows
from meanline.plans import models
from meanline.plans.moments import moment_rows, tune_linear
from meanline.sources.readers import spread
from meanline.sources.storage import shared_table


@dataclass(frozen=True)
class RegressionJob:
    """What one job does to an hourly-shaped table.

    ``fixed`` recodes columns by fixed tables before the split; ``means`` lists
    the columns whose values become mean labels, learnt on training rows only.
    """

    features: Sequence[str]
    regressor: str = "tree"
    grid: str = "default"
    metric: str = "rmse"
    folds: int = 10
    max_categories: int | None = None
    month: int | None = None
    means: Sequence[str] = ()
    fixed: Mapping[str, Mapping[float, float]] = field(default_factory=dict)
    on_unknown: str = "default"
    train_ratio: float = 0.8
    seed: int | None = None


@dataclass(frozen=True)
class JobRun:
    """A finished job: its model, grid metrics, scored test rows and quality figures."""

    model: Model
    metrics: DataFrame
    scored: DataFrame
    quality: DataFrame


def select_rows(df: DataFrame, job: RegressionJob, label: str) -> DataFrame:
    """Month filter, fixed recodes and the label, with the key kept."""
    if job.month is not None and "dteday" in df.columns:
        df = filter_month(df, "dteday", job.month)
    elif job.month is not None:
        df = df.where(F.col("mnth") == job.month)
    frame = label_first(df, label, job.features, keep=["key"])
    for column, table in job.fixed.items():
        frame = recode_fixed(frame, column, table, on_unknown=job.on_unknown)
    return frame


def encoded_parts(frame: DataFrame, job: RegressionJob) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, mean-encoded by what the training rows show."""
    train, test = hash_split(frame, "key", job.train_ratio, job.seed)
    if not job.means:
        return train, test
    encoding = fit_means(train, job.means, "label")
    return encoding.apply(train), encoding.apply(test)


def run_job(df: DataFrame, job: RegressionJob, label: str = "cnt") -> JobRun:
    """Run ``job`` on a table with a ``key`` column.

    The table is read twice: training rows become groups that agree in fold and features, on which all
    encoders and models are fitted with the number of their rows; then the test rows are scored.
    """
    train, test = hash_split(spread(select_rows(df, job, label)), "key", job.train_ratio, job.seed)
    folds = with_fold(train, "key", job.folds, seed=job.folds)
    groups = shared_table(equal_rows(folds, [*job.features, "fold"]), "groups")
    if job.means:
        encoding = fit_means(groups, job.means, "label", weight="n_rows")
        known, test = encoding.apply(groups), encoding.apply(test)
        prepared = models.preparation(job.features, job.max_categories).fit(known)
        # folds see means of the other folds only, so a fold's labels are in none of its features
        shown = held_out_codes(groups, job.means, "label", "fold", weight="n_rows").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ready = models.preparation(job.features, job.max_categories).fit(shown).transform(shown)
            tuned, grid, estimator = _tune(ready, job)
        finally:
            shown.unpersist()
        better = max if job.metric == "r2" else min
        point = tuned.avgMetrics.index(better(tuned.avgMetrics))
        model = _fit_groups(prepared.transform(known), job, estimator, grid[point])
    else:
        prepared = models.preparation(job.features, job.max_categories).fit(groups)
        tuned, grid, _ = _tune(prepared.transform(groups), job)
        model = tuned.bestModel
    spark = groups.sparkSession
    metrics = models.metrics_table(spark, grid, tuned.avgMetrics, tuned.stdMetrics)
    scored = shared_table(
        model.transform(prepared.transform(test)).select("key", *job.features, "label", "prediction"),
        "scored",
    )
    best = max(tuned.avgMetrics) if job.metric == "r2" else min(tuned.avgMetrics)
    quality = scored.agg(*metric_columns()).select(
        F.lit(job.metric).alias("cv_metric"),
        F.lit(float(best)).alias("cv_value"),
        F.col("n").alias("n_test"),
        F.col("rmse").alias("rmse_test"),
        F.col("r2").alias("r2_test"),
    )
    return JobRun(model, metrics, scored, quality)


def fold_encoded(train: DataFrame, job: RegressionJob) -> DataFrame:
    """Training rows with their fold, each mean-encoded by the other folds; values met in no other fold become 0.0."""
    rows = with_fold(train, "key", job.folds, seed=job.folds)
    return held_out_codes(rows, job.means, "label", "fold")


def _flat(prepared: DataFrame, job: RegressionJob) -> tuple[DataFrame, list[str]]:
    """Groups with a column for each slot of their vectors, and the names of those; indexed features are read back."""
    slots = vector_to_array("features")
    names = [f"x{i}" for i in range(len(job.features))]
    columns = [slots[i].alias(name) for i, name in enumerate(names)]
    return prepared.select("fold", "label", "n_rows", "label_var", *columns), names


def _fit_groups(prepared: DataFrame, job: RegressionJob, estimator: Estimator, point: dict) -> Model:
    """One model on all groups; a penalty depends on the spread of the rows' labels, which moments have."""
    if job.regressor != "linear":
        return estimator.fit(prepared.select("label", "features", "n_rows"), point)
    flat, names = _flat(prepared, job)
    flat = flat.withColumn("fold", F.lit(0)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.setWeightCol("weight").fit(moment_rows(flat, names, grouped=True), point)
    finally:
        flat.unpersist()


def _tune(prepared: DataFrame, job: RegressionJob):
    """Grid metrics over the folds of prepared groups: (tuned, grid, estimator)."""
    if job.regressor == "linear":
        # tuned on moments
        flat, names = _flat(prepared, job)
        intercept = job.grid == "full"
        flat = flat.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tuned, _ = tune_linear(
                flat, names, lambda r: models.elastic_net_grid(r, intercept=intercept), job.metric, job.folds,
                grouped=True,
            )
        finally:
            flat.unpersist()
        regression = LinearRegression()
        return tuned, models.elastic_net_grid(regression, intercept=intercept), regression
    columns = ("label", "features", "fold", "n_rows", "label_var")
    ready = spread(prepared.select(*columns)).persist(StorageLevel.MEMORY_AND_DISK)
    estimator = models.tree(max_bins=max(32, (job.max_categories or 0) + 1), grouped=True)
    grid = models.default_grid()
    try:
        return models.cross_validate(ready, estimator, grid, job.metric, job.folds, grouped=True), grid, estimator
    finally:
        ready.unpersist()


def band_report(scored: DataFrame, n: int = 100) -> DataFrame:
    """First, middle and last ``n`` scored rows by label: (band, rnk, key, label, prediction)."""
    rows = scored.select("key", "label", "prediction")
    order = ["label", "key", "prediction"]
    bands = {
        "first": rank_first(rows, order, n),
        "middle": rank_middle(rows, order, n),
        "last": rank_last(rows, order, n),
    }
    parts = [part.select(F.lit(name).alias("band"), "*") for name, part in bands.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def fit_ols(df: DataFrame, features: Sequence[str], label: str = "label"):
    """Least squares with defaults on assembled features: (preparation, model).

    The normal equations need one pass over the rows.
    """
    prepared = models.preparation(features, None).fit(df)
    frame = prepared.transform(df.select(*features, label))
    return prepared, LinearRegression(featuresCol="features", labelCol=label, solver="normal").fit(frame)
