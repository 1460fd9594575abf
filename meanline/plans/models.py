"""Assembling, indexing, fitting, tuning and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from meanline.operators.metrics import METRICS, group_metric_columns, metric_columns
from meanline.operators.split import is_train
from meanline.sources.readers import spread

#: The elastic-net search (strength, mix and, optionally, the intercept) and the ridge pair.
REG_PARAMS = (0.1, 0.01, 0.001)
ELASTIC_NET_PARAMS = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)
RIDGE_PAIR = (10000.0, 0.1)


def assembler(features: Sequence[str], output: str = "raw_features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="error")


def indexer(max_categories: int, *, source: str = "raw_features", output: str = "features") -> VectorIndexer:
    """Codes for vector slots with few values; a value not met in fitting gets a code of its own."""
    return VectorIndexer(inputCol=source, outputCol=output, maxCategories=max_categories, handleInvalid="keep")


def preparation(features: Sequence[str], max_categories: int | None) -> Pipeline:
    """Assemble, and index when asked to.  Neither stage looks at the label."""
    if max_categories is None:
        return Pipeline(stages=[assembler(features, "features")])
    return Pipeline(stages=[assembler(features), indexer(max_categories)])


def full_pipeline(features: Sequence[str], max_categories: int | None, regressor: Estimator) -> Pipeline:
    return Pipeline(stages=[*preparation(features, max_categories).getStages(), regressor])


def elastic_net_grid(regression: LinearRegression, *, intercept: bool = True) -> list[dict]:
    """36 points, or 18 without the intercept axis."""
    builder = ParamGridBuilder().addGrid(regression.regParam, list(REG_PARAMS))
    builder = builder.addGrid(regression.elasticNetParam, list(ELASTIC_NET_PARAMS))
    if intercept:
        builder = builder.addGrid(regression.fitIntercept, [True, False])
    return builder.build()


def ridge_grid(regression: LinearRegression) -> list[dict]:
    return ParamGridBuilder().addGrid(regression.regParam, list(RIDGE_PAIR)).build()


def default_grid() -> list[dict]:
    """One point: every parameter at its default."""
    return ParamGridBuilder().build()


def tree(max_depth: int = 5, max_bins: int = 32, seed: int = 7, *, grouped: bool = False) -> DecisionTreeRegressor:
    """A tree on rows or, with ``grouped``, on groups of them: what a split gains depends on numbers and means only."""
    regressor = DecisionTreeRegressor(
        featuresCol="features", labelCol="label", maxDepth=max_depth, maxBins=max_bins, seed=seed
    )
    return regressor.setWeightCol("n_rows") if grouped else regressor


def fit_tree(vectors: DataFrame, regressor: DecisionTreeRegressor) -> DecisionTreeRegressionModel:
    """Fit on ``vectors``, kept while the tree grows: it is read for metadata, cut points and rows."""
    ready = spread(vectors.select("features", "label")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return regressor.fit(ready)
    finally:
        ready.unpersist()


def evaluator(metric: str) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)


def cross_validate(
    frame: DataFrame, estimator: Estimator, grid: list[dict], metric: str, folds: int, *,
    fold_col: str = "fold", parallelism: int = 4, held: Sequence[int] | None = None, grouped: bool = False,
) -> CrossValidatorModel:
    """K-fold tuning with folds given by a column, so they survive repartitioning.

    Gives what `CrossValidator` with a fold column gives.  That one checks the
    column with a Python function per row, caches every fold twice and scores one
    grid point at a time; here folds are plain filters on ``frame`` (persist it)
    and all grid points of a fold are scored in one aggregation.  With ``grouped`` the rows of ``frame`` are
    groups from `totals.equal_rows`, ``estimator`` takes n_rows as weights, and the metrics are those of the rows behind.
    """
    measured = metric_columns
    if grouped:
        label = F.col("label")
        centre = frame.agg(F.sum(label * F.col("n_rows")) / F.sum("n_rows")).first()[0]
        measured = partial(group_metric_columns, centre=centre or 0.0)

    def run(fold: int) -> list[float]:
        train, held = frame.where(F.col(fold_col) != fold), frame.where(F.col(fold_col) == fold)
        fitted = [model for _, model in sorted(estimator.fitMultiple(train, grid), key=lambda pair: pair[0])]
        if isinstance(estimator, Pipeline):  # its inner columns cannot be made twice in one plan
            return [model.transform(held).agg(*measured()).first()[metric] for model in fitted]
        scored, measures = held, []
        for point, model in enumerate(fitted):
            output = f"prediction_{point}"
            scored = model.setPredictionCol(output).transform(scored)
            measures += [c.alias(f"{name}_{point}") for name, c in zip(METRICS, measured("label", output))]
        row = scored.agg(*measures).first()
        return [row[f"{metric}_{point}"] for point in range(len(grid))]

    judged = range(folds) if held is None else held
    with ThreadPool(min(parallelism, len(judged))) as pool:
        by_fold = pool.map(run, judged)
    averages, spreads = np.mean(by_fold, axis=0), np.std(by_fold, axis=0)
    best = int(np.argmin(averages) if metric == "rmse" else np.argmax(averages))
    return CrossValidatorModel(estimator.fit(frame, grid[best]), averages.tolist(), [], spreads.tolist())


def hold_out_tuner(regression: Estimator, grid: list[dict], metric: str = "r2", ratio: float = 0.8, seed: int = 7000):
    """Tuning on one random hold-out; can be the last stage of a pipeline."""
    return TrainValidationSplit(
        estimator=regression, estimatorParamMaps=grid, evaluator=evaluator(metric), trainRatio=ratio, seed=seed
    )


class KeyedHoldOut(Estimator):
    """Tuning on one hold-out drawn by key: the last stage of a pipeline whose rows carry the key.

    Rows of a key are on one side together, and the sides stay what they are after any repartitioning or
    retry, which a random draw by row position does not promise.  The best point is fitted anew on all rows.
    """

    def __init__(
        self, regression: Estimator, grid: list[dict], key: str, metric: str = "r2", ratio: float = 0.8, seed: int | None = None
    ):
        super().__init__()
        self.regression, self.grid, self.key, self.metric, self.ratio, self.seed = regression, grid, key, metric, ratio, seed

    def _fit(self, dataset: DataFrame) -> TrainValidationSplitModel:
        label, features = self.regression.getLabelCol(), self.regression.getFeaturesCol()
        held = F.when(is_train(self.key, self.ratio, self.seed), 1).otherwise(0).alias("fold")
        ready = dataset.select(F.col(features).alias("features"), F.col(label).alias("label"), held)
        ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
        regression = self.regression.copy({self.regression.labelCol: "label", self.regression.featuresCol: "features"})
        try:
            if ready.where("fold = 0").isEmpty() or ready.where("fold = 1").isEmpty():
                raise ValueError(f"the keys in {self.key} leave one side of the hold-out without rows")
            tuned = cross_validate(ready, regression, self.grid, self.metric, 2, held=[0])
        finally:
            ready.unpersist()
        best = tuned.bestModel.setFeaturesCol(features)
        return TrainValidationSplitModel(best, tuned.avgMetrics)


def metrics_table(
    spark: SparkSession, grid: list[dict], averages: Sequence[float], spreads: Sequence[float] | None = None
) -> DataFrame:
    """One row per grid point: (point, regParam, elasticNetParam, fitIntercept, avg_metric, std_metric)."""
    spreads = spreads or [None] * len(averages)
    rows = []
    for point, (params, average, spread) in enumerate(zip(grid, averages, spreads, strict=True)):
        named = {param.name: value for param, value in params.items()}
        rows.append(
            (
                point,
                named.get("regParam"),
                named.get("elasticNetParam"),
                named.get("fitIntercept"),
                float(average),
                None if spread is None else float(spread),
            )
        )
    return spark.createDataFrame(
        rows,
        "point int, regParam double, elasticNetParam double, fitIntercept boolean, "
        "avg_metric double, std_metric double",
    )


def best_row(metrics: DataFrame, larger_is_better: bool) -> DataFrame:
    """The best grid point; the first one among equals."""
    order = F.col("avg_metric").desc_nulls_last() if larger_is_better else F.col("avg_metric").asc_nulls_last()
    return metrics.orderBy(order, "point").limit(1)


def score(model: Model, df: DataFrame) -> DataFrame:
    return model.transform(df)
