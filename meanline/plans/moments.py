"""Linear tuning in two passes: rows are replaced by a few that have the same moments.

A linear least-squares fit, with any elastic-net penalty, and its squared error
depend on the data only through counts, means and second moments.  One grouped
aggregation collects these per fold; each fold then becomes 2 (p + 1) weighted
rows with exactly the same moments, and Spark ML fits those.  A grid of 36
points over 3 folds reads the data twice (means to centre on, then moments)
instead of 216 times.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Beyond so many features the sums of products are not written out one by one but summed as matrices.
WRITTEN_OUT = 24
_BLOCK_ROWS = 64


def _written_out(
    df: DataFrame, values: Sequence[Column], fold: str, grouped: bool = False
) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(fold, rows, sums, sums of products) of each fold, one aggregate for each pair."""
    label = len(values) - 1
    n, weighed, within = F.count(F.lit(1)), values, F.lit(0.0)
    if grouped:
        n, weighed = F.sum("n_rows"), [F.col("n_rows") * v for v in values]
        within = F.sum(F.col("n_rows") * F.col("label_var"))
    pairs = [(i, j) for i in range(len(values)) for j in range(i, len(values))]
    sums = df.groupBy(F.col(fold).cast("int").alias("fold")).agg(
        n.alias("n"),
        F.array(*[F.sum(v) for v in weighed]).alias("s"),
        F.array(*[F.sum(weighed[i] * values[j]) for i, j in pairs]).alias("ss"),
        within.alias("within"),
    )
    found = []
    for group in sums.collect():  # one row per fold
        products = np.zeros((len(values), len(values)))
        for (i, j), value in zip(pairs, group["ss"], strict=True):
            products[i, j] = products[j, i] = value
        products[label, label] += group["within"]
        found.append((group["fold"], group["n"], np.array(group["s"]), products))
    return found


def _as_matrices(
    df: DataFrame, values: Sequence[Column], fold: str, grouped: bool = False
) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """The same by products of matrices: tasks add up one matrix a fold, blocks of its rows are then merged."""
    size = len(values)
    schema = "fold int, block int, n bigint, sums array<double>"

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            folds = batch.column(0).to_numpy()
            weights, spread = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            # a column of ones gives the plain sums
            table = np.column_stack([*(c.to_numpy() for c in batch.columns[3:]), np.ones(batch.num_rows)])
            for number in np.unique(folds).tolist():
                here = folds == number
                part, many = table[here], weights[here]
                products = part.T @ (part * many[:, None])
                products[size - 1, size - 1] += many @ spread[here]
                held[number] = held.get(number, 0) + products
                counts[number] = counts.get(number, 0) + int(many.sum())
        for number, matrix in held.items():
            for at in range(0, size + 1, _BLOCK_ROWS):
                yield blocks([(number, at, counts[number], matrix[at : at + _BLOCK_ROWS].ravel())])

    def blocks(rows: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.list_(pa.float64()))],
            names=["fold", "block", "n", "sums"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                n, sums = held.get(key, (0, 0.0))
                held[key] = n + batch.column(2)[i].as_py(), sums + batch.column(3)[i].values.to_numpy()
        for (number, at), (n, sums) in held.items():
            yield blocks([(number, at, n, sums)])

    kept = ("n_rows", "label_var") if grouped else (F.lit(1).cast("bigint").alias("n_rows"), F.lit(0.0).alias("label_var"))
    flat = df.select(F.col(fold).cast("int").alias("fold"), *kept, *(v.alias(f"v{i}") for i, v in enumerate(values)))
    merged = flat.mapInArrow(multiply, schema).repartition("fold", "block").mapInArrow(merge, schema)
    counts: dict[int, int] = {}
    matrices: dict[int, np.ndarray] = {}
    for row in merged.collect():  # (p + 2) ** 2 numbers per fold
        matrix = matrices.setdefault(row["fold"], np.zeros((size + 1, size + 1)))
        matrix[row["block"] : row["block"] + _BLOCK_ROWS] = np.reshape(row["sums"], (-1, size + 1))
        counts[row["fold"]] = row["n"]
    return [(number, counts[number], m[size, :size], m[:size, :size]) for number, m in matrices.items()]


def moment_rows(
    df: DataFrame, features: Sequence[str], label: str = "label", fold: str = "fold", *, grouped: bool = False
) -> DataFrame:
    """(fold, features, label, weight): weighted rows with each fold's count, means and covariances.

    With ``grouped`` the rows of ``df`` are groups from `totals.equal_rows`, and the moments those of the rows behind.
    Rows with a null or NaN among features and label have no moments: they raise ``ValueError``, as a fit
    on the rows themselves would.
    """
    names = [*features, label]
    values = [F.col(f"`{name}`").cast("double") for name in names]
    odd = F.exists(F.array(*values), lambda v: v.isNull() | F.isnan(v)) | F.col(fold).isNull()
    bad = F.coalesce(F.sum(F.when(odd, F.col("n_rows") if grouped else 1)), F.lit(0)).alias("odd")
    pivot = df.agg(*[F.avg(v).alias(str(i)) for i, v in enumerate(values)], bad).first()
    if pivot["odd"]:
        raise ValueError(f"{pivot['odd']} rows have a null or NaN among {', '.join(names[:20])} or no fold")
    shift = np.array([pivot[str(i)] or 0.0 for i in range(len(names))], dtype=float)
    centred = [v - F.lit(float(at)) for v, at in zip(values, shift, strict=True)]
    size, rows = len(names), []
    summed = _written_out if len(features) <= WRITTEN_OUT else _as_matrices
    for number, n, sums, products in summed(df, centred, fold, grouped):
        mean = sums / n
        spread, axes = np.linalg.eigh(products / n - np.outer(mean, mean))
        steps = axes * np.sqrt(np.clip(spread, 0.0, None) * size)
        weight = n / (2.0 * size)
        for step in np.vstack([steps.T, -steps.T]):
            rows.append((number, Vectors.dense((shift + mean + step)[:-1]), float((shift + mean + step)[-1]), weight))
    schema = T.StructType([
        T.StructField("fold", T.IntegerType()), T.StructField("features", VectorUDT()),
        T.StructField("label", T.DoubleType()), T.StructField("weight", T.DoubleType()),
    ])
    return df.sparkSession.createDataFrame(rows, schema).coalesce(1)


def _scores(models: list[LinearRegressionModel], points: np.ndarray, weight: np.ndarray, metric: str) -> list[float]:
    """rmse or r2 of each model on one fold's weighted rows (label in the last column)."""
    x, y = points[:, :-1], points[:, -1]
    total = np.sum(weight * (y - np.average(y, weights=weight)) ** 2)
    scores = []
    for model in models:
        error = y - (x @ model.coefficients.toArray() + model.intercept)
        residual = np.sum(weight * error**2)
        scores.append(float(np.sqrt(residual / weight.sum())) if metric == "rmse" else float(1 - residual / total))
    return scores


def tune_linear(
    df: DataFrame,
    features: Sequence[str],
    grid_of: Callable[[LinearRegression], list[dict]],
    metric: str,
    folds: int,
    *,
    fold: str = "fold",
    label: str = "label",
    parallelism: int = 8,
    grouped: bool = False,
) -> tuple[CrossValidatorModel, list[dict]]:
    """Cross-validate an elastic-net regression; ``grid_of`` builds its grid.

    Same folds, models and averages as `models.cross_validate` on the rows
    themselves, and the same kind of result.
    """
    regression = LinearRegression(featuresCol="features", labelCol="label", weightCol="weight", solver="normal")
    grid = grid_of(regression)
    rows = moment_rows(df, features, label, fold, grouped=grouped).cache()
    try:
        held = {}
        for row in rows.collect():  # 2 (p + 1) rows per fold
            held.setdefault(row["fold"], []).append((*row["features"], row["label"], row["weight"]))
        if sorted(held) != list(range(folds)):
            raise ValueError(f"folds present: {sorted(held)}, wanted 0..{folds - 1}")
        parts = {number: rows.where(F.col("fold") != number).coalesce(1).cache() for number in held}
        tasks = [(number, params) for number in held for params in grid]
        with ThreadPool(min(parallelism, len(tasks))) as pool:
            fitted = pool.map(lambda task: regression.fit(parts[task[0]], task[1]), tasks)
        by_fold = []
        for number, points in held.items():
            models = [model for (at, _), model in zip(tasks, fitted) if at == number]
            table = np.array(points)
            by_fold.append(_scores(models, table[:, :-1], table[:, -1], metric))
        for part in parts.values():
            part.unpersist()
        averages, spreads = np.mean(by_fold, axis=0), np.std(by_fold, axis=0)
        best = int(np.argmin(averages) if metric == "rmse" else np.argmax(averages))
        model = regression.fit(rows, grid[best])
    finally:
        rows.unpersist()
    return CrossValidatorModel(model, averages.tolist(), [], spreads.tolist()), grid
