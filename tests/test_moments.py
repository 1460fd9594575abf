"""Linear tuning on moments: nulls, and more features than expressions can be written out."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from meanline.plans import models, moments


def _table(spark, n, width, seed=3):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, width)) * draw.uniform(0.1, 9, width) + draw.uniform(-50, 50, width)
    y = x @ draw.normal(size=width) + draw.normal(size=n)
    rows = [(i % 3, float(b), *map(float, a)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    schema = "fold int, label double, " + ", ".join(f"f{i} double" for i in range(width))
    return spark.createDataFrame(rows, schema).repartition(4), x, y


@pytest.mark.parametrize("column", ["f0", "label", "fold"])
@pytest.mark.parametrize("value", ["null", "nan"])
def test_rows_without_a_value_are_refused(spark, column, value):
    if (column, value) == ("fold", "nan"):
        return
    df, _, _ = _table(spark, 30, 2)
    odd = F.lit(None).cast("double") if value == "null" else F.lit(float("nan"))
    bent = df.withColumn(column, F.when(F.col("f1") == df.agg(F.max("f1")).first()[0], odd).otherwise(F.col(column)))
    with pytest.raises(ValueError, match="1 rows have a null"):
        moments.moment_rows(bent, ["f0", "f1"])


def test_written_out_and_matrix_sums_agree(spark, monkeypatch):
    df, _, _ = _table(spark, 200, 5)
    values = [F.col(c) for c in ("f0", "f1", "f2", "f3", "f4", "label")]
    one = sorted(moments._written_out(df, values, "fold"), key=lambda r: r[0])
    two = sorted(moments._as_matrices(df, values, "fold"), key=lambda r: r[0])
    for a, b in zip(one, two, strict=True):
        assert a[:2] == b[:2]
        assert np.allclose(a[2], b[2], rtol=1e-12) and np.allclose(a[3], b[3], rtol=1e-12)


def test_five_hundred_features(spark):
    width, n = 500, 1800
    df, x, y = _table(spark, n, width)
    names = [f"f{i}" for i in range(width)]
    rows = moments.moment_rows(df, names)
    assert rows.count() == 3 * 2 * (width + 1)
    fitted = LinearRegression(weightCol="weight", solver="normal").fit(rows)
    want = np.linalg.lstsq(np.column_stack([x, np.ones(n)]), y, rcond=None)[0]
    assert np.allclose(fitted.coefficients.toArray(), want[:-1], atol=1e-5)
    held = rows.where("fold = 0").agg(F.sum("weight"), F.sum(F.col("weight") * F.col("label")) / F.sum("weight")).first()
    assert held[0] == pytest.approx(600)
    assert held[1] == pytest.approx(y[0::3].mean())


def test_tuning_of_many_features_agrees_with_tuning_on_the_rows(spark):
    df, _, _ = _table(spark, 300, 30)
    names = [f"f{i}" for i in range(30)]
    grid = lambda r: [{r.regParam: p, r.elasticNetParam: 0.0} for p in (0.0, 0.5)]
    tuned, _ = moments.tune_linear(df, names, grid, "rmse", 3)
    regression = LinearRegression()
    rows = models.assembler(names, "features").transform(df).select("features", "label", "fold")
    want = models.cross_validate(rows, regression, grid(regression), "rmse", 3)
    assert tuned.avgMetrics == pytest.approx(want.avgMetrics, rel=1e-6)
