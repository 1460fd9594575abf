"""Encoders against hand-computed values and brute force."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from meanline.operators import encode
from meanline.operators.metrics import regression_metrics, residuals
from meanline.operators.split import hash_split, is_train, with_fold
from meanline.plans import models
from meanline.sources.storage import new_path


def _parts(tiny):
    return tiny.where("split = 'train'"), tiny.where("split = 'test'")


def _by_id(df, column):
    return {r["id"]: r[column] for r in df.collect()}


def test_means_by_hand(tiny):
    train, test = _parts(tiny)
    encoding = encode.fit_means(train, ["hr", "hum"], "label")
    table = {(r["feature"], r["num_key"]): r["code"] for r in encoding.table.collect()}
    assert table == {
        ("hr", 0.0): 15.0, ("hr", 1.0): 15.0, ("hr", 2.0): 50.0,
        ("hum", 0.0): 60.0, ("hum", 0.24): 12.5, ("hum", 0.26): 30.0,
    }
    assert _by_id(encoding.apply(test, {"hr": "m"}), "m") == {6: 15.0, 7: 50.0, 8: 0.0}


@pytest.mark.parametrize("unseen,value", [(0.0, 0.0), (-1.0, -1.0), ("mean", 29.0), (None, None)])
@pytest.mark.parametrize("rows", [0, 1_000_000])
def test_unseen_values(tiny, unseen, value, rows):
    train, test = _parts(tiny)
    coded = encode.fit_means(train, ["hr"], "label").apply(test, unseen=unseen, broadcast_rows=rows)
    assert _by_id(coded, "hr") == {6: 15.0, 7: 50.0, 8: value}
    assert coded.columns == test.columns


def test_ranks_by_hand(tiny):
    train, test = _parts(tiny)
    encoding = encode.fit_ranks(train, ["hr"], "label")
    assert {r["num_key"]: r["code"] for r in encoding.table.collect()} == {0.0: 0.0, 1.0: 1.0, 2.0: 2.0}
    assert _by_id(encoding.apply(test), "hr") == {6: 0.0, 7: 2.0, 8: 0.0}


def test_ranks_of_many_keys_do_not_need_one_task(skewed, monkeypatch):
    want = encode.fit_ranks(skewed, ["key", "name"], "label").table
    monkeypatch.setattr(encode, "WINDOW_ROWS", 1)
    got = encode.fit_ranks(skewed, ["key", "name"], "label").table
    columns = ["feature", "num_key", "int_key", "text_key", "code"]
    assert {tuple(r) for r in got.select(*columns).collect()} == {tuple(r) for r in want.select(*columns).collect()}


@pytest.mark.parametrize("column", ["key", "name"])
def test_shuffle_and_broadcast_lookups_agree_on_skewed_keys(skewed, column):
    encoding = encode.fit_means(skewed.where("id % 2 = 0"), [column], "label")
    wide = encoding.apply(skewed, {column: "m"}, broadcast_rows=0)
    narrow = encoding.apply(skewed, {column: "m"})
    assert wide.count() == skewed.count()
    assert wide.exceptAll(narrow).isEmpty() and narrow.exceptAll(wide).isEmpty()


def test_held_out_means_against_brute_force(skewed):
    rows = with_fold(skewed, "id", 3)
    data = rows.collect()
    got = encode.held_out_means(rows, "key", "label", "fold", "p").collect()
    slow = encode.held_out_means(rows, "key", "label", "fold", "p", broadcast_rows=0)
    sums = {}
    for r in data:
        s, n = sums.get((r["fold"], r["key"]), (0, 0))
        sums[r["fold"], r["key"]] = (s + r["label"], n + 1)
    for r in got:
        other = [sums.get((f, r["key"]), (0, 0)) for f in range(3) if f != r["fold"]]
        s, n = sum(x[0] for x in other), sum(x[1] for x in other)
        want = float(s) / n if n and r["key"] is not None else None
        assert r["p"] == want
    assert len(got) == len(data) == slow.count()


def test_encoder_stage_is_refitted_per_fold_and_removes_the_leak(tiny):
    stage = encode.MeanEncoder(inputCols=["hr"], outputCols=["hr_mean"], unseen="mean")
    pipeline = Pipeline(stages=[stage, models.assembler(["hr_mean"], "features"), models.tree(max_depth=1)])
    train, test = _parts(tiny)
    scored = pipeline.fit(train).transform(test)
    assert _by_id(scored, "hr_mean") == {6: 15.0, 7: 50.0, 8: 29.0}
    copied = stage.copy({stage.unseen: "0.0"})
    assert copied.getUnseen() == "0.0" and stage.getUnseen() == "mean"


def test_metrics_by_hand(tiny):
    train, test = _parts(tiny)
    scored = encode.fit_means(train, ["hr"], "label").apply(test, {"hr": "prediction"})
    row = regression_metrics(scored).first()
    assert row["n"] == 3
    assert row["rmse"] == pytest.approx(17.7482393492988)
    assert row["r2"] == pytest.approx(-1.790354330708661)
    assert _by_id(residuals(scored), "residual") == {6: 3.0, 7: -6.0, 8: 30.0}


def test_key_split_survives_repartitioning(skewed):
    train, test = hash_split(skewed, "id", 0.8, seed=700)
    again, _ = hash_split(skewed.repartition(7), "id", 0.8, seed=700)
    assert sorted(train.collect()) == sorted(again.collect())
    assert train.count() + test.count() == skewed.count()
    assert train.join(test, "id").isEmpty()


def test_key_split_share(spark):
    share = spark.range(20_000).select(is_train("id", 0.8, seed=1).cast("int").alias("t")).agg(F.avg("t")).first()[0]
    assert share == pytest.approx(0.8, abs=0.02)
    assert spark.range(100).where(is_train("id")).count() == 80


def test_saved_encoder_applies_the_same(spark, tiny):
    train, test = _parts(tiny)
    encoding = encode.fit_means(train, ["hr", "hum"], "label")
    path = new_path(spark, "test-encoder")
    encoding.save(path)
    loaded = encode.Encoding.load(spark, path)
    assert loaded.sizes == encoding.sizes
    assert sorted(loaded.apply(test).collect()) == sorted(encoding.apply(test).collect())


def test_encoder_fitted_on_no_rows_gives_the_default(tiny):
    encoding = encode.fit_means(tiny.where("id < 0"), ["hr"], "label")
    assert {r["hr"] for r in encoding.apply(tiny, unseen=-1.0).collect()} == {-1.0}
    assert {r["hr"] for r in encoding.apply(tiny, unseen="mean").collect()} == {None}


@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
def test_all_columns_by_the_other_folds_against_brute_force(skewed, broadcast_rows):
    rows = with_fold(skewed, "id", 5).withColumn("again", F.col("key") % 10)
    columns = {"key": "a", "name": "name", "again": "b"}
    got = encode.held_out_codes(rows, columns, "label", "fold", unseen=None, broadcast_rows=broadcast_rows)
    assert got.columns == [*rows.columns, "a", "b"]
    plain = rows.collect()
    sums = {}
    for r in plain:
        for c in columns:
            for part in (None, r["fold"]):
                s, n = sums.get((c, r[c], part), (0, 0))
                sums[c, r[c], part] = s + r["label"], n + 1

    def mean(r, c):
        if r[c] is None:
            return None
        (s, n), (own, m) = sums[c, r[c], None], sums[c, r[c], r["fold"]]
        return float(s - own) / (n - m) if n > m else None

    want = {}
    for r in plain:
        row = (r["id"], r["fold"], *(mean(r, c) for c in ("key", "name", "again")))
        want[row] = want.get(row, 0) + 1
    seen = {}
    for r in got.collect():
        row = (r["id"], r["fold"], r["a"], r["name"], r["b"])
        seen[row] = seen.get(row, 0) + 1
    assert {k[:2]: n for k, n in seen.items()} == {k[:2]: n for k, n in want.items()}
    ordered = lambda rows: sorted(rows, key=lambda k: tuple((x is None, x or 0) for x in k))
    for a, b in zip(ordered(seen), ordered(want), strict=True):
        assert [x is None for x in a] == [x is None for x in b]
        assert a == pytest.approx(b, rel=1e-12, nan_ok=True) if None not in a else True


def test_all_columns_are_encoded_in_two_passes(spark, skewed):
    """One aggregation and one stage of broadcast joins, however many columns there are."""
    rows = with_fold(skewed, "id", 5).select("fold", "label", *(F.col("key").alias(f"c{i}") for i in range(8)))
    plan = encode.held_out_codes(rows, [f"c{i}" for i in range(8)], "label", "fold")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 8
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_encoding_by_folds_of_no_rows_and_no_columns(spark, skewed):
    rows = with_fold(skewed, "id", 5)
    assert encode.held_out_codes(rows.limit(0), ["key"], "label", "fold").count() == 0
    assert encode.held_out_codes(rows, [], "label", "fold") is rows


@pytest.mark.parametrize("unseen", ["0.0", "mean", "null"])
def test_a_tuned_pipeline_with_an_encoder_is_saved_and_scores_alike(spark, skewed, unseen):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = skewed.where("label is not null").withColumn("label", F.col("label").cast("double"))
    train, test = rows.where("id % 3 > 0"), rows.where("id % 3 = 0 or id > 29000")
    encoder = encode.MeanEncoder(inputCols=["key", "name"], outputCols=["a", "b"], labelCol="label", unseen=unseen)
    regression = LinearRegression()
    tuner = models.KeyedHoldOut(regression, models.ridge_grid(regression), "id")
    assembler = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="skip")
    fitted = Pipeline(stages=[encoder, assembler, tuner]).fit(train)
    # the tuned stage is stored as its best model
    model = PipelineModel([*fitted.stages[:2], fitted.stages[2].bestModel])
    path = new_path(spark, "pipeline")
    model.save(path)
    again = PipelineModel.load(path)
    assert again.stages[0].uid == model.stages[0].uid
    assert again.stages[0].getInputCols() == ["key", "name"]
    columns = ["id", "a", "b", "prediction"]
    want = sorted(map(tuple, model.transform(test).select(*columns).collect()))
    assert sorted(map(tuple, again.transform(test).select(*columns).collect())) == want
    assert want


def test_an_encoder_of_no_rows_is_saved(spark, skewed):
    rows = skewed.limit(0)
    model = encode.MeanEncoder(inputCols=["key"], outputCols=["a"], labelCol="label", unseen="-1.0").fit(rows)
    path = new_path(spark, "encoder")
    model.save(path)
    again = encode.MeanEncoderModel.load(path)
    assert {r["a"] for r in again.transform(skewed.limit(5)).collect()} == {-1.0}


def test_keyed_hold_out_stays_after_repartitioning(spark, skewed):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = skewed.where("key is not null").select("id", F.col("key").cast("double").alias("x"), F.col("label").cast("double"))
    vectors = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    regression = LinearRegression()
    tuner = models.KeyedHoldOut(regression, models.ridge_grid(regression), "id", seed=5)
    one, two = tuner.fit(vectors), tuner.fit(vectors.repartition(7))
    assert one.validationMetrics == pytest.approx(two.validationMetrics, rel=1e-9)
    with pytest.raises(ValueError, match="without rows"):
        tuner.fit(vectors.where("id = 0"))
