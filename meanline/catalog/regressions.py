"""Assembling, fitting, tuning, scoring, and the composite jobs."""

from __future__ import annotations

import itertools

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meanline.catalog import job_rows
from meanline.catalog.registry import query, values
from meanline.functions import fixed_values
from meanline.functions.clean import fill_empty
from meanline.functions.recode import age_code, city_code, gender_code, marital_code, topcoded_years
from meanline.operators.metrics import group_metric_columns, metric_columns, regression_metrics, residuals
from meanline.operators.split import hash_split, is_train, with_fold
from meanline.operators.totals import equal_rows, sum_per_user
from meanline.plans import jobs, models
from meanline.plans.moments import tune_linear
from meanline.sources.readers import literal_rows, read_table, spread
from meanline.sources.storage import cut, shared_table
from meanline.sources.views import TRIP_FEATURES, purchases_view, trips_view

_CHARGED = "l_extendedprice * (1 - l_discount) / 1000"
_PRICE = "l_extendedprice / 1000"


def _charges(spark: SparkSession, directory: str) -> DataFrame:
    """A label with a linear signal, and its key."""
    price = F.col("l_extendedprice")
    return read_table(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_quantity",
        (price / 1000).alias("price"), (price * (1 - F.col("l_discount")) / 1000).alias("label"),
    )


@query(
    "assemble_features",
    "select l_quantity as label, l_discount as x0, l_tax as x1, cast(l_linenumber as double) as x2 from lineitem",
)
def assemble_features(spark: SparkSession, directory: str) -> DataFrame:
    lines = read_table(spark, directory, "lineitem")
    vectors = models.assembler(["l_discount", "l_tax", "l_linenumber"]).transform(lines)
    slots = vector_to_array("raw_features")
    return vectors.select(F.col("l_quantity").alias("label"), *[slots[i].alias(f"x{i}") for i in range(3)])


@query(
    "vector_index",
    """select l_orderkey, l_linenumber,
          cast(dense_rank() over (order by l_discount <> 0, l_discount) - 1 as double) as x0,
          cast(dense_rank() over (order by l_tax <> 0, l_tax) - 1 as double) as x1, l_quantity as x2 from lineitem""",
)
def vector_index(spark: SparkSession, directory: str) -> DataFrame:
    lines = read_table(spark, directory, "lineitem")
    prepared = models.preparation(["l_discount", "l_tax", "l_quantity"], 12).fit(lines).transform(lines)
    slots = vector_to_array("features")
    return prepared.select("l_orderkey", "l_linenumber", *[slots[i].alias(f"x{i}") for i in range(3)])


@query(
    "ols_fit",
    f"""with d as (select {_CHARGED} as y, {_PRICE} as x from lineitem)
        select round(regr_intercept(y, x), 6) as intercept, round(regr_slope(y, x), 8) as slope,
               round(regr_r2(y, x), 8) as r2, count(*) as n from d""",
)
def ols_fit(spark: SparkSession, directory: str) -> DataFrame:
    rows = _charges(spark, directory)
    prepared, model = jobs.fit_ols(rows, ["price"])
    scored = model.transform(prepared.transform(rows))
    return scored.agg(
        F.round(F.lit(float(model.intercept)), 6).alias("intercept"),
        F.round(F.lit(float(model.coefficients[0])), 8).alias("slope"),
        *[F.round(c, 8).alias("r2") for c in metric_columns()[2:]],
        F.count(F.lit(1)).alias("n"),
    )


_OLS_TRAIN = f"""with d as (select l_orderkey, l_linenumber, {_CHARGED} as y, {_PRICE} as x,
        l_orderkey % 5 < 4 as train from lineitem),
    m as (select regr_intercept(y, x) as a, regr_slope(y, x) as b from d where train)"""


def _scored_charges(spark: SparkSession, directory: str) -> DataFrame:
    train, test = hash_split(_charges(spark, directory), "l_orderkey")
    prepared, model = jobs.fit_ols(train, ["price"])
    return model.transform(prepared.transform(test))


@query(
    "ols_score",
    f"{_OLS_TRAIN} select l_orderkey, l_linenumber, round(a + b * x, 3) as prediction from d, m where not train",
)
def ols_score(spark: SparkSession, directory: str) -> DataFrame:
    return _scored_charges(spark, directory).select(
        "l_orderkey", "l_linenumber", F.round("prediction", 3).alias("prediction")
    )


@query(
    "residuals",
    f"{_OLS_TRAIN} select l_orderkey, l_linenumber, round(y - (a + b * x), 3) as residual from d, m where not train",
)
def residual_rows(spark: SparkSession, directory: str) -> DataFrame:
    return residuals(_scored_charges(spark, directory)).select(
        "l_orderkey", "l_linenumber", F.round("residual", 3).alias("residual")
    )


_FELT = job_rows.listed_sql(fixed_values.FELT_TEMPERATURE_RANK, "floor(l_extendedprice / 1600)")
_WIND = job_rows.listed_sql(fixed_values.WIND_BIN, "round(l_tax * 100)")


def _unlisted_sql(column: str, value: str, table: dict[float, float]) -> str:
    listed = ", ".join(f"{v!r}::double" for v in sorted(table))
    return f"select '{column}' as feature, count(*) filter ({value} not in ({listed})) as n_unlisted, sum({value}) as total from lineitem"


_READINGS = {
    "temp": ("round(l_quantity / 50, 2)", fixed_values.TEMPERATURE_RANK),
    "atemp": (_FELT, fixed_values.FELT_TEMPERATURE_RANK),
    "hum": ("round(l_discount * 10, 2)", fixed_values.HUMIDITY_RANK),
    "windspeed": (_WIND, fixed_values.WIND_BIN),
}


@query(
    "unlisted_readings",
    "select feature, n_unlisted, round(total, 4) as total from ("
    + " union all ".join(_unlisted_sql(name, sql, table) for name, (sql, table) in _READINGS.items()) + ")",
)
def unlisted_readings(spark: SparkSession, directory: str) -> DataFrame:
    """Readings that a fixed table does not list: none, so the recodes may raise on one."""
    rows = trips_view(spark, directory)
    entries = [
        F.struct(
            F.lit(name).alias("feature"), F.count_if(~F.col(name).isin(sorted(table))).alias("n_unlisted"),
            F.round(F.sum(name), 4).alias("total"),
        )
        for name, (_, table) in _READINGS.items()
    ]
    return rows.agg(F.array(*entries).alias("_s")).select(F.inline("_s"))


@query(
    "score_check_row",
    f"""with d as (select l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000 as y, {_FELT} as x from lineitem)
        select {fixed_values.CHECK_ROW[0]!r}::double as label, {fixed_values.CHECK_ROW[10]!r}::double as atemp,
               round(regr_intercept(y, x) + regr_slope(y, x) * {fixed_values.CHECK_ROW[10]!r}, 6) as prediction
        from d""",
)
def score_check_row(spark: SparkSession, directory: str) -> DataFrame:
    rows = trips_view(spark, directory).withColumnRenamed("cnt", "label")
    prepared, model = jobs.fit_ols(rows, ["atemp"])
    schema = ", ".join(f"{name} double" for name in ("label", *TRIP_FEATURES))
    check = literal_rows(spark, [fixed_values.CHECK_ROW], schema)
    scored = model.transform(prepared.transform(check))
    return scored.select("label", "atemp", F.round("prediction", 6).alias("prediction"))


@query("score_check_row_tuned")
def score_check_row_tuned(spark: SparkSession, directory: str) -> DataFrame:
    """The known hour scored by the elastic net on all twelve features, tuned over three folds."""
    rows = with_fold(trips_view(spark, directory).withColumnRenamed("cnt", "label"), "key", 3)
    names = list(TRIP_FEATURES)
    flat = rows.select("fold", "label", *[F.col(c).cast("double").alias(c) for c in names])
    tuned, _ = tune_linear(flat, names, models.elastic_net_grid, "r2", 3)
    schema = ", ".join(f"{name} double" for name in ("label", *TRIP_FEATURES))
    check = literal_rows(spark, [fixed_values.CHECK_ROW], schema)
    scored = tuned.bestModel.transform(models.assembler(names, "features").transform(check))
    return scored.select("label", F.lit(float(max(tuned.avgMetrics))).alias("cv_r2"), "prediction")


@query(
    "tree_stump",
    """with d as (select l_discount as x, l_extendedprice * (1 - l_discount) as y from lineitem),
          g as (select x, count(*) as n, sum(y) as s from d group by x),
          t as (select sum(n) as n, sum(s) as s from g),
          c as (select a.x as cut, sum(b.n) as ln, sum(b.s) as ls from g a join g b on b.x <= a.x group by a.x),
          best as (select cut, ls / ln as lo, (t.s - ls) / (t.n - ln) as hi from c, t where ln < t.n
                   order by ls * ls / ln + (t.s - ls) * (t.s - ls) / (t.n - ln) desc limit 1)
        select x as l_discount, n, round(case when x <= cut then lo else hi end, 4) as prediction from g, best""",
)
def tree_stump(spark: SparkSession, directory: str) -> DataFrame:
    price = F.col("l_extendedprice")
    rows = read_table(spark, directory, "lineitem").select(
        "l_discount", (price * (1 - F.col("l_discount"))).alias("label")
    )
    vectors = models.assembler(["l_discount"], "features").transform(rows)
    scored = models.fit_tree(vectors, models.tree(max_depth=1)).transform(vectors)
    per_value = scored.groupBy("l_discount", "prediction").agg(F.count(F.lit(1)).alias("n"))
    return per_value.select("l_discount", "n", F.round("prediction", 4).alias("prediction"))


@query("tree_fit_score")
def tree_fit_score(spark: SparkSession, directory: str) -> DataFrame:
    rows = spread(trips_view(spark, directory).withColumnRenamed("cnt", "label")).persist()
    train, test = hash_split(rows, "key")
    prepared = models.preparation(TRIP_FEATURES, 24).fit(train)
    model = models.fit_tree(prepared.transform(train), models.tree())
    metrics = cut(regression_metrics(model.transform(prepared.transform(test))))
    rows.unpersist()
    return metrics


def _grid_rows(spark: SparkSession, intercept: bool = True) -> list[tuple]:
    grid = models.elastic_net_grid(LinearRegression(), intercept=intercept)
    points = [{param.name: value for param, value in params.items()} for params in grid]
    return [(i, p["regParam"], p["elasticNetParam"], p.get("fitIntercept", True)) for i, p in enumerate(points)]


@query(
    "param_grid",
    f"""with r(reg_param) as (values {values((v,) for v in models.REG_PARAMS)}),
          e(elastic_net_param) as (values {values((v,) for v in models.ELASTIC_NET_PARAMS)}),
          i(fit_intercept) as (values (true), (false)),
          f as (select cast(l_orderkey % 3 as integer) as fold, count(*) as n_held from lineitem group by 1)
        select reg_param, elastic_net_param, fit_intercept, fold, n_held,
               cast((select count(*) from lineitem) - n_held as bigint) as n_train
        from r, e, i, f""",
)
def param_grid(spark: SparkSession, directory: str) -> DataFrame:
    """The tuning plan: every grid point with the rows each fold trains on and holds out."""
    rows = with_fold(read_table(spark, directory, "lineitem").select("l_orderkey"), "l_orderkey", 3)
    points = F.array(
        *[
            F.struct(
                F.lit(reg).alias("reg_param"), F.lit(mix).alias("elastic_net_param"),
                F.lit(intercept).alias("fit_intercept"),
            )
            for _, reg, mix, intercept in _grid_rows(spark)
        ]
    )
    total = rows.count()
    held = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n_held"))
    return held.select("fold", "n_held", (F.lit(total) - F.col("n_held")).alias("n_train"), F.inline(points))


def _elastic_net(spark: SparkSession, directory: str) -> DataFrame:
    view = spread(trips_view(spark, directory).withColumnRenamed("cnt", "label"))
    rows = with_fold(view, "key", 3).persist()
    try:
        tuned, grid = tune_linear(rows, TRIP_FEATURES, models.elastic_net_grid, "r2", 3)
    finally:
        rows.unpersist()
    return models.metrics_table(spark, grid, tuned.avgMetrics, tuned.stdMetrics)


def _elastic_net_grid() -> list[tuple[int, float, float, bool]]:
    return [
        (i, reg, mix, intercept) for i, (reg, mix, intercept) in enumerate(
            itertools.product(models.REG_PARAMS, models.ELASTIC_NET_PARAMS, (True, False))
        )
    ]


_ELASTIC_NET_SQL = job_rows.elastic_net_sql(job_rows.TRIP_ROWS_SQL, TRIP_FEATURES, "cnt", "key % 3", _elastic_net_grid())


@query(
    "elastic_net_cv",
    f"""{_ELASTIC_NET_SQL} select reg as reg_param, mix, with_intercept, round(avg(r2), 4) as r2
        from q join points using (point) group by 1, 2, 3""",
)
def elastic_net_cv(spark: SparkSession, directory: str) -> DataFrame:
    """Grid metrics from the moments of each fold, not from a pass per grid point."""
    return _elastic_net(spark, directory).select(
        F.col("regParam").alias("reg_param"), F.col("elasticNetParam").alias("mix"),
        F.col("fitIntercept").alias("with_intercept"), F.round("avg_metric", 4).alias("r2"),
    )


def _penalised_sql(
    regs: tuple[float, ...], mixes: tuple[float, ...], intercepts: tuple[bool, ...], fold: str = "l_orderkey % 3"
) -> str:
    """Tables up to ``q``: r2 of the penalised one-feature fit for each grid point and held-out fold, in closed form."""
    return f"""with d as (select cast({fold} as integer) as fold, {_PRICE} as x, {_CHARGED} as y from lineitem),
          h as (select fold, cast(count(*) as double) as n, sum(x) as sx, sum(y) as sy, sum(x * x) as sxx,
                  sum(y * y) as syy, sum(x * y) as sxy from d group by fold),
          t as (select sum(n) as n, sum(sx) as sx, sum(sy) as sy, sum(sxx) as sxx, sum(syy) as syy, sum(sxy) as sxy
                from h),
          m as (select h.fold, t.n - h.n as n, (t.sx - h.sx) / (t.n - h.n) as ex, (t.sy - h.sy) / (t.n - h.n) as ey,
                  (t.sxx - h.sxx) / (t.n - h.n) as exx, (t.syy - h.syy) / (t.n - h.n) as eyy,
                  (t.sxy - h.sxy) / (t.n - h.n) as exy from h, t),
          s as (select *, sqrt(exx - ex * ex) as dx, sqrt(eyy - ey * ey) as dy from m),
          r(reg_param) as (values {values((v,) for v in regs)}),
          e(mix) as (values {values((v,) for v in mixes)}),
          i(with_intercept) as (values {", ".join(f"({str(v).lower()})" for v in intercepts)}),
          b as (select fold, ex, ey, reg_param, mix, with_intercept,
                  greatest((exy - case when with_intercept then ex * ey else 0 end) / (dx * dy)
                           - mix * reg_param / dy, 0)
                  / ((exx - case when with_intercept then ex * ex else 0 end) / (dx * dx)
                     + (1 - mix) * reg_param / dy) * dy / dx as slope
                from s, r, e, i),
          a as (select *, case when with_intercept then ey - slope * ex else 0 end as base from b),
          q as (select a.fold, reg_param, mix, with_intercept,
                  1 - (syy - 2 * (base * sy + slope * sxy) + n * base * base + 2 * base * slope * sx
                       + slope * slope * sxx) / (syy - sy * sy / n) as r2
                from a join h on a.fold = h.fold)"""


_GRID_SQL = _penalised_sql(models.REG_PARAMS, models.ELASTIC_NET_PARAMS, (True, False))


@query(
    "elastic_net_cv_one_feature",
    f"{_GRID_SQL} select reg_param, mix, with_intercept, round(avg(r2), 5) as r2 from q group by 1, 2, 3",
)
def elastic_net_cv_one_feature(spark: SparkSession, directory: str) -> DataFrame:
    """The whole 36-point grid on one feature, where the penalised fit has a closed form."""
    rows = with_fold(spread(_charges(spark, directory)), "l_orderkey", 3).persist()
    tuned, grid = tune_linear(rows, ["price"], models.elastic_net_grid, "r2", 3)
    rows.unpersist()
    metrics = models.metrics_table(spark, grid, tuned.avgMetrics, tuned.stdMetrics)
    return metrics.select(
        F.col("regParam").alias("reg_param"), F.col("elasticNetParam").alias("mix"),
        F.col("fitIntercept").alias("with_intercept"), F.round("avg_metric", 5).alias("r2"),
    )


@query(
    "cv_best_row_one_feature",
    f"""{_GRID_SQL}, g as (select reg_param, mix, with_intercept, avg(r2) as r2 from q group by 1, 2, 3)
        select round(max(r2), 5) as r2 from g""",
)
def cv_best_row_one_feature(spark: SparkSession, directory: str) -> DataFrame:
    """The metric of the best grid point; several points agree in more digits than a fit has."""
    rows = with_fold(spread(_charges(spark, directory)), "l_orderkey", 3).persist()
    try:
        tuned, grid = tune_linear(rows, ["price"], models.elastic_net_grid, "r2", 3)
    finally:
        rows.unpersist()
    best = models.best_row(models.metrics_table(spark, grid, tuned.avgMetrics, tuned.stdMetrics), larger_is_better=True)
    return best.select(F.round("avg_metric", 5).alias("r2"))


def _ridge_rows(spark: SparkSession, directory: str) -> DataFrame:
    return models.assembler(["price"], "features").transform(_charges(spark, directory))


@query(
    "ridge_cv_one_feature",
    f"""{_penalised_sql(models.RIDGE_PAIR, (0.0,), (True,))}
        select reg_param, round(avg(r2), 5) as r2 from q group by 1""",
)
def ridge_cv_one_feature(spark: SparkSession, directory: str) -> DataFrame:
    """The two-point ridge grid by cross-validation over the rows themselves."""
    ready = with_fold(_ridge_rows(spark, directory), "l_orderkey", 3).select("features", "label", "fold").persist()
    regression = LinearRegression()
    grid = models.ridge_grid(regression)
    try:
        tuned = models.cross_validate(ready, regression, grid, "r2", 3)
    finally:
        ready.unpersist()
    metrics = models.metrics_table(spark, grid, tuned.avgMetrics, tuned.stdMetrics)
    return metrics.select(F.col("regParam").alias("reg_param"), F.round("avg_metric", 5).alias("r2"))


@query(
    "ridge_hold_out_one_feature",
    f"""{_penalised_sql(models.RIDGE_PAIR, (0.0,), (True,), "case when l_orderkey % 5 < 4 then 1 else 0 end")}
        , h2 as (select * from q where fold = 0)
        select reg_param, round(r2, 5) as r2 from h2""",
)
def ridge_hold_out_one_feature(spark: SparkSession, directory: str) -> DataFrame:
    """The same grid judged on one hold-out, which is drawn by key."""
    held = F.when(is_train("l_orderkey"), 1).otherwise(0).alias("fold")
    ready = _ridge_rows(spark, directory).select("features", "label", held).persist()
    regression = LinearRegression()
    grid = models.ridge_grid(regression)
    try:
        tuned = models.cross_validate(ready, regression, grid, "r2", 2, held=[0])
    finally:
        ready.unpersist()
    metrics = models.metrics_table(spark, grid, tuned.avgMetrics)
    return metrics.select(F.col("regParam").alias("reg_param"), F.round("avg_metric", 5).alias("r2"))


@query(
    "tree_stump_cv",
    """with d as (select l_orderkey % 3 as fold, l_discount as x, l_extendedprice * (1 - l_discount) as y from lineitem),
          g as (select fold, x, count(*) as n, sum(y) as s, sum(y * y) as ss from d group by 1, 2),
          f as (select distinct fold from g),
          tr as (select f.fold, g.x, sum(g.n) as n, sum(g.s) as s from f join g on g.fold <> f.fold group by 1, 2),
          t as (select fold, sum(n) as n, sum(s) as s from tr group by 1),
          c as (select a.fold, a.x as cut, sum(b.n) as ln, sum(b.s) as ls
                from tr a join tr b on a.fold = b.fold and b.x <= a.x group by 1, 2),
          best as (select c.fold, cut, ls / ln as lo, (t.s - ls) / (t.n - ln) as hi, row_number() over
                     (partition by c.fold order by ls * ls / ln + (t.s - ls) * (t.s - ls) / (t.n - ln) desc) as k
                   from c join t on c.fold = t.fold where ln < t.n),
          p as (select g.fold, g.n, g.s, g.ss, case when x <= cut then lo else hi end as p
                from g join best on g.fold = best.fold where k = 1),
          e as (select fold, sqrt(sum(ss - 2 * p * s + n * p * p) / sum(n)) as rmse from p group by 1)
        select cast(0 as integer) as point, round(avg(rmse), 3) as rmse from e""",
)
def tree_stump_cv(spark: SparkSession, directory: str) -> DataFrame:
    """A tree of depth one over the empty grid, by cross-validation."""
    price = F.col("l_extendedprice")
    lines = read_table(spark, directory, "lineitem").select(
        "l_orderkey", "l_discount", (price * (1 - F.col("l_discount"))).alias("label")
    )
    vectors = models.assembler(["l_discount"], "features").transform(with_fold(lines, "l_orderkey", 3))
    ready = vectors.select("features", "label", "fold").persist()
    grid = models.default_grid()
    try:
        tuned = models.cross_validate(ready, models.tree(max_depth=1), grid, "rmse", 3)
    finally:
        ready.unpersist()
    metrics = models.metrics_table(spark, grid, tuned.avgMetrics, tuned.stdMetrics)
    return metrics.select("point", F.round("avg_metric", 3).alias("rmse"))


@query("cv_best_row", f"{_ELASTIC_NET_SQL} select round(max(r2), 4) as r2 from (select avg(r2) as r2 from q group by point)")
def cv_best_row(spark: SparkSession, directory: str) -> DataFrame:
    """The metric of the best grid point; several points agree in more digits than a fit has."""
    best = models.best_row(_elastic_net(spark, directory), larger_is_better=True)
    return best.select(F.round("avg_metric", 4).alias("r2"))


_CHARGES_SQL = f"select l_orderkey, {_PRICE} as price, l_discount, {_CHARGED} as label from lineitem"


@query(
    "cv_metrics_table",
    job_rows.ridge_folds_sql(_CHARGES_SQL, ("price", "l_discount"), "label", "l_orderkey % 3", 3, models.RIDGE_PAIR),
)
def cv_metrics_table(spark: SparkSession, directory: str) -> DataFrame:
    """Grid metrics of cross-validation over the rows themselves."""
    rows = with_fold(spread(_charges(spark, directory)), "l_orderkey", 3)
    vectors = models.assembler(["price", "l_discount"], "features").transform(rows)
    ready = vectors.select("features", "label", "fold").persist()
    regression = LinearRegression()
    grid = models.ridge_grid(regression)
    try:
        tuned = models.cross_validate(ready, regression, grid, "r2", 3)
    finally:
        ready.unpersist()
    metrics = models.metrics_table(spark, grid, tuned.avgMetrics, tuned.stdMetrics)
    return metrics.withColumns({c: F.round(c, 7) for c in ("avg_metric", "std_metric")})


@query("tree_cv")
def tree_cv(spark: SparkSession, directory: str) -> DataFrame:
    view = spread(trips_view(spark, directory).withColumnRenamed("cnt", "label"))
    rows = shared_table(equal_rows(with_fold(view, "key", 3), [*TRIP_FEATURES, "fold"]), "groups")
    prepared = models.preparation(TRIP_FEATURES, 24).fit(rows)
    ready = spread(prepared.transform(rows).select("features", "label", "fold", "n_rows", "label_var")).persist()
    grid = models.default_grid()
    try:
        tuned = models.cross_validate(ready, models.tree(grouped=True), grid, "rmse", 3, grouped=True)
    finally:
        ready.unpersist()
    return models.metrics_table(spark, grid, tuned.avgMetrics, tuned.stdMetrics)


@query("train_validation_split", job_rows.hold_out_sql(job_rows.TRIP_ROWS_SQL, TRIP_FEATURES, "cnt", models.RIDGE_PAIR))
def train_validation_split(spark: SparkSession, directory: str) -> DataFrame:
    """A ridge on all features tuned on a hold-out drawn by key, as the last stage of a pipeline."""
    train, test = hash_split(trips_view(spark, directory).withColumnRenamed("cnt", "label"), "key")
    regression = LinearRegression()
    tuner = models.KeyedHoldOut(regression, models.ridge_grid(regression), "key", ratio=0.75)
    model = models.full_pipeline(TRIP_FEATURES, 4, tuner).fit(train)
    metrics = models.metrics_table(spark, models.ridge_grid(regression), model.stages[-1].validationMetrics)
    test_r2 = regression_metrics(model.transform(test)).first()["r2"]
    return metrics.select(
        "point", "regParam", F.round("avg_metric", 7).alias("avg_metric"), F.round(F.lit(test_r2), 7).alias("r2_test")
    )


_MEANS = ("hr", "weathersit", "temp", "atemp", "hum", "windspeed")
_NINE = ("yr", "mnth", "hr", "workingday", "weathersit", "temp", "atemp", "hum", "windspeed")
_EIGHT = tuple(c for c in _NINE if c != "mnth")
_WHOLE_YEAR = tuple(c for c in _NINE if c != "temp")
_WITHOUT_TEMPERATURES = tuple(c for c in _NINE if c not in ("temp", "atemp"))
_YEAR_MEANS = ("mnth", "hr", "weathersit", "atemp", "hum", "windspeed")
_SEVEN = ("yr", "hr", "workingday", "weathersit", "atemp", "hum", "windspeed")

#: The composite jobs by name.
JOBS = {
    "job_linear_raw": jobs.RegressionJob(TRIP_FEATURES, "linear", "full", "r2", 3, 10),
    "job_linear_hour_rank": jobs.RegressionJob(
        TRIP_FEATURES, "linear", "full", "r2", 3, 10, fixed={"hr": fixed_values.HOUR_RANK}
    ),
    "job_linear_hour_month_rank": jobs.RegressionJob(
        TRIP_FEATURES, "linear", "half", "r2", 3, 10,
        fixed={"hr": fixed_values.HOUR_RANK, "mnth": fixed_values.MONTH_RANK},
    ),
    "job_linear_month_means": jobs.RegressionJob(
        _SEVEN, "linear", "half", "r2", 3, 2, month=6, means=("hr", "weathersit", "atemp", "hum", "windspeed")
    ),
    "job_linear_year_means": jobs.RegressionJob(
        _WHOLE_YEAR, "linear", "half", "r2", 3, 13, means=_YEAR_MEANS
    ),
    "job_tree_raw": jobs.RegressionJob(TRIP_FEATURES, "tree", "default", "r2", 3, 24),
    "job_tree_means": jobs.RegressionJob(
        _WITHOUT_TEMPERATURES, "tree", "default", "rmse", 3, 24, means=("mnth", "hr", "weathersit", "hum", "windspeed")
    ),
    "job_tree_fixed_tables": jobs.RegressionJob(
        _NINE, "tree", "default", "rmse", 10, 24,
        fixed={
            "hr": fixed_values.HOUR_RANK, "mnth": fixed_values.MONTH_RANK_FRACTIONAL,
            "weathersit": fixed_values.WEATHER_CODE,
            "temp": fixed_values.TEMPERATURE_RANK, "atemp": fixed_values.FELT_TEMPERATURE_RANK,
            "hum": fixed_values.HUMIDITY_RANK, "windspeed": fixed_values.WIND_BIN,
        },
        on_unknown="error",
    ),
    "job_tree_month_means": jobs.RegressionJob(
        _SEVEN, "tree", "default", "rmse", 10, month=5, means=("hr", "weathersit", "atemp", "hum", "windspeed")
    ),
    "job_tree_month_hour_rank": jobs.RegressionJob(
        _NINE, "tree", "default", "rmse", 10, month=5, fixed={"hr": fixed_values.HOUR_RANK}
    ),
    "job_tree_year_means": jobs.RegressionJob(_WHOLE_YEAR, "tree", "default", "rmse", 10, 2, means=_YEAR_MEANS),
    "job_tree_month_split_first": jobs.RegressionJob(
        _EIGHT, "tree", "default", "rmse", 10, 12, month=6, means=_MEANS
    ),
}

#: The job to show: June, split first, six columns mean-encoded on training rows, indexed, tree.
FLAGSHIP = "job_tree_month_split_first"


def _register(name: str, job: jobs.RegressionJob) -> None:
    @query(name)
    def quality(spark: SparkSession, directory: str) -> DataFrame:
        return jobs.run_job(trips_view(spark, directory), job).quality


for _name, _job in JOBS.items():
    _register(_name, _job)
job_rows.register_rows(JOBS)


@query(
    "job_band_report",
    """with t as (select l_orderkey as key, l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000.0::double as label
            from lineitem where month(l_shipdate) = 6 and l_orderkey % 5 >= 4),
          r as (select key, label, row_number() over (order by label, key) as rnk from t), n as (select count(*) as c from t)
        select 'first' as band, key, label, rnk from r where rnk <= 100 union all
        select 'middle', key, label, rnk from r, n where rnk between c // 2 - 49 and c // 2 + 50 union all
        select 'last', key, label, rnk from r, n where rnk > c - 100""",
)
def job_band_report(spark: SparkSession, directory: str) -> DataFrame:
    """First, middle and last 100 scored rows of the main job."""
    run = jobs.run_job(trips_view(spark, directory), JOBS[FLAGSHIP])
    return jobs.band_report(run.scored).drop("prediction")


def _fit_report(rows: DataFrame, features: list[str], digits: int = 4) -> DataFrame:
    """Least squares on all rows: rmse, r2 and residual spread, in as many digits as a fit has."""
    prepared, model = jobs.fit_ols(rows, features)
    scored = residuals(model.transform(prepared.transform(rows)))
    spread_of = [F.round(F.min("residual"), digits).alias("min_residual"), F.round(F.max("residual"), digits).alias("max_residual")]
    return scored.agg(*_rounded_metrics(), *spread_of)


def _group_report(rows: DataFrame, features: list[str], digits: int) -> DataFrame:
    """`_fit_report` of rows with few different features, read once: their groups hold all that it needs."""
    groups = shared_table(equal_rows(rows, features, extremes=True), "groups")
    prepared = models.preparation(features, None).fit(groups)
    ready = prepared.transform(groups)
    model = LinearRegression(featuresCol="features", labelCol="label", weightCol="n_rows", solver="normal").fit(ready)
    centre = groups.agg(F.sum(F.col("label") * F.col("n_rows")) / F.sum("n_rows")).first()[0]
    n, rmse, r2 = group_metric_columns(centre=centre or 0.0)
    return model.transform(ready).agg(
        n, F.round(rmse, 5).alias("rmse"), F.round(r2, 7).alias("r2"),
        F.round(F.min(F.col("label_min") - F.col("prediction")), digits).alias("min_residual"),
        F.round(F.max(F.col("label_max") - F.col("prediction")), digits).alias("max_residual"),
    )


def _rounded_metrics() -> list:
    n, rmse, r2 = metric_columns()
    return [n, F.round(rmse, 5).alias("rmse"), F.round(r2, 7).alias("r2")]


@query("job_linear_all_rows", f"{job_rows.least_squares_sql(job_rows.TRIP_ROWS_SQL, TRIP_FEATURES, 'cnt')} {job_rows.report_sql(4)}")
def job_linear_all_rows(spark: SparkSession, directory: str) -> DataFrame:
    return _fit_report(trips_view(spark, directory).withColumnRenamed("cnt", "label"), list(TRIP_FEATURES))


@query(
    "job_linear_train_test",
    job_rows.least_squares_sql(job_rows.TRIP_ROWS_SQL, TRIP_FEATURES, "cnt", "key % 5 < 4", "key % 5 >= 4") + job_rows.QUALITY_SQL,
)
def job_linear_train_test(spark: SparkSession, directory: str) -> DataFrame:
    train, test = hash_split(trips_view(spark, directory).withColumnRenamed("cnt", "label"), "key")
    model = models.full_pipeline(TRIP_FEATURES, 4, LinearRegression()).fit(train)
    return model.transform(test).agg(*_rounded_metrics())


def _purchase_codes() -> list:
    return [
        gender_code("Gender").alias("gender"),
        age_code("Age").alias("age"),
        F.col("Occupation").cast("double").alias("occupation"),
        city_code("City_Category").alias("city"),
        topcoded_years("Stay_In_Current_City_Years").alias("years"),
        marital_code("Marital_Status").alias("marital"),
    ]


_PURCHASE_FEATURES = ["gender", "age", "occupation", "city", "years", "marital"]


@query(
    "job_purchases_per_user",
    job_rows.least_squares_sql(job_rows.USER_ROWS_SQL, _PURCHASE_FEATURES, "total") + job_rows.report_sql(1),
)
def job_purchases_per_user(spark: SparkSession, directory: str) -> DataFrame:
    """Totals per user, recoded attributes, least squares."""
    attributes = ["Gender", "Age", "Occupation", "City_Category", "Stay_In_Current_City_Years", "Marital_Status"]
    users = sum_per_user(purchases_view(spark, directory), "User_ID", "Purchase", attributes, scale=2)
    rows = users.select(*_purchase_codes(), F.col("total").cast("double").alias("label"))
    return _group_report(rows, _PURCHASE_FEATURES, 1)


@query(
    "job_purchases_filled",
    job_rows.least_squares_sql(
        job_rows.PURCHASE_ROWS_SQL, [*_PURCHASE_FEATURES, *(f"product_category_{i}" for i in (1, 2, 3))], "purchase"
    ) + job_rows.report_sql(0),
)
def job_purchases_filled(spark: SparkSession, directory: str) -> DataFrame:
    """Single purchases with empty categories filled, recoded attributes, least squares."""
    categories = [f"Product_Category_{i}" for i in (1, 2, 3)]
    rows = purchases_view(spark, directory).select(
        *_purchase_codes(), *[fill_empty(c).alias(c.lower()) for c in categories], F.col("Purchase").alias("label")
    )
    # occupation and first category agree here, and such a fit is iterated: fewer digits are certain
    return _group_report(rows, [*_PURCHASE_FEATURES, *[c.lower() for c in categories]], 0)
