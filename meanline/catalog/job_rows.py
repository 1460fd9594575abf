"""What the composite jobs feed to their models and what least squares must give, next to exact SQL.

Spark ML's fits cannot be written as SQL, but all before them can: the rows of both parts and their codes.
Least squares can too: the normal equations are solved by elimination in a recursive query.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meanline.catalog.registry import query
from meanline.functions import calendar, fixed_values
from meanline.plans import jobs
from meanline.sources.views import BASE_YEAR, TRIP_FEATURES, trips_view


def listed_sql(table: Mapping[float, float], step: str) -> str:
    """The value at a place in the ascending list of a fixed table's values; places beyond it take the last."""
    readings = sorted(table)
    return f"({readings}::double[])[cast(least(greatest({step}, 0), {len(readings) - 1}) as integer) + 1]"


#: The hourly-shaped rows as a table expression.
TRIPS_SQL = f"""t0 as (select *, month(l_shipdate) * 100 + day(l_shipdate) as md from lineitem),
    trips as (select l_orderkey as key, month(l_shipdate) as month_of_date,
      case when md >= 1221 or md < 321 then 1 when md < 621 then 2 when md < 923 then 3 else 4 end as season,
      year(l_shipdate) - {BASE_YEAR} as yr, month(l_shipdate) as mnth, l_linenumber as hr,
      cast(md in {calendar.FIXED_HOLIDAYS} as integer) as holiday, dayofweek(l_shipdate) as weekday,
      cast(dayofweek(l_shipdate) between 1 and 5 and md not in {calendar.FIXED_HOLIDAYS} as integer) as workingday,
      case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end as weathersit,
      round(l_quantity / 50, 2) as temp, {listed_sql(fixed_values.FELT_TEMPERATURE_RANK, "floor(l_extendedprice / 1600)")} as atemp,
      round(l_discount * 10, 2) as hum, {listed_sql(fixed_values.WIND_BIN, "round(l_tax * 100)")} as windspeed,
      l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000.0::double as cnt from t0)"""


def _fixed_sql(column: str, table: Mapping[float, float]) -> str:
    cases = " ".join(f"when {float(k)!r}::double then {float(v)!r}::double" for k, v in table.items())
    return f"case cast({column} as double) {cases} else 0 end as {column}"


def parts_sql(job: jobs.RegressionJob) -> str:
    """(part, feature, n, total) of a job's encoded rows."""
    chosen = ", ".join(_fixed_sql(c, job.fixed[c]) if c in job.fixed else c for c in job.features)
    month = f"where month_of_date = {job.month}" if job.month is not None else ""
    tables = [f"r as (select key % 5 < 4 as train, cnt as label, {chosen} from trips {month})"]
    joins, columns = [], []
    for c in job.features:
        if c in job.means:
            tables.append(f"m_{c} as (select {c} as k, avg(label) as code from r where train group by 1)")
            joins.append(f"left join m_{c} on r.{c} = m_{c}.k")
            columns.append(f"coalesce(m_{c}.code, 0) as {c}")
        else:
            columns.append(f"r.{c}")
    tables.append(f"e as (select train, label, {', '.join(columns)} from r {' '.join(joins)})")
    tall = " union all ".join(
        f"select train, '{c}' as feature, count(*) as n, round(sum(cast({c} as double)), 3) as total from e group by train"
        for c in ("label", *job.features)
    )
    return f"with {TRIPS_SQL}, {', '.join(tables)} select case when train then 'train' else 'test' end as part, feature, n, total from ({tall})"


def encoded_totals(df: DataFrame, job: jobs.RegressionJob) -> DataFrame:
    """(part, feature, n, total): rows and sums of every column of both parts, as the model gets them."""
    parts = []
    for name, part in zip(("train", "test"), jobs.encoded_parts(jobs.select_rows(df, job, "cnt"), job), strict=True):
        entries = [
            F.struct(F.lit(c).alias("feature"), F.count(c).alias("n"), F.round(F.sum(F.col(c).cast("double")), 3).alias("total"))
            for c in ("label", *job.features)
        ]
        parts.append(part.agg(F.array(*entries).alias("s")).select(F.lit(name).alias("part"), F.inline("s")))
    return parts[0].unionByName(parts[1])


def register_rows(all_jobs: Mapping[str, jobs.RegressionJob]) -> None:
    """A query ``rows_of_<job>`` for each job."""

    def register(name: str, job: jobs.RegressionJob) -> None:
        @query(f"rows_of_{name}", parts_sql(job))
        def rows(spark: SparkSession, directory: str) -> DataFrame:
            return encoded_totals(trips_view(spark, directory), job)

    for name, job in all_jobs.items():
        register(name, job)


def least_squares_sql(
    rows: str, features: Sequence[str], label: str, train: str = "true", judged: str = "true", ridge: float = 0.0
) -> str:
    """Tables up to ``scored`` (label, residual): least squares on the ``train`` rows, residuals of the ``judged`` rows.

    With ``ridge``, slopes of the standardized features are held back by so much of the label's deviation.
    The correlations of the features are eliminated column by column; a column that depends on those before
    it, or is constant, has no pivot left and takes no part.
    """
    p = len(features)
    names = [*features, label]
    x = [f"cast({c} as double)" for c in names]
    scale = [f"nullif(stddev_pop({v}), 0)" for v in x]
    held_back = lambda i, j: f" + {ridge!r}::double / {scale[p]}" if ridge and i == j else ""
    lines = ", ".join(
        "[" + ", ".join(
            f"coalesce(covar_pop({x[i]}, {x[j]}) / ({scale[i]} * {scale[j]}){held_back(i, j)}, 0)" for j in range(p + 1)
        ) + "]"
        for i in range(p)
    )
    means = ", ".join(f"avg({v})" for v in x)
    spreads = ", ".join(f"coalesce({s}, 1)" for s in scale)
    slopes = " + ".join(f"b.slope[{i + 1}] * (({x[i]}) - s.mean[{i + 1}])" for i in range(p))
    return f"""with recursive d as ({rows}),
      s as (select [{means}] as mean, [{spreads}] as spread, [{lines}] as m from d where {train}),
      g(k, m) as (select 1, m from s union all
        select k + 1, list_transform(m, lambda line, i: case when i = k or abs(m[k][k]) < 1e-9 then line
          else list_transform(line, lambda v, j: v - m[k][j] * line[k] / m[k][k]) end) from g where k <= {p}),
      b as (select list_transform(g.m, lambda line, i: case when abs(line[i]) < 1e-9 then 0
          else line[{p + 1}] / line[i] * s.spread[{p + 1}] / s.spread[i] end) as slope from g, s where k = {p + 1}),
      scored as (select cast({label} as double) as label,
        cast({label} as double) - s.mean[{p + 1}] - ({slopes}) as residual from d, s, b where {judged})"""


_METRICS_SQL = """count(*) as n, round(sqrt(avg(residual * residual)), 5) as rmse,
    round(1 - sum(residual * residual) / (var_pop(label) * count(*)), 7) as r2"""
#: Appended to `least_squares_sql`: the quality on the judged rows.
QUALITY_SQL = f"select {_METRICS_SQL} from scored"


def report_sql(digits: int) -> str:
    """Appended to `least_squares_sql`: the report of a fit."""
    return f"""select {_METRICS_SQL}, round(min(residual), {digits}) as min_residual,
        round(max(residual), {digits}) as max_residual from scored"""


TRIP_ROWS_SQL = f"select * from (with {TRIPS_SQL} select key, cnt, {', '.join(TRIP_FEATURES)} from trips)"
_CODES_SQL = """case when {gender} = 'F' then 1.0 else 2.0 end as gender,
    case when {customer} % 7 < 4 then {customer} % 7 + 1.0 when {customer} % 7 < 6 then 5.0 else 6.0 end as age,
    {line} as occupation, case {flag} when 'A' then 1.0 when 'B' then 2.0 else 3.0 end as city,
    least({line}, 4) + 1.0 as years, case when {status} = 'F' then 1.0 else 2.0 end as marital"""
_LETTER = "translate(l_returnflag, 'NR', 'CB')"
PURCHASE_ROWS_SQL = f"""select {_CODES_SQL.format(gender="o_orderstatus", customer="o_custkey", line="l_linenumber", flag=_LETTER, status="l_linestatus")},
    l_linenumber as product_category_1, case when l_returnflag = 'N' then 0 else l_linenumber end as product_category_2,
    case when l_linestatus = 'O' then 0 else 7 end as product_category_3, l_extendedprice as purchase
    from lineitem join orders on l_orderkey = o_orderkey"""
# the smallest stay as text is that of the smallest line, and of the marital codes that of 'F'
USER_ROWS_SQL = f"""select {_CODES_SQL.format(gender="gender", customer="user_id", line="line", flag="flag", status="status")}, total from (
    select o_custkey as user_id, min(o_orderstatus) as gender, min(l_linenumber) as line, min({_LETTER}) as flag,
      min(l_linestatus) as status, cast(sum(cast(l_extendedprice as decimal(18, 2))) as double) as total
    from lineitem join orders on l_orderkey = o_orderkey group by 1)"""


def hold_out_sql(rows: str, features: Sequence[str], label: str, regs: Sequence[float]) -> str:
    """(point, regParam, avg_metric, r2_test): ridges judged on every fourth key of the training rows, the best on the test rows."""
    train, test = "key % 5 < 4", "key % 5 >= 4"

    def r2(fitted: str, judged: str, ridge: float) -> str:
        tables = least_squares_sql(rows, features, label, fitted, judged, ridge)
        return f"({tables} select 1 - sum(residual * residual) / (var_pop(label) * count(*)) as r2 from scored)"

    points = " union all ".join(
        f"select {i} as point, {reg!r}::double as regParam, h.r2 as avg_metric, t.r2 as r2 from"
        f" {r2(f'{train} and key % 4 < 3', f'{train} and key % 4 >= 3', reg)} h, {r2(train, test, reg)} t"
        for i, reg in enumerate(regs)
    )
    return f"""with points as ({points}) select cast(point as integer) as point, regParam, round(avg_metric, 7) as avg_metric,
        round((select r2 from points order by avg_metric desc, point limit 1), 7) as r2_test from points"""


def ridge_folds_sql(rows: str, features: Sequence[str], label: str, fold: str, folds: int, regs: Sequence[float]) -> str:
    """(point, regParam, elasticNetParam, fitIntercept, avg_metric, std_metric): r2 of ridges over folds, by elimination."""
    parts = []
    for i, reg in enumerate(regs):
        for f in range(folds):
            tables = least_squares_sql(rows, features, label, f"{fold} <> {f}", f"{fold} = {f}", reg)
            parts.append(
                f"select {i} as point, {reg!r}::double as reg, r2 from"
                f" ({tables} select 1 - sum(residual * residual) / (var_pop(label) * count(*)) as r2 from scored)"
            )
    return f"""select cast(point as integer) as point, reg as "regParam", cast(null as double) as "elasticNetParam",
        cast(null as boolean) as "fitIntercept", round(avg(r2), 7) as avg_metric, round(stddev_pop(r2), 7) as std_metric
        from ({" union all ".join(parts)}) group by point, reg"""


#: Rounds of coordinate descent in `elastic_net_sql`.
SWEEPS = 150


def elastic_net_sql(
    rows: str, features: Sequence[str], label: str, fold: str, points: Sequence[tuple[int, float, float, bool]]
) -> str:
    """(point, fold, r2) of elastic nets over folds: coordinate descent on the moments, one coordinate a recursion step.

    ``points`` are (point, strength, mix, with intercept).  Slopes are those of standardized columns, centred
    if there is an intercept; a constant column takes no part.
    """
    p, names = len(features), [*features, label]
    x = [f"cast({c} as double)" for c in names]
    sums = ", ".join(f"sum({v})" for v in x)
    products = ", ".join("[" + ", ".join(f"sum({x[i]} * {x[j]})" for j in range(p + 1)) + "]" for i in range(p + 1))
    listed = ", ".join(f"({i}, {reg!r}::double, {mix!r}::double, {str(intercept).lower()})" for i, reg, mix, intercept in points)
    return f"""with recursive d as (select {fold} as fold, * from ({rows})),
      h as materialized (select fold, cast(count(*) as double) as n, [{sums}] as s, [{products}] as ss from d group by fold),
      tr as (select a.fold, sum(b.n) as n, [{", ".join(f"sum(b.s[{i + 1}])" for i in range(p + 1))}] as s,
        [{", ".join("[" + ", ".join(f"sum(b.ss[{i + 1}][{j + 1}])" for j in range(p + 1)) + "]" for i in range(p + 1))}] as ss
        from h a join h b on a.fold <> b.fold group by a.fold),
      sd as (select *, [{", ".join(f"sqrt(greatest(ss[{i + 1}][{i + 1}] / n - (s[{i + 1}] / n) * (s[{i + 1}] / n), 0))" for i in range(p + 1))}] as sd from tr),
      points(point, reg, mix, with_intercept) as (values {listed}),
      m as materialized (select point, fold, reg / sd[{p + 1}] as strength, mix, with_intercept, n, s, sd,
        list_transform(ss, lambda line, i: list_transform(line, lambda v, j: case when sd[i] < 1e-9 or sd[j] < 1e-9 then 0
          else (v / n - case when with_intercept then (s[i] / n) * (s[j] / n) else 0 end) / (sd[i] * sd[j]) end)) as c
        from sd, points),
      walk(point, fold, k, b) as (select point, fold, 0, list_transform(range({p}), lambda i: 0.0::double) from m union all
        select point, fold, k + 1, list_transform(b, lambda v, i: case when i <> k % {p} + 1 or c[i][i] = 0 then v
          else sign(rest) * greatest(abs(rest) - mix * strength, 0) / (c[i][i] + (1 - mix) * strength) end)
        from (select w.point, w.fold, w.k, w.b, m.c, m.strength, m.mix, m.c[w.k % {p} + 1][{p + 1}] - list_sum(list_transform(w.b,
            lambda v, j: case when j = w.k % {p} + 1 then 0 else v * m.c[w.k % {p} + 1][j] end)) as rest
          from walk w join m using (point, fold) where w.k < {SWEEPS * p})),
      u as (select point, fold, with_intercept, m.n, m.s, list_append(list_transform(b, lambda v, i: case when m.sd[i] < 1e-9 then 0
          else -v * m.sd[{p + 1}] / m.sd[i] end), 1) as u from walk join m using (point, fold) where k = {SWEEPS * p}),
      v as (select *, case when with_intercept then list_dot_product(u, s) / n else 0 end as base from u),
      q as (select v.point, v.fold, 1 - (list_dot_product(v.u, list_transform(h.ss, lambda line: list_dot_product(line, v.u)))
          - 2 * base * list_dot_product(v.u, h.s) + h.n * base * base)
          / (h.ss[{p + 1}][{p + 1}] - h.s[{p + 1}] * h.s[{p + 1}] / h.n) as r2 from v join h using (fold))"""
