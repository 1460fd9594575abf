"""Column studies: how the mean label moves with the values of a column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meanline.functions.fixed_values import MONTH_DAYS
from meanline.operators.order import exact_quantiles

#: The columns a value of any column may be keyed by, and the types that use them.
KEY_TYPES = {"num_key": "double", "int_key": "bigint", "text_key": "string"}
_FRACTIONAL = (T.FloatType, T.DoubleType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def mean_by_key(df: DataFrame, key: str | Column, label: str, name: str = "key") -> DataFrame:
    """(key, mean_label, n): map-side partial aggregation, one shuffle of distinct keys.

    With an integer or decimal label the sums are exact, so means (and any order
    built on them) are the same bits whatever the order of addition.
    """
    value = F.col(key) if isinstance(key, str) else key
    mean = F.sum(label).cast("double") / F.nullif(F.count(label), F.lit(0))
    return df.groupBy(value.alias(name)).agg(mean.alias("mean_label"), F.count(F.lit(1)).alias("n"))


def steady(value: str | Column, digits: int = 12) -> Column:
    """A double to ``digits`` significant digits: the last bits of a distributed sum depend on the order of addition."""
    value = F.col(value) if isinstance(value, str) else value
    return F.format_string(f"%.{digits - 1}e", value).cast("double")


def study_by_mean(df: DataFrame, key: str | Column, label: str, name: str = "key") -> DataFrame:
    """A study in ascending order of mean (to 12 significant digits), ties by key."""
    return mean_by_key(df, key, label, name).orderBy(steady("mean_label"), name)


def study_by_key(df: DataFrame, key: str | Column, label: str, name: str = "key") -> DataFrame:
    """A study in ascending order of key."""
    return mean_by_key(df, key, label, name).orderBy(name)


def key_slot(df: DataFrame, column: str) -> str:
    """Which key column holds the values of ``column``: fractions, integers or anything else as text."""
    kind = df.schema[column].dataType
    return "num_key" if isinstance(kind, _FRACTIONAL) else "int_key" if isinstance(kind, _INTEGRAL) else "text_key"


def key_value(df: DataFrame, column: str) -> Column:
    """The values of ``column`` in the type of their key column."""
    return F.col(f"`{column}`").cast(KEY_TYPES[key_slot(df, column)])


def unpivoted(df: DataFrame, columns: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, num_key, int_key, text_key, _y): one row for each row and column, in the same stage."""
    entries = []
    for column in columns:
        own = key_slot(df, column)
        entries.append(F.lit(column))
        entries += [key_value(df, column) if slot == own else F.lit(None).cast(kind) for slot, kind in KEY_TYPES.items()]
    return df.select(
        *by, F.col(label).alias("_y"), F.stack(F.lit(len(columns)), *entries).alias("feature", *KEY_TYPES)
    )


def multi_column_study(
    df: DataFrame, columns: Sequence[str], label: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Studies of many columns in one pass: (feature, num_key, int_key, text_key, sum_label, n, mean_label).

    Each row is unpivoted into one entry per column and summed up before the
    shuffle, so what moves is the distinct keys, whatever the number of rows.
    ``weight`` names the number of rows that a row with their mean label stands for.
    """
    tall = unpivoted(df, columns, label, [*by, weight] if weight else by)
    total, n = label_sums(weight)
    grouped = tall.groupBy(*by, "feature", *KEY_TYPES).agg(total.cast("double").alias("sum_label"), n.alias("n"))
    return grouped.withColumn("mean_label", F.col("sum_label") / F.nullif(F.col("n"), F.lit(0)))


def label_sums(weight: str | None) -> tuple[Column, Column]:
    """Sum and number of the labels of an unpivoted table."""
    if weight is None:
        return F.sum("_y"), F.count("_y")
    return F.sum(F.col("_y") * F.col(weight)), F.coalesce(F.sum(F.when(F.col("_y").isNotNull(), F.col(weight))), F.lit(0))


def month_mean_per_day(
    df: DataFrame, date: str, label: str, days: Mapping[int, float] = MONTH_DAYS
) -> DataFrame:
    """(mnth, n, n_days, per_row_day, per_day) per calendar month.

    ``per_row_day`` divides the total by rows times the nominal days of the
    month; ``per_day`` divides it by the dates that occur.  Rows are first summed
    per date, so no distinct aggregate is needed.
    """
    daily = df.groupBy(F.to_date(date).alias("_day")).agg(
        F.sum(label).alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    nominal = F.create_map(*[F.lit(v) for month, n in days.items() for v in (month, float(n))])
    monthly = daily.groupBy(F.month("_day").alias("mnth")).agg(
        F.sum("_sum").alias("_sum"), F.sum("_n").alias("n"), F.count(F.lit(1)).alias("n_days")
    )
    return monthly.select(
        "mnth", "n", "n_days",
        (F.col("_sum").cast("double") / (F.col("n") * nominal[F.col("mnth")])).alias("per_row_day"),
        (F.col("_sum").cast("double") / F.col("n_days")).alias("per_day"),
    )


def summary_profile(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float] = (0.25, 0.5, 0.75), *, exact: bool = True
) -> DataFrame:
    """One row per column: n, mean, stddev, min, the wanted quantiles, max.

    Exact quantiles come from narrowing passes shared by all columns; with
    ``exact=False`` one sketch per column is taken in the same single pass as the
    other figures.
    """
    names = [f"p{round(fraction * 100)}" for fraction in fractions]
    quantiles = exact_quantiles(df, columns, fractions) if exact else {}
    entries = []
    for column in columns:
        value = F.col(f"`{column}`").cast("double")
        if exact:
            places = [F.lit(q).cast("double").alias(name) for q, name in zip(quantiles[column], names)]
        else:
            sketch = F.percentile_approx(value, list(fractions), 10_000)
            places = [sketch[i].alias(name) for i, name in enumerate(names)]
        entries.append(
            F.struct(
                F.lit(column).alias("feature"), F.count(value).alias("n"), F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("stddev"), F.min(value).alias("min"), *places,
                F.max(value).alias("max"),
            )
        )
    return df.agg(F.array(*entries).alias("_s")).select(F.inline("_s"))


#: Size of the quantile sketches, and the error of a rank as a share of all rows that one of half the size keeps to.
SKETCH_SIZE, RANK_ERROR = 400, 0.0165


def sketched_by(df: DataFrame, columns: Sequence[str], by: Mapping[str, Column]) -> DataFrame:
    """(by, feature, n, sum_value, min, max, sketch): one row per period and column, of a bounded size each.

    Such rows are kept instead of the data: profiles of any periods come from merging theirs, see
    `merged_profile`.  Nulls and NaNs are left out.  One pass over the rows.
    """
    entries = []
    for column in columns:
        value = F.col(f"`{column}`").cast("double")
        entries += [F.lit(column), F.when(~F.isnan(value), value)]
    tall = df.select(*[period.alias(name) for name, period in by.items()], F.stack(F.lit(len(columns)), *entries).alias("feature", "v"))
    return tall.where(F.col("v").isNotNull()).groupBy(*by, "feature").agg(
        F.count("v").alias("n"), F.sum("v").alias("sum_value"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.kll_sketch_agg_double("v", F.lit(SKETCH_SIZE)).alias("sketch"),
    )


def merged_profile(sketches: DataFrame, fractions: Sequence[float] = (0.25, 0.5, 0.75), by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, n, n_periods, mean, min, max, quantiles): the rows of `sketched_by` put together, without the data."""
    merged = sketches.groupBy(*by, "feature").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_periods"), (F.sum("sum_value") / F.sum("n")).alias("mean"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch").alias("_sketch"),
    )
    wanted = F.array(*map(F.lit, map(float, fractions)))
    return merged.withColumn("quantiles", F.kll_sketch_get_quantile_double("_sketch", wanted)).drop("_sketch")


def rank_errors(df: DataFrame, profile: DataFrame, fractions: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(feature, fraction, value, error): how far the exact ranks of a profile's quantiles are from the wanted ones.

    Errors are shares of all rows; one pass counts the rows below and up to every quantile.
    """
    places = [
        (row["feature"], fraction, float(value), row["n"])
        for row in profile.select("feature", "n", "quantiles").collect()  # one row per column
        for fraction, value in zip(fractions, row["quantiles"], strict=True)
    ]
    counts = []
    for i, (feature, _, value, _) in enumerate(places):
        v = F.col(f"`{feature}`").cast("double")
        counts += [
            F.count_if(~F.isnan(v) & (v < F.lit(value))).alias(f"less_{i}"),
            F.count_if(~F.isnan(v) & (v <= F.lit(value))).alias(f"upto_{i}"),
        ]
    row = df.agg(F.count(F.lit(1)), *counts).first()
    found = []
    for i, (feature, fraction, value, n) in enumerate(places):
        rank = fraction * n
        found.append((feature, float(fraction), value, max(0.0, row[f"less_{i}"] - rank, rank - row[f"upto_{i}"]) / n))
    return df.sparkSession.createDataFrame(found, "feature string, fraction double, value double, error double")
