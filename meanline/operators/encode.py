"""Encoders fitted from data: a column value becomes its mean label, rank or bin.

Fitting is one pass over the training rows for all columns.  Applying is a left
join per column: a broadcast one while the fitted table is measured to be small,
otherwise one shuffle join beside which frequent keys are broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
    MLWritable, MLWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meanline.operators.frequent import frequent_keys
from meanline.operators.order import WINDOW_ROWS, global_rank
from meanline.operators.study import KEY_TYPES, key_slot, key_value, label_sums, multi_column_study, steady, unpivoted
from meanline.sources.storage import cut

#: Lookup sides are broadcast up to this many rows each and this many bytes together.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class Size:
    """Measured extent of one column's part of an encoder."""

    n_keys: int
    n_rows: int
    sum_label: float
    key_bytes: int

    @property
    def bytes(self) -> int:
        return self.key_bytes + 32 * self.n_keys


@dataclass(frozen=True)
class Encoding:
    """A fitted encoder: table (feature, num_key, int_key, text_key, mean_label, n, code)."""

    table: DataFrame
    sizes: Mapping[str, Size]

    def save(self, path: str) -> None:
        """Keep the fitted table, to be applied by later jobs."""
        self.table.write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Encoding:
        table = spark.read.parquet(path)
        return Encoding(table, _measure(table))

    def overall_mean(self, column: str) -> float | None:
        size = self.sizes[column]
        return size.sum_label / size.n_rows if size.n_rows else None

    def apply(
        self,
        df: DataFrame,
        columns: Mapping[str, str] | Sequence[str] | None = None,
        unseen: float | str | None = 0.0,
        broadcast_rows: int = BROADCAST_ROWS,
    ) -> DataFrame:
        """``df`` with each column's code in its output column.

        ``columns`` maps inputs to outputs, or lists columns to replace in place.
        ``unseen`` is what a value not met in fitting gets: a number, ``"mean"``
        for the overall mean label, or None for null.
        """
        if columns is None:
            columns = list(self.sizes)
        outputs = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
        large = self._large(outputs, broadcast_rows)
        frequent = _frequent_values(df, {c: key_value(df, c) for c in large}) if large else {}
        joined, codes = df, {}
        for position, (column, output) in enumerate(outputs.items()):
            key, code = f"_k{position}", f"_c{position}"
            stored = F.col(key_slot(df, column))
            lookup = self.table.where((F.col("feature") == column) & stored.isNotNull()).select(
                stored.alias(key), F.col("code").alias(code)
            )
            joined = lookup_join(joined, key_value(df, column), lookup, key, frequent.get(column))
            fallback = self.overall_mean(column) if unseen == "mean" else unseen
            codes[output] = F.col(code) if fallback is None else F.coalesce(code, F.lit(float(fallback)))
        kept = [codes.pop(name).alias(name) if name in codes else F.col(f"`{name}`") for name in df.columns]
        return joined.select(*kept, *[code.alias(name) for name, code in codes.items()])

    def _large(self, columns: Sequence[str], broadcast_rows: int) -> list[str]:
        """Columns that are not broadcast: too many keys, or no room left beside the smaller ones."""
        large, held = [], 0
        for column in sorted(columns, key=lambda c: (self.sizes[c].bytes, c)):
            held += self.sizes[column].bytes
            if self.sizes[column].n_keys > broadcast_rows or held > BROADCAST_BYTES:
                large.append(column)
        return large


def _frequent_values(df: DataFrame, keys: Mapping[str, Column]) -> dict[str, list]:
    """Per name, the values other than null that hold many rows; two passes for all names."""
    found = frequent_keys(df, {name: [key] for name, key in keys.items()})
    return {name: [value for value, _ in rows if value is not None] for name, rows in found.items()}


def lookup_join(
    df: DataFrame, key: Column, lookup: DataFrame, lookup_key: str, frequent: Sequence[object] | None = None
) -> DataFrame:
    """Left equi-join to a lookup with unique keys.

    Without ``frequent`` the lookup is broadcast.  With it, a list of the keys
    that hold many rows of ``df``, those keys are joined by broadcast and all
    others by shuffle in the same pass: rows of a frequent key, or without one,
    carry a salt that matches nothing and spreads them over the tasks.
    """
    if frequent is None:
        return df.join(F.broadcast(lookup), key == F.col(lookup_key), "left").drop(lookup_key)
    payload = [c for c in lookup.columns if c != lookup_key]
    packed = lookup.select(F.col(lookup_key), F.struct(*payload).alias("_found"))
    hot = key.isNull() | key.isin(list(frequent)) if frequent else key.isNull()
    few = packed.where(F.col(lookup_key).isin(list(frequent)) if frequent else F.lit(False)).toDF("_hot_key", "_hot")
    many = packed.withColumn("_cold_salt", F.lit(0)).withColumnRenamed(lookup_key, "_cold_key")
    spread_by = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]  # maps have no hash
    rows = df.select("*", F.when(~hot, key).alias("_key"), F.when(hot, key).alias("_frequent")).withColumn(
        "_salt", F.when(F.col("_key").isNotNull(), 0).otherwise(1 + F.pmod(F.xxhash64(*spread_by) if spread_by else F.lit(0), F.lit(1 << 16)).cast("int"))
    )
    joined = rows.join(F.broadcast(few), F.col("_frequent") == F.col("_hot_key"), "left").join(
        many, F.col("_key").eqNullSafe(F.col("_cold_key")) & (F.col("_salt") == F.col("_cold_salt")), "left"
    )
    found = F.coalesce("_hot", "_found")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[found[c].alias(c) for c in payload])


def _measure(table: DataFrame, columns: Sequence[str] = ()) -> dict[str, Size]:
    rows = table.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("n").alias("n_rows"),
        F.sum("sum_label").alias("sum_label"),
        F.sum(F.coalesce(F.octet_length("text_key"), F.lit(8))).alias("key_bytes"),
    )
    sizes = {column: Size(0, 0, 0.0, 0) for column in columns}
    for r in rows.collect():  # one row per column
        sizes[r["feature"]] = Size(r["n_keys"], r["n_rows"], r["sum_label"] or 0.0, r["key_bytes"])
    return sizes


def fit_means(df: DataFrame, columns: Sequence[str], label: str, weight: str | None = None) -> Encoding:
    """Each value's code is the mean label of the rows that have it; ``weight`` counts the rows behind a row."""
    table = cut(multi_column_study(df, columns, label, weight=weight).withColumn("code", F.col("mean_label")))
    return Encoding(table, _measure(table, columns))


def _ranked(means: Encoding) -> DataFrame:
    """The encoder table with ``_rn``: 1-based position by (mean, key) within a feature.

    Means are compared to 12 significant digits.  The null key has no code, so it takes no position.
    """
    known = reduce(or_, [F.col(c).isNotNull() for c in KEY_TYPES])
    table = means.table.where(known).withColumn("_mean", steady("mean_label"))
    order = ["_mean", *KEY_TYPES]
    if all(size.n_keys <= WINDOW_ROWS for size in means.sizes.values()):
        window = Window.partitionBy("feature").orderBy(*order)
        return table.withColumn("_rn", F.row_number().over(window)).drop("_mean")
    ranked = global_rank(table, ["feature", *order], "_rn")
    keys = {r["feature"]: r["n"] for r in table.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, passed = [], 0
    for feature in sorted(keys):  # one entry per column
        starts += [F.lit(feature), F.lit(passed)]
        passed += keys[feature]
    return ranked.withColumn("_rn", F.col("_rn") - F.create_map(*starts)[F.col("feature")]).drop("_mean")


def fit_ranks(df: DataFrame, columns: Sequence[str], label: str) -> Encoding:
    """Each value's code is its 0-based position when values are sorted by mean label, then key."""
    means = fit_means(df, columns, label)
    table = _ranked(means).withColumn("code", (F.col("_rn") - 1).cast("double")).drop("_rn")
    return Encoding(cut(table), means.sizes)


def fit_rank_bins(df: DataFrame, columns: Sequence[str], label: str, width: int = 2) -> Encoding:
    """Neighbours by mean label share a bin of ``width`` values; the lowest two bins are one."""
    means = fit_means(df, columns, label)
    bin_ = F.greatest(F.lit(1.0), F.floor((F.col("_rn") - 1) / F.lit(width)).cast("double"))
    table = _ranked(means).withColumn("code", bin_).drop("_rn")
    return Encoding(cut(table), means.sizes)


def held_out_means(
    df: DataFrame, column: str, label: str, fold: str, output: str, *, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Each row's mean label of its ``column`` value over the *other* folds (null if none).

    Sums per fold and value give every fold's training mean by subtraction: one
    pass over the rows for all folds, then one lookup join.
    """
    key = key_value(df, column)
    per_fold = df.where(key.isNotNull()).groupBy(key.alias("_k"), F.col(fold).alias("_f")).agg(
        F.sum(label).alias("s"), F.count(label).alias("n")
    )
    lookup = cut(
        per_fold.groupBy("_k").agg(
            F.sum("s").alias("_s"),
            F.sum("n").alias("_n"),
            F.map_from_entries(F.collect_list(F.struct("_f", F.struct("s", "n")))).alias("_own"),
        )
    )
    extent = lookup.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col("_k").cast("string")))).first()
    folds_bytes = (extent[1] or 0) + extent[0] * 64 * 16
    small = extent[0] <= broadcast_rows and folds_bytes <= BROADCAST_BYTES
    own = F.col("_own")[F.col(fold)]
    mean = (F.col("_s") - own["s"]).cast("double") / F.nullif(F.col("_n") - own["n"], F.lit(0))
    frequent = None if small else _frequent_values(df, {column: key})[column]
    joined = lookup_join(df, key, lookup, "_k", frequent)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], mean.alias(output))


def held_out_codes(
    df: DataFrame, columns: Mapping[str, str] | Sequence[str], label: str, fold: str, *,
    unseen: float | None = 0.0, broadcast_rows: int = BROADCAST_ROWS, weight: str | None = None,
) -> DataFrame:
    """``df`` with each column's values as their mean label over the *other* folds; ``unseen`` where there are none.

    ``columns`` maps inputs to outputs, or lists columns to replace in place.  One pass sums labels by
    (column, value, fold) for all columns, so every fold's means are differences of sums; a second pass
    looks all of them up, in one stage while the sums are small.  ``weight`` counts the rows behind a row.
    """
    outputs = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    if not outputs:
        return df
    total, n = label_sums(weight)
    cube = unpivoted(df, list(outputs), label, [fold, weight] if weight else [fold]).groupBy(
        fold, "feature", *KEY_TYPES
    ).agg(total.alias("s"), n.alias("n"))
    totals = cube.groupBy("feature", *KEY_TYPES).agg(
        F.sum("s").alias("S"), F.sum("n").alias("N"), F.collect_list(F.struct(F.col(fold).alias("f"), "s", "n")).alias("own")
    )
    ratio = lambda s, n: s.cast("double") / F.nullif(n, F.lit(0))
    without = F.map_from_entries(F.transform(
        "own", lambda o: F.struct(o["f"], F.struct(ratio(F.col("S") - F.coalesce(o["s"], F.lit(0)), F.col("N") - o["n"]).alias("mean")))
    ))
    table = cut(totals.select("feature", *KEY_TYPES, ratio(F.col("S"), F.col("N")).alias("overall"), without.alias("without")))
    extents = {
        r["feature"]: r for r in table.groupBy("feature").agg(
            F.count(F.lit(1)).alias("keys"),
            F.sum(F.coalesce(F.octet_length("text_key"), F.lit(8)) + 48 * F.size("without")).alias("bytes"),
        ).collect()  # one row per column
    }
    large, held = [], 0
    for column in sorted(extents, key=lambda c: (extents[c]["bytes"], c)):
        held += extents[column]["bytes"]
        if extents[column]["keys"] > broadcast_rows or held > BROADCAST_BYTES:
            large.append(column)
    frequent = _frequent_values(df, {c: key_value(df, c) for c in large}) if large else {}
    joined, codes = df, {}
    for position, (column, output) in enumerate(outputs.items()):
        key, mean, parts = f"_k{position}", f"_m{position}", f"_w{position}"
        stored = F.col(key_slot(df, column))
        lookup = table.where((F.col("feature") == column) & stored.isNotNull()).select(
            stored.alias(key), F.col("overall").alias(mean), F.col("without").alias(parts)
        )
        joined = lookup_join(joined, key_value(df, column), lookup, key, frequent.get(column))
        own = F.col(parts)[F.col(fold)]
        code = F.when(own.isNull(), F.col(mean)).otherwise(own["mean"])
        codes[output] = code if unseen is None else F.coalesce(code, F.lit(float(unseen)))
    kept = [codes.pop(name).alias(name) if name in codes else F.col(f"`{name}`") for name in df.columns]
    return joined.select(*kept, *[code.alias(name) for name, code in codes.items()])


class _MeanEncoderParams(HasInputCols, HasOutputCols, HasLabelCol):
    unseen: Param[str] = Param(
        Params._dummy(), "unseen", "code of an unseen value: a number as text, 'mean' or 'null'",
        TypeConverters.toString,
    )

    def getUnseen(self) -> str:
        return self.getOrDefault(self.unseen)

    def _fallback(self) -> float | str | None:
        text = self.getUnseen()
        return None if text == "null" else text if text == "mean" else float(text)


class MeanEncoder(Estimator, _MeanEncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """`fit_means` as a pipeline stage, so that tuning refits it on each training part."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, labelCol="label", unseen="0.0"):
        super().__init__()
        self._setDefault(labelCol="label", unseen="0.0")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setUnseen(self, value: str) -> MeanEncoder:
        return self._set(unseen=value)

    def _fit(self, dataset: DataFrame) -> MeanEncoderModel:
        encoding = fit_means(dataset, self.getInputCols(), self.getLabelCol())
        return self._copyValues(MeanEncoderModel(encoding))


class MeanEncoderModel(Model, _MeanEncoderParams, MLWritable, MLReadable):
    """A fitted `MeanEncoder`; saved as its parameters and, beside them, its table."""

    def __init__(self, encoding: Encoding | None = None):
        super().__init__()
        self._setDefault(labelCol="label", unseen="0.0")
        self.encoding = encoding

    def _transform(self, dataset: DataFrame) -> DataFrame:
        outputs = dict(zip(self.getInputCols(), self.getOutputCols()))
        return self.encoding.apply(dataset, outputs, self._fallback())

    def write(self) -> MLWriter:
        return _MeanEncoderModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _MeanEncoderModelReader(cls)


class _MeanEncoderModelWriter(MLWriter):
    def __init__(self, model: MeanEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.encoding.save(f"{path}/table")


class _MeanEncoderModelReader(MLReader):
    def __init__(self, kind: type[MeanEncoderModel]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> MeanEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stored = Encoding.load(self.sparkSession, f"{path}/table")
        model = self.kind()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        # a column whose rows were all without a value has no entry in the table
        sizes = {column: stored.sizes.get(column, Size(0, 0, 0.0, 0)) for column in model.getInputCols()}
        model.encoding = Encoding(stored.table, sizes)
        return model
