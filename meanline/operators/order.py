"""Exact order statistics, rank slices and global ranks without a one-task sort.

Two routes.  *Slices and order statistics* narrow down on the wanted ranks:
quantile sketches propose bounds, exact counts confirm them, and only a small
bracket is ever sorted.  *Global ranks* range-partition the rows, sort within
partitions and add each partition's offset.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meanline.operators.frequent import frequent_keys
from meanline.sources.storage import cut, shared_table

#: Values brought to the driver to finish one order statistic.
BRACKET_ROWS = 5_000

#: Rows one task may rank by itself.
WINDOW_ROWS = 200_000

_SKETCHABLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Located:
    """A value at a wanted rank, with the rows before it and equal to it."""

    value: object
    n_less: int
    n_equal: int


@dataclass
class Wanted:
    """One order statistic: the value of ``column`` at ``rank`` among the rows of ``scope``."""

    column: str
    rank: int
    rows: int | None = None
    scope: Column | None = None
    base: int = 0
    above: object = None
    below: object = None
    found: Located | None = None

    def group(self) -> tuple:
        """Wanted ranks with the same rows in play share their aggregates."""
        return self.column, id(self.scope), self.above, self.below

    def inside(self, kind: T.DataType) -> Column:
        """Rows still in play: strictly between the bounds settled so far."""
        value = F.col(f"`{self.column}`")
        test = value.isNotNull() if self.scope is None else self.scope & value.isNotNull()
        if self.above is not None:
            test = test & (value > _literal(self.above, kind))
        if self.below is not None:
            test = test & (value < _literal(self.below, kind))
        return test


def _literal(value: object, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return F.lit(str(value)).cast(kind)
    if isinstance(kind, T.TimestampType):
        # Python has it in its local time; the instant is what both agree on
        return F.timestamp_micros(F.lit(int(value.replace(microsecond=0).timestamp()) * 1_000_000 + value.microsecond))
    return F.lit(value)


_ACCURACY = 10_000


def order_statistics(df: DataFrame, wanted: Sequence[Wanted], bracket_rows: int = BRACKET_ROWS) -> list[Located]:
    """The exact value at each wanted 1-based rank among non-null values.

    A round costs two aggregations over ``df`` however many ranks are wanted.
    It cuts the rows in play about 2,500-fold, and values that repeat many times
    are settled by their counts, so ties never pile up.
    """
    uncounted = [group for group in _groups(df, wanted) if group.first.rows is None]
    if uncounted:
        counts = df.agg(*[F.count_if(g.inside).alias(str(i)) for i, g in enumerate(uncounted)]).first()
        for i, group in enumerate(uncounted):
            for want in group.members:
                want.rows = counts[str(i)]
    for want in wanted:
        if not 1 <= want.rank <= want.rows:
            raise ValueError(f"rank {want.rank} of {want.rows} values in {want.column}")
    while open_groups := _groups(df, [w for w in wanted if w.found is None]):
        small = [g for g in open_groups if g.first.rows <= bracket_rows]
        large = [g for g in open_groups if g.first.rows > bracket_rows]
        if small:
            _finish(df, small)
        if large:
            _narrow(df, large)
    return [w.found for w in wanted]


@dataclass
class _Group:
    """Wanted ranks over the same rows of the same column."""

    members: list[Wanted]
    kind: T.DataType

    @property
    def first(self) -> Wanted:
        return self.members[0]

    @property
    def value(self) -> Column:
        return F.col(f"`{self.first.column}`")

    @property
    def inside(self) -> Column:
        return self.first.inside(self.kind)


def _groups(df: DataFrame, wanted: Sequence[Wanted]) -> list[_Group]:
    groups: dict[tuple, list[Wanted]] = {}
    for want in wanted:
        groups.setdefault(want.group(), []).append(want)
    return [_Group(members, df.schema[members[0].column].dataType) for members in groups.values()]


def _restrict(df: DataFrame, groups: Sequence[_Group]) -> DataFrame:
    """Let the scan skip what no wanted rank can reach."""
    return df.where(reduce(or_, [group.inside for group in groups]))


def _finish(df: DataFrame, groups: Sequence[_Group]) -> None:
    """Read the few values left in play and pick the wanted ones."""
    values = (
        _restrict(df, groups)
        .agg(*[F.sort_array(F.collect_list(F.when(g.inside, g.value))).alias(str(i)) for i, g in enumerate(groups)])
        .first()
    )
    for i, group in enumerate(groups):
        ordered = values[str(i)]
        for want in group.members:
            value = ordered[want.rank - want.base - 1]
            before, upto = bisect_left(ordered, value), bisect_right(ordered, value)
            want.found = Located(value, want.base + before, upto - before)


def _narrow(df: DataFrame, groups: Sequence[_Group]) -> None:
    """One round: propose bounds by sketch, count exactly, keep the right part."""
    sketches = []
    for i, group in enumerate(groups):
        places = [(want.rank - want.base - 0.5) / want.rows for want in group.members]
        slack = 2 / _ACCURACY
        fractions = sorted({min(1.0, max(0.0, at + side)) for at in places for side in (-slack, slack)})
        sketches.append(
            F.percentile_approx(F.when(group.inside, group.value), fractions, _ACCURACY).alias(str(i))
        )
    proposed = _restrict(df, groups).agg(*sketches).first()
    bounds = [sorted(set(proposed[str(i)])) for i in range(len(groups))]
    counts = []
    for i, group in enumerate(groups):
        inside = group.inside
        for j, bound in enumerate(bounds[i]):
            edge = _literal(bound, group.kind)
            counts.append(F.count_if(inside & (group.value < edge)).alias(f"less_{i}_{j}"))
            counts.append(F.count_if(inside & (group.value == edge)).alias(f"equal_{i}_{j}"))
    exact = _restrict(df, groups).agg(*counts).first()
    for i, group in enumerate(groups):
        edges = [(bound, exact[f"less_{i}_{j}"], exact[f"equal_{i}_{j}"]) for j, bound in enumerate(bounds[i])]
        for want in group.members:
            _settle(want, edges)


def _settle(want: Wanted, edges: Sequence[tuple[object, int, int]]) -> None:
    """Keep the stretch between two neighbouring bounds that holds the wanted rank."""
    local, passed, base, rows = want.rank - want.base, 0, want.base, want.rows
    for bound, less, equal in edges:
        if local <= less:
            want.below, want.base, want.rows = bound, base + passed, less - passed
            return
        if local <= less + equal:
            want.found = Located(bound, base + less, equal)
            return
        want.above, passed = bound, less + equal
    want.base, want.rows = base + passed, rows - passed


def exact_quantiles(df: DataFrame, columns: Sequence[str], fractions: Sequence[float]) -> dict[str, list[float]]:
    """Exact linearly interpolated quantiles of many columns in a few shared passes."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(columns)]).first()
    wanted, weights = [], {}
    rows_of = {column: counts[str(i)] for i, column in enumerate(columns)}
    for i, column in enumerate(columns):
        for fraction in fractions:
            n = counts[str(i)]
            if n == 0:
                weights[column, fraction] = None
                continue
            position = fraction * (n - 1)
            lower = int(position)
            upper = min(lower + 1, n - 1)
            weights[column, fraction] = (lower + 1, upper + 1, position - lower)
            wanted += [(column, lower + 1), (column, upper + 1)]
    wanted = list(dict.fromkeys(wanted))
    values = dict(zip(wanted, order_statistics(df, [Wanted(*place, rows=rows_of[place[0]]) for place in wanted])))
    result: dict[str, list[float]] = {}
    for column in columns:
        result[column] = []
        for fraction in fractions:
            place = weights[column, fraction]
            if place is None:
                result[column].append(None)
                continue
            lower, upper, part = place
            low, high = float(values[column, lower].value), float(values[column, upper].value)
            result[column].append(low + (high - low) * part)
    return result


def _beyond(
    df: DataFrame, order_by: Sequence[str], key: Sequence[object], *, after: bool, or_equal: bool = False
) -> Column:
    """Rows on one side of ``key`` in the order of ``order_by``."""
    test = F.lit(or_equal)
    for column, value in reversed(list(zip(order_by, key))):
        here, there = F.col(f"`{column}`"), _literal(value, df.schema[column].dataType)
        test = (here > there if after else here < there) | ((here == there) & test)
    return test


@dataclass(eq=False)
class _Place:
    """A row position being looked up column by column."""

    order_by: Sequence[str]
    rank: int
    key: tuple = ()
    before: int = 0
    n_equal: int | None = None
    scope: Column | None = None


def keys_at_ranks(
    df: DataFrame, places: Sequence[tuple[Sequence[str], int]], rows: int | None = None
) -> list[tuple[tuple, int, int]]:
    """For each (order_by, rank): the key of that row, rows before the key, rows having it.

    ``rows`` is the number of rows, if known; the orders then hold no nulls.

    All places share their passes over ``df``: one set for the first ordering
    columns, one for the second ones among rows tied on the first, and so on.
    """
    found = [_Place(order_by, rank, n_equal=rows) for order_by, rank in places]
    for level in range(max(len(place.order_by) for place in found)):
        here = [place for place in found if level < len(place.order_by)]
        kinds = {place.order_by[level]: df.schema[place.order_by[level]].dataType for place in here}
        sketched = [place for place in here if isinstance(kinds[place.order_by[level]], _SKETCHABLE)]
        located = order_statistics(
            df, [Wanted(p.order_by[level], p.rank - p.before, p.n_equal, p.scope) for p in sketched]
        )
        settled = list(zip(sketched, located))
        settled += [
            (place, _text_at_rank(df, place.order_by[level], place.rank - place.before, place.scope))
            for place in here
            if place not in sketched
        ]
        for place, at in settled:
            column = place.order_by[level]
            same = F.col(f"`{column}`") == _literal(at.value, kinds[column])
            place.scope = same if place.scope is None else place.scope & same
            place.key += (at.value,)
            place.before += at.n_less
            place.n_equal = at.n_equal
    return [(place.key, place.before, place.n_equal) for place in found]


def _text_at_rank(df: DataFrame, column: str, rank: int, scope: Column | None) -> Located:
    """Order statistic of a column no sketch covers: count per value, then walk or rank the values."""
    rows = df if scope is None else df.where(scope)
    counts = cut(rows.groupBy(column).agg(F.count(F.lit(1)).alias("_n")))
    if counts.count() <= BRACKET_ROWS:
        passed = 0
        for row in counts.orderBy(column).collect():
            if rank <= passed + row["_n"]:
                return Located(row[column], passed, row["_n"])
            passed += row["_n"]
    ranked = _running_total(counts, [column], F.col("_n"), weighted=True)
    row = ranked.where((F.col("_run") >= rank) & (F.col("_run") - F.col("_n") < rank)).first()
    return Located(row[column], row["_run"] - row["_n"], row["_n"])


def rank_first(df: DataFrame, order_by: Sequence[str], n: int, output: str = "rnk") -> DataFrame:
    """The first ``n`` rows with their ranks."""
    top = df.orderBy(*order_by).limit(n)
    return top.select(F.row_number().over(Window.orderBy(*order_by)).cast("bigint").alias(output), "*")


def rank_last(df: DataFrame, order_by: Sequence[str], n: int, output: str = "rnk") -> DataFrame:
    """The last ``n`` rows with their ranks counted from the start."""
    backwards = [F.col(f"`{c}`").desc() for c in order_by]
    total = df.count()
    top = df.orderBy(*backwards).limit(n)
    rank = F.lit(total + 1) - F.row_number().over(Window.orderBy(*backwards))
    return top.select(rank.cast("bigint").alias(output), "*")


def _orderable_rows(df: DataFrame, order_by: Sequence[str]) -> int:
    """The number of rows; nulls and NaNs in the order are refused, as they have no place between values."""
    odd = F.lit(False)
    for column in order_by:
        value, kind = F.col(f"`{column}`"), df.schema[column].dataType
        odd = odd | value.isNull() | (F.isnan(value) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.lit(False))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(odd).alias("odd")).first()
    if row["odd"]:
        raise ValueError(f"{row['odd']} rows have nulls or NaNs in {', '.join(order_by)}; filter or fill them first")
    return row["n"]


def rank_slice(
    df: DataFrame, order_by: Sequence[str], first: int, last: int, output: str = "rnk", total: int | None = None
) -> DataFrame:
    """Rows ranked ``first`` to ``last``, exactly, for any position in the order.

    ``order_by`` must identify a row (add a key, or all output columns); nulls
    and NaNs in it raise ``ValueError``.  Copies that agree in every ordering
    column are interchangeable and are taken in any order.
    """
    total = _orderable_rows(df, order_by) if total is None else total
    first, last = max(1, first), min(last, total)
    if last < first:
        return df.select(F.lit(0).cast("bigint").alias(output), "*").limit(0)
    size = last - first + 1
    (low, low_before, low_rows), (high, _, _) = keys_at_ranks(df, [(order_by, first), (order_by, last)], total)
    up_to_high = _beyond(df, order_by, high, after=False, or_equal=True)
    if low_before + 1 == first:
        rows = df.where(_beyond(df, order_by, low, after=True, or_equal=True) & up_to_high)
    else:
        same = reduce(and_, [F.col(f"`{c}`") == _literal(v, df.schema[c].dataType) for c, v in zip(order_by, low)])
        tail = df.where(same).limit(min(size, low_before + low_rows - first + 1))
        rows = tail.unionByName(df.where(_beyond(df, order_by, low, after=True) & up_to_high))
    rows = rows.orderBy(*order_by).limit(size)
    rank = F.row_number().over(Window.orderBy(*order_by)) + F.lit(first - 1)
    return rows.select(rank.cast("bigint").alias(output), "*")


def rank_middle(df: DataFrame, order_by: Sequence[str], n: int = 100, output: str = "rnk") -> DataFrame:
    """The ``n`` rows round the middle, from rank total // 2 - n // 2 + 1 on."""
    total = _orderable_rows(df, order_by)
    first = total // 2 - n // 2 + 1
    return rank_slice(df, order_by, first, first + n - 1, output, total)


def global_rank(df: DataFrame, order_by: Sequence[str], output: str = "rnk") -> DataFrame:
    """Every row with its 1-based rank in the order of ``order_by``.

    Rows are range-partitioned on all ordering columns (so a repeated first
    value spreads over tasks by the next ones), sorted within partitions and
    written once; a row's rank is its place in its partition plus the rows of
    the partitions before.  Rows that agree in every ordering column cannot be
    parted by range: if they are many, one row stands in for them in the sort,
    and they are numbered among themselves task by task.
    """
    names = [F.col(f"`{c}`") for c in df.columns]
    frequent = _frequent_keys(df, order_by)
    if not frequent:
        ranked = _running_total(df, order_by, F.lit(1))
        return ranked.select(F.col("_run").alias(output), *names)
    key_schema = T.StructType([df.schema[c] for c in order_by] + [T.StructField("_n", T.LongType())])
    keys = df.sparkSession.createDataFrame(frequent, key_schema)
    match = reduce(and_, [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in order_by])
    rare = df.alias("l").join(F.broadcast(keys).alias("r"), match, "left_anti")
    stand_ins = rare.select("*", F.lit(1).cast("bigint").alias("_n")).unionByName(keys, allowMissingColumns=True)
    ranked = _running_total(stand_ins, order_by, F.col("_n"), weighted=True)
    ends = ranked.where(F.col("_n") > 1).select(*order_by, (F.col("_run") - F.col("_n")).alias("_base"))
    numbered = shared_table(
        df.alias("l").join(F.broadcast(ends).alias("r"), match).select(
            "l.*", "_base", F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().alias("_place")
        ),
        "copies",
    )
    per_task = numbered.groupBy("_base", "_task").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.partitionBy("_base").orderBy("_task")) - F.col("_size")
    starts = per_task.select("_base", "_task", before.alias("_before"))
    local = F.row_number().over(Window.partitionBy("_base", "_task").orderBy("_place"))
    copies = numbered.select("*", local.alias("_local")).join(starts, ["_base", "_task"])
    rank = (F.col("_base") + F.col("_before") + F.col("_local")).cast("bigint")
    singles = ranked.where(F.col("_n") == 1).select(F.col("_run").alias(output), *names)
    return singles.unionByName(copies.select(rank.alias(output), *names))


def _frequent_keys(df: DataFrame, order_by: Sequence[str], share: int | None = None) -> list[tuple]:
    """Ordering keys that hold a large part of a task's rows, with counts; see `frequent_keys`."""
    found = frequent_keys(df, {"order": [F.col(f"`{c}`") for c in order_by]}, share)["order"]
    return [row for row in found if row[-1] > 1]


def _running_total(
    df: DataFrame, order_by: Sequence[str], weight: Column, *, weighted: bool = False
) -> DataFrame:
    """``df`` with ``_run``: the sum of ``weight`` up to and with each row in the order of ``order_by``."""
    placed = shared_table(
        df.repartitionByRange(*[F.col(f"`{c}`") for c in order_by])
        .sortWithinPartitions(*order_by)
        .select("*", F.monotonically_increasing_id().alias("_place")),
        "ranked",
    )
    part, local = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    if weighted:
        placed = placed.select("*", part.alias("_part"))
        within = Window.partitionBy("_part").orderBy("_place")
        placed = placed.select("*", F.sum(weight).over(within).alias("_sum"))
        size, run = F.sum(weight), F.col("_sum")
    else:
        size, run = F.max(local) + 1, local + 1
    sizes = placed.groupBy(part.alias("_part")).agg(size.cast("bigint").alias("_size")).orderBy("_part").collect()
    offsets, total = [], 0
    for row in sizes:  # one entry per shuffle partition
        offsets.append((row["_part"], total))
        total += row["_size"]
    starts = df.sparkSession.createDataFrame(offsets, "_from bigint, _offset bigint")
    joined = placed.join(F.broadcast(starts), part == F.col("_from"))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (run + F.col("_offset")).cast("bigint").alias("_run"))


def add_ntiles(df: DataFrame, axes: Mapping[str, str], tie: str, tiles: int) -> DataFrame:
    """``ntile`` over the whole table for several columns at once, without sorting it.

    ``axes`` maps a column to its output.  Only the last key of every tile is
    looked up; a row's tile is then the number of such keys before it, plus one.
    """
    total = df.count()
    ends, end = [], 0
    for tile in range(tiles - 1):
        end += total // tiles + (1 if tile < total % tiles else 0)
        if end:
            ends.append(end)
    ends = list(dict.fromkeys(ends))
    places = [([column, tie], end) for column in axes for end in ends]
    keys = [key for key, _, _ in keys_at_ranks(df, places)] if places else []
    outputs = []
    for position, (column, output) in enumerate(axes.items()):
        tile: Column = F.lit(1)
        for key in keys[position * len(ends) : (position + 1) * len(ends)]:
            tile = tile + _beyond(df, [column, tie], key, after=True).cast("int")
        outputs.append(tile.alias(output))
    return df.select("*", *outputs)
