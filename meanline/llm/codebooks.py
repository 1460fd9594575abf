"""Vector codes: every part of a vector becomes the number of its nearest codebook entry, found by Orchard's search.

Vectors become integers, ``floor(scale * x)``, and are cut into equal parts with a codebook each.  A
codebook starts as parts of given vectors and is improved in rounds: assign all parts, then replace each
entry by the mean of its parts.  The nearest entry is found without a look at all entries: for every
entry the others are listed by distance.  A search holds the best entry so far and walks along its list;
an entry that is nearer takes its place, and the walk goes on in the list of that one, skipping entries
seen before.  When the next entry on the list is more than twice as far from the held one as the vector
is, the triangle inequality leaves nothing nearer, and the search ends.  Many vectors that hold the same
entry walk a stretch of its list together.

A round is one pass: tasks send sums and counts per entry, never vectors, and the driver holds nothing
but the codebooks, whose size depends on the parameters alone.  All arithmetic is on integers and exact.

Defined results
    null vectors, and vectors with null or non-finite components: left out.
    vectors of another length than that of the smallest id: left out; a length that the number of parts
        does not divide is cut at ``floor(i * length / parts)``.
    ties: the entry of the lower index.  Null ids come last among the vectors a codebook starts with;
        equal ids are ordered by their vectors.
    repeated rows: each is coded on its own and counts in the means.
    components of any size: codes and codebooks are exact; an error that passes 63 bits is null.
    fewer vectors than entries: a smaller codebook.  Empty tables: an empty result.
    other columns: kept; one named like a result column (code, error) gives way to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meanline.llm.skew import join_totals
from meanline.sources.storage import scratch, shared_table

#: Entries of a list that are compared in one step.
STRETCH = 64
_ROWS = 1 << 14
#: Components up to this size keep all sums below 2**53, where doubles are exact; larger ones take Python's integers.
_EXACT = 1 << 20


class Orchard:
    """One codebook (entries x components) with its neighbour lists."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries, self.size = entries, len(entries)
        self.norms = (entries * entries).sum(axis=1)
        between = self.norms[:, None] + self.norms[None, :] - 2 * (entries @ entries.T)
        self.lists = np.argsort(between, axis=1, kind="stable")  # an entry and its copies come first
        self.along = np.take_along_axis(between, self.lists, axis=1)
        # the first look goes to a few entries, evenly chosen
        self.starts = np.arange(0, self.size, max(1, int(self.size**0.5)))

    def _squared(self, parts: np.ndarray, norms: np.ndarray, entries: np.ndarray) -> np.ndarray:
        return norms[:, None] + self.norms[entries][None, :] - 2 * (parts @ self.entries[entries].T)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Index and squared distance of each part's nearest entry, and the number of distances computed."""
        n = len(parts)
        norms = (parts * parts).sum(axis=1)
        first = self._squared(parts, norms, self.starts)
        at = first.argmin(axis=1)
        best, held = first[np.arange(n), at], self.starts[at]
        seen = np.zeros((n, self.size), bool)
        seen[:, self.starts] = True
        place = np.zeros(n, np.int64)
        computed, active = first.size, np.arange(n)
        while len(active):
            order = active[np.lexsort([place[active], held[active]])]
            cuts = np.flatnonzero((np.diff(held[order]) != 0) | (np.diff(place[order]) != 0)) + 1
            going = []
            for group in np.split(order, cuts):
                entry, begin = held[group[0]], place[group[0]]
                reach = 4 * best[group]  # squared distance beyond which nothing is nearer
                inside = self.along[entry, begin] <= reach
                group, reach = group[inside], reach[inside]
                if not len(group):
                    continue  # their searches have ended
                end = min(begin + max(STRETCH, begin), np.searchsorted(self.along[entry], reach.max(), "right"))
                stretch = self.lists[entry, begin:end]
                known = seen[np.ix_(group, stretch)].all(axis=1)
                place[group[known]] = end
                going.append(group[known])
                group = group[~known]
                if not len(group):
                    continue
                far = self._squared(parts[group], norms[group], stretch)
                computed += far.size
                seen[np.ix_(group, stretch)] = True
                low = far.min(axis=1)
                index = np.where(far == low[:, None], stretch[None, :], self.size).min(axis=1)
                nearer = (low < best[group]) | ((low == best[group]) & (index < held[group]))
                place[group] = np.where(nearer, 0, end)
                best[group] = np.where(nearer, low, best[group])
                held[group] = np.where(nearer, index, held[group])
                going.append(group)
            active = np.concatenate(going) if going else active[:0]
            active = active[place[active] < self.size]
        return held, best, computed


def _bounds(length: int, parts: int) -> list[int]:
    return [i * length // parts for i in range(parts + 1)]


def _integers(column: pa.Array, scale: int) -> np.ndarray:
    """Vectors of one length as integers; doubles that hold integers exactly, or Python's integers if they may not."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    table = np.floor(scale * flat).reshape(len(column), -1)
    if table.size and np.abs(table).max() >= _EXACT:
        table = np.array([[int(x) for x in row] for row in table], object)
    return table


def usable(vector: str) -> Column:
    """Whether a vector is there and holds neither nulls nor non-finite components."""
    held = F.col(vector)
    bad = F.exists(held, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return held.isNotNull() & ~F.coalesce(bad, F.lit(True))


@dataclass(frozen=True)
class Codebooks:
    """``books[p][e]`` are the integer components of entry e for part p."""

    books: tuple[tuple[tuple[int, ...], ...], ...]
    length: int
    scale: int

    @property
    def sha256(self) -> str:
        """Digest of all components in order of part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(x) for book in self.books for entry in book for x in entry).encode()).hexdigest()

    def searchers(self) -> list[Orchard]:
        found, cuts = [], _bounds(self.length, len(self.books))
        for p, book in enumerate(self.books):
            large = max((abs(x) for entry in book for x in entry), default=0) >= _EXACT
            table = np.array(book, object if large else np.float64)
            found.append(Orchard(table.reshape(len(book), cuts[p + 1] - cuts[p])))
        return found

    def assign(self, vectors: np.ndarray, searchers: list[Orchard]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per part: its components, the indexes and the squared distances of all vectors."""
        cuts = _bounds(self.length, len(self.books))
        for p, orchard in enumerate(searchers):
            part = vectors[:, cuts[p] : cuts[p + 1]]
            index, squared, _ = orchard.nearest(part)
            yield part, index, squared


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


def _improved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry becomes the mean of the parts that it is nearest to."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers, sums, counts = books.searchers(), {}, {}
        for batch in _blocks(batches):
            for p, (part, index, _) in enumerate(books.assign(_integers(batch.column(0), books.scale), searchers)):
                order = np.argsort(index, kind="stable")
                entries, first = np.unique(index[order], return_index=True)
                added = np.add.reduceat(part[order], first, axis=0)
                for entry, row, n in zip(entries.tolist(), added, np.diff(np.append(first, len(order))).tolist(), strict=True):
                    held = sums.get((p, entry))
                    row = [int(x) for x in row]
                    sums[p, entry] = row if held is None else [a + b for a, b in zip(held, row, strict=True)]
                    counts[p, entry] = counts.get((p, entry), 0) + n
        keys = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([counts[k] for k in keys], pa.int64()),
             pa.array([[str(x) for x in sums[k]] for k in keys], pa.list_(pa.string()))],
            names=["part", "entry", "n", "sums"],
        )

    parts = vectors.mapInArrow(total, "part int, entry int, n bigint, sums array<string>")
    summed = (
        parts.select("part", "entry", "n", F.posexplode("sums").alias("position", "value"))
        .groupBy("part", "entry", "position")
        .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    )
    changed = [[list(entry) for entry in book] for book in books.books]
    for row in summed.collect():  # as many rows as the codebooks have components
        changed[row["part"]][row["entry"]][row["position"]] = int(row["total"]) // row["n"]
    return Codebooks(tuple(tuple(tuple(e) for e in book) for book in changed), books.length, books.scale)


def fit(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", *, parts: int = 4, entries: int = 256,
    rounds: int = 4, scale: int = 1024,
) -> Codebooks:
    """Codebooks that start with the ``entries`` smallest ids and are improved ``rounds`` times over all rows."""
    kept = df.where(usable(vector)).select(F.col(id).alias("id"), F.col(vector).alias("v"))
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(1).collect()
    if not first:
        return Codebooks(tuple(() for _ in range(parts)), 0, scale)
    length = len(first[0]["v"])
    same = kept.where(F.size("v") == length)
    start = same.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    table = [[int(np.floor(scale * float(x))) for x in row["v"]] for row in start]
    cuts = _bounds(length, parts)
    books = Codebooks(
        tuple(tuple(tuple(row[cuts[p] : cuts[p + 1]]) for row in table) for p in range(parts)), length, scale
    )
    for _ in range(rounds):
        books = _improved(same.select("v"), books)
    return books


def encode(df: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """The usable rows of ``df`` with ``code``, two hex digits a part (more for large books), and ``error``."""
    added = ["code", "error"]
    others = [c for c in df.columns if c not in added]
    packed = df.where(usable(vector) & (F.size(vector) == books.length)).select(
        F.col(vector).alias("v"), F.struct(F.lit(0).alias("held"), *(F.col(f"`{c}`") for c in others)).alias("row")
    )
    digits = max(2, len(f"{max(1, max(map(len, books.books))) - 1:x}"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers = books.searchers()
        for batch in _blocks(batches):
            codes, errors = [""] * batch.num_rows, [0] * batch.num_rows
            for _, index, squared in books.assign(_integers(batch.column(0), books.scale), searchers):
                codes = [c + format(i, f"0{digits}x") for c, i in zip(codes, index.tolist(), strict=True)]
                errors = [e + int(x) for e, x in zip(errors, squared, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(codes, pa.string()), pa.array([e if e < 1 << 63 else None for e in errors], pa.int64())],
                names=["row", *added]
            )

    schema = T.StructType([
        packed.schema["row"], T.StructField("code", T.StringType(), False), T.StructField("error", T.LongType())
    ])
    return packed.mapInArrow(code, schema).select(*(F.col(f"row.`{c}`") for c in others), *added)


def decode(codes: DataFrame, books: Codebooks, code: str = "code") -> DataFrame:
    """``codes`` with ``approximation``: the entries that the code names, end to end, scaled back."""
    digits = max(2, len(f"{max(1, max(map(len, books.books))) - 1:x}"))
    pieces = []
    for p, book in enumerate(books.books):
        entries = F.lit([[x / books.scale for x in entry] for entry in book])
        index = F.conv(F.substring(F.col(code), p * digits + 1, digits), 16, 10).cast("int")
        pieces.append(F.element_at(entries, index + 1))
    return codes.withColumn("approximation", F.concat(*pieces))


def codes_with_totals(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", **options
) -> DataFrame:
    """``encode`` under codebooks fitted on the same rows, with the errors' sum over equal labels and the books' digest."""
    books = fit(df, id, vector, **options)
    with scratch(df.sparkSession) as keep:
        key = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("-"))
        coded = shared_table(encode(df.select(id, vector, label), books, vector).withColumn("label_key", key), "codes")
        totals = shared_table(
            coded.groupBy("label_key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors"
        )
        joined = join_totals(coded, totals, "label_key", "n").withColumn("codebooks_sha256", F.lit(books.sha256))
        return keep(joined.drop("label_key", "n"), "coded")


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The same in SQL for vectors of one length that the number of parts divides."""
    steps = [f"""
with kept as (select vec_id, label, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings where embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
r as (select row_number() over () as row_id, * from kept),
p as materialized (select row_id, q.part, v[q.part * (len(v) // {parts}) + 1 : (q.part + 1) * (len(v) // {parts})] as v
  from r, (select unnest(range({parts})) as part) q),
b0 as materialized (select part, entry, v from (select p.part, p.v, row_number() over (partition by p.part order by r.vec_id) - 1 as entry
  from p join r using (row_id)) where entry < {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} as materialized (select row_id, part, v, min(cast(d as bigint) * {entries} + entry) % {entries} as entry,
  min(cast(d as bigint) * {entries} + entry) // {entries} as d
  from (select p.row_id, p.part, p.v, b.entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d
  from p join b{i} b using (part)) group by row_id, part, v)""")
        if i < rounds:
            steps.append(f"""m{i} as (select part, entry, list(cast(floor_mean as bigint) order by position) as v from (
  select part, entry, position, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) as floor_mean
  from (select part, entry, unnest(v) as x, unnest(range(len(v))) as position from a{i}) group by part, entry, position)
  group by part, entry)""")
            steps.append(f"b{i + 1} as materialized (select part, entry, coalesce(m.v, b.v) as v from b{i} b left join m{i} m using (part, entry))")
    steps.append(f"""s as (select sha256(string_agg(cast(x as varchar), ',' order by part, entry, position)) as codebooks_sha256
  from (select part, entry, unnest(v) as x, unnest(range(len(v))) as position from b{rounds}))""")
    steps.append(f"""c as (select row_id, string_agg(lower(printf('%02x', entry)), '' order by part) as code, cast(sum(d) as bigint) as error
  from a{rounds} group by row_id)""")
    return ",\n".join(steps) + """
select r.vec_id, c.code, c.error, cast(sum(c.error) over (partition by r.label) as bigint) as label_error, s.codebooks_sha256
from r join c using (row_id), s
"""


CODES_SQL = _codes_sql()
