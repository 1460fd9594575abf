"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by a pseudo-rotation (three rounds of random signs and the fast Hadamard
transform) and assigned to the nearest signed axis.  Several tables use different signs.  A query looks
into the ``probes`` nearest axes of every table; whatever stands there is ranked by its exact distance.

Every row is indexed.  Of equal vectors only the ``k + 1`` smallest ids can be among the nearest of any
query, so further copies need not be hashed; the result is the same.  Vectors of different lengths are
lifted onto a sphere first, so that near in angle means near in distance.

A table's bucket is cut into cells of bounded size, for candidates and for queries, so a bucket that
holds a third of all rows is many tasks.  Each cell returns the nearest ``k`` ids of each of its queries.

Defined results
    vectors that are null, zero or hold null or non-finite components take no part.
    ties go to the smaller id; a query is never its own neighbour; rows that repeat an id count once.
    vectors of another length than most are compared only with their like (their own dimension).
    empty table, or no query: no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meanline.sources.storage import shared_table

TABLES = 8
PROBES = 16
CELL_ROWS = 4096
CELL_QUERIES = 512


def _usable(vector: str) -> Column:
    v = F.col(vector)
    plain = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & plain & F.exists(v, lambda x: x != 0)


def rotate(vectors: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Rows turned by one pseudo-rotation; their number of columns is a power of two."""
    rows, n = vectors.shape
    for sign in signs:
        vectors = vectors * sign
        width = 1
        while width < n:
            pairs = vectors.reshape(rows, n // (2 * width), 2, width)
            vectors = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], 2).reshape(rows, n)
            width *= 2
    return vectors


def _axes(vectors: np.ndarray, lift: float, table: int, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first."""
    squares = (vectors**2).sum(1)
    if lift:
        vectors = np.concatenate([vectors, np.sqrt(np.maximum(lift - squares, 0))[:, None]], 1)
    vectors = vectors / np.sqrt((vectors**2).sum(1))[:, None]
    size = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    padded = np.zeros((len(vectors), size))
    padded[:, : vectors.shape[1]] = vectors
    signs = np.random.default_rng([table, size]).choice([-1.0, 1.0], (3, size))
    turned = rotate(padded, signs)
    both = np.concatenate([turned, -turned], 1)
    if probes == 1:
        return both.argmax(1)[:, None]
    order = np.argsort(-both, axis=1, kind="stable")
    return order[:, :probes] if probes else order


def _matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dimension)


def _hashed(rows: DataFrame, lift: float, tables: int, probes: int, prefix: str) -> DataFrame:
    """One row for each table and probe: dimension, table, bucket, id and vector.  ``probes`` 0 means all axes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("v").to_pylist()])
            for dimension in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == dimension)))
                matrix = np.array(part.column("v").to_pylist(), np.float64)
                packed = pa.array([row.tobytes() for row in matrix], pa.binary())
                for table in range(tables):
                    axes = _axes(matrix, lift, table, probes)
                    at = np.repeat(np.arange(len(matrix)), axes.shape[1])
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, dimension, np.int32)), pa.array(np.full(n, table, np.int32)),
                         pa.array(axes.ravel().astype(np.int32)), part.column("id").take(pa.array(at)), packed.take(pa.array(at))],
                        names=[f"{prefix}{c}" for c in ("dimension", "table", "bucket", "id", "vector")],
                    )

    return rows.mapInArrow(
        run, f"{prefix}dimension int, {prefix}table int, {prefix}bucket int, {prefix}id bigint, {prefix}vector binary"
    )


def nearest(
    rows: DataFrame, is_query: Column, *, ids: str = "vec_id", vectors: str = "embedding", k: int = 10,
    tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest rows found for every row where ``is_query`` holds.

    ``score`` is the Euclidean distance of the original vectors in double precision.
    """
    known = rows.where(_usable(vectors) & F.col(ids).isNotNull()).select(
        F.col(ids).cast("bigint").alias("id"), F.transform(vectors, lambda x: x.cast("double")).alias("v"),
        is_query.alias("asks"),
    )
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    least, most = known.agg(F.min(square), F.max(square)).first()
    lift = 0.0 if least is None or most <= least * (1 + 1e-5) else most
    first = F.row_number().over(W.partitionBy("v").orderBy("id"))
    copies = known.select("id", "v").distinct().withColumn("copy", first)
    indexed = shared_table(_hashed(copies.where(F.col("copy") <= k + 1).select("id", "v"), lift, tables, 1, ""), "hashed")
    queries = known.where("asks").select("id", "v").distinct()
    best = shared_table(_search(_hashed(queries, lift, tables, probes, "q_"), indexed, k), "nearest")
    # a query that found fewer than k looks into every bucket of the first table
    full = best.groupBy(F.col("query_id").alias("id")).count().where(F.col("count") >= k)
    short = shared_table(queries.join(full, "id", "left_anti"), "short")
    if not short.isEmpty():
        again = _search(_hashed(short, lift, 1, 0, "q_"), indexed, k)
        best = best.unionByName(again).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    by_query = W.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _search(asked: DataFrame, indexed: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id and score of the nearest ``k`` of each cell that a query looks into."""
    asked = shared_table(asked, "asked")
    # at most tables x axes rows for each dimension
    filled = indexed.groupBy("dimension", "table", "bucket").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("cells"))
    wanted = asked.groupBy("q_dimension", "q_table", "q_bucket").agg(
        F.ceil(F.count(F.lit(1)) / CELL_QUERIES).cast("int").alias("q_cells")
    )
    grid = shared_table(
        filled.join(wanted, (F.col("dimension") == F.col("q_dimension")) & (F.col("table") == F.col("q_table"))
                    & (F.col("bucket") == F.col("q_bucket"))).select("dimension", "table", "bucket", "cells", "q_cells"),
        "cells",
    )
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    candidates = indexed.join(grid, ["dimension", "table", "bucket"]).select(
        "dimension", "table", "bucket", "id", "vector", dealt("id", F.col("cells")).alias("i"),
        spread(F.col("q_cells")).alias("j"),
    )
    q_grid = grid.select(*(F.col(c).alias(f"q_{c}") for c in ("dimension", "table", "bucket")), "cells", F.col("q_cells").alias("n_cells"))
    queries = asked.join(q_grid, ["q_dimension", "q_table", "q_bucket"]).select(
        "q_dimension", "q_table", "q_bucket", "q_id", "q_vector", spread(F.col("cells")).alias("q_i"),
        dealt("q_id", F.col("n_cells")).alias("q_j"),
    )

    def rank(asks: pa.Table, held: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if asks.num_rows and held.num_rows:
            dimension = held.column("dimension")[0].as_py()
            c, q = _matrix(held.column("vector"), dimension), _matrix(asks.column("q_vector"), dimension)
            c_ids, q_ids = held.column("id").to_numpy(), asks.column("q_id").to_numpy()
            order = np.argsort(c_ids, kind="stable")
            c, c_ids = c[order], c_ids[order]
            starts = np.flatnonzero(np.concatenate([[True], c_ids[1:] != c_ids[:-1]]))  # an id may have several vectors
            squares = (c**2).sum(1)
            rough = squares[None, :] - 2 * (q @ c.T)
            for row, (query, vector) in enumerate(zip(q_ids, q, strict=True)):
                near = rough[row]
                if len(starts) > k + 1:
                    slack = 1e-9 * (squares.max() + (vector**2).sum())
                    at = np.flatnonzero(near <= np.partition(np.minimum.reduceat(near, starts), k)[k] + slack)
                else:
                    at = np.arange(len(c_ids))
                at = at[c_ids[at] != query]
                score = np.sqrt(((c[at] - vector) ** 2).sum(1))
                nearest_first = np.lexsort((c_ids[at], score))
                _, firsts = np.unique(c_ids[at][nearest_first], return_index=True)
                for i in nearest_first[np.sort(firsts)[:k]]:
                    found.append((int(query), int(c_ids[at][i]), float(score[i])))
        return pa.table({
            "query_id": pa.array([f[0] for f in found], pa.int64()), "vec_id": pa.array([f[1] for f in found], pa.int64()),
            "score": pa.array([f[2] for f in found], pa.float64()),
        })

    pairs = queries.groupBy("q_dimension", "q_table", "q_bucket", "q_i", "q_j").cogroup(
        candidates.groupBy("dimension", "table", "bucket", "i", "j")
    ).applyInArrow(rank, "query_id bigint, vec_id bigint, score double")
    return pairs.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
