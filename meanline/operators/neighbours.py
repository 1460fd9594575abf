"""Exact nearest rows to a set of query vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meanline.sources.storage import shared_table

#: Query vectors sent to every task at a time, in bytes.
BLOCK_BYTES = 32 << 20


def centres(df: DataFrame, vector: str, label: str) -> DataFrame:
    """(query_id, query): the mean vector of every label, summed up map-side vector by vector."""
    vectors = df.select(F.col(label).alias("query_id"), array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    means = vectors.groupBy("query_id").agg(Summarizer.mean(F.col("_v")).alias("_m"))
    return means.select("query_id", vector_to_array("_m").alias("query"))


def nearest(
    df: DataFrame, row_id: str, vector: str, queries: DataFrame, k: int, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The ``k`` nearest rows of every query by Euclidean distance: (query_id, rank, row_id, distance).

    Query vectors go to the tasks by broadcast, in blocks of bounded size with one pass over the rows each.
    A task keeps its own best ``k`` per query, so what is shuffled is k rows per query and task, not one per
    pair; rows that the triangle inequality rules out are not compared, see `Search`.
    """
    spark = df.sparkSession
    queries = shared_table(queries, "queries")  # computed once, read again for every block
    extent = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("query")).alias("width")).first()
    blocks = -(-(extent["n"] * (extent["width"] or 1) * 8) // block_bytes)
    rows = df.select(F.col(row_id).alias("row_id"), F.col(vector).alias("v"))
    found = spark.createDataFrame([], _FOUND)
    for block in range(blocks):
        chosen = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).collect()
        if chosen:
            ids = np.array([row["query_id"] for row in chosen], np.int64)
            points = spark.sparkContext.broadcast((ids, np.array([row["query"] for row in chosen], float)))
            found = found.unionByName(rows.mapInPandas(_best_of_task(points, k), _FOUND))
    order = Window.partitionBy("query_id").orderBy("distance", "row_id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "row_id", "distance").where(
        F.col("rank") <= k
    )


_FOUND = "query_id bigint, row_id bigint, distance double"
#: Pivots of a batch, at most.
_PIVOTS = 32


class Search:
    """The ``k`` nearest of the rows shown so far to each query, in the order of distance and id.

    Rows of a batch are dealt to pivots among themselves, chosen far apart, and ordered by their distance to
    the pivot.  A row is at least as far from a query as their distances to the pivot differ, so for each
    query only a stretch of each cell is compared, the nearest cells first.  ``compared`` counts the
    distances computed, those to the pivots included.
    """

    def __init__(self, points: np.ndarray, k: int) -> None:
        self.points, self.k, self.compared = points, k, 0
        self.distance = np.full((len(points), k), np.inf)
        self.id = np.full((len(points), k), np.iinfo(np.int64).max)

    def show(self, rows: np.ndarray, ids: np.ndarray) -> None:
        pivots = min(_PIVOTS, int(np.sqrt(len(rows))))
        if len(self.points) <= pivots:  # finding the cells would cost more than all distances
            for query in range(len(self.points)):
                self._keep(query, rows, ids)
            return
        chosen, to_pivot = [0], self._far(rows, rows[0])[:, None]
        while len(chosen) < pivots:
            chosen.append(int(to_pivot.min(axis=1).argmax()))
            to_pivot = np.column_stack([to_pivot, self._far(rows, rows[chosen[-1]])])
        cell, near = to_pivot.argmin(axis=1), to_pivot.min(axis=1)
        order = np.lexsort([near, cell])
        rows, ids, near = rows[order], ids[order], near[order]
        ends = np.searchsorted(cell[order], np.arange(pivots + 1))
        asked = np.column_stack([self._far(self.points, rows_of) for rows_of in self._pivot_rows(chosen, order, rows)])
        for query in range(len(self.points)):
            for c in np.argsort(asked[query]):
                begin, end = ends[c], ends[c + 1]
                reach = self.distance[query, -1] * (1 + 1e-9) + 1e-12
                low = begin + np.searchsorted(near[begin:end], asked[query, c] - reach, "left")
                high = begin + np.searchsorted(near[begin:end], asked[query, c] + reach, "right")
                # the middle of the stretch first: it narrows the rest
                middle = begin + np.searchsorted(near[begin:end], asked[query, c])
                first, last = max(low, middle - _STEP), min(high, middle + _STEP)
                if first >= last:
                    first = last = low
                else:
                    self._keep(query, rows[first:last], ids[first:last])
                reach = self.distance[query, -1] * (1 + 1e-9) + 1e-12
                inner = begin + np.searchsorted(near[begin:end], asked[query, c] - reach, "left")
                outer = begin + np.searchsorted(near[begin:end], asked[query, c] + reach, "right")
                for a, b in ((max(low, inner), first), (last, min(high, outer))):
                    if a < b:
                        self._keep(query, rows[a:b], ids[a:b])

    @staticmethod
    def _pivot_rows(chosen: list[int], order: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return (rows[place[i]] for i in chosen)

    def _far(self, rows: np.ndarray, point: np.ndarray) -> np.ndarray:
        self.compared += len(rows)
        return np.sqrt(((rows - point) ** 2).sum(axis=1))

    def _keep(self, query: int, rows: np.ndarray, ids: np.ndarray) -> None:
        distance = self._far(rows, self.points[query])
        near = distance <= self.distance[query, -1]
        distance = np.concatenate([self.distance[query], distance[near]])
        ids = np.concatenate([self.id[query], ids[near]])
        best = np.lexsort([ids, distance])[: self.k]
        self.distance[query], self.id[query] = distance[best], ids[best]


#: Rows on either side of a query's own distance to the pivot that are compared first.
_STEP = 64


def _best_of_task(shared: Broadcast, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, points = shared.value
        search = Search(points, k)
        for batch in batches:
            if len(batch):
                search.show(np.stack(batch["v"].to_numpy()).astype(float), batch["row_id"].to_numpy())
        query, place = np.nonzero(np.isfinite(search.distance))
        yield pd.DataFrame({
            "query_id": ids[query], "row_id": search.id[query, place], "distance": search.distance[query, place],
        })

    return run
