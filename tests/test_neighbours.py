"""Nearest rows against brute force, with copies and several query blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meanline.operators.neighbours import Search, centres, nearest


@pytest.mark.parametrize("block_bytes", [16, 32 << 20])
def test_nearest_rows_with_a_third_of_copies(spark, block_bytes):
    i = F.col("id")
    point = F.when(i % 3 == 0, F.array(F.lit(1.0), F.lit(1.0))).otherwise(
        F.array((i % 17).cast("double"), (i % 23).cast("double"))
    )
    rows = spark.range(600).repartition(4).select("id", point.alias("v"), (i % 4).alias("label"))
    queries = centres(rows, "v", "label")
    got = {(r["query_id"], r["rank"]): (r["row_id"], r["distance"])
           for r in nearest(rows, "id", "v", queries, 12, block_bytes).collect()}
    data = rows.collect()
    for query in queries.collect():
        far = [(float(np.sqrt(((np.array(r["v"]) - np.array(query["query"])) ** 2).sum())), r["id"]) for r in data]
        for rank, (distance, row_id) in enumerate(sorted(far)[:12], start=1):
            assert got[query["query_id"], rank] == (row_id, pytest.approx(distance))
    assert len(got) == 4 * 12


def test_no_queries_and_no_rows(spark):
    rows = spark.createDataFrame([(1, [0.0, 1.0])], "id bigint, v array<double>")
    none = spark.createDataFrame([], "query_id bigint, query array<double>")
    one = spark.createDataFrame([(7, [0.0, 0.0])], "query_id bigint, query array<double>")
    assert nearest(rows, "id", "v", none, 3).collect() == []
    assert nearest(rows.limit(0), "id", "v", one, 3).collect() == []
    assert [tuple(r) for r in nearest(rows, "id", "v", one, 3).collect()] == [(7, 1, 1, 1.0)]


def _plain(rows, ids, points, k):
    far = np.sqrt(((points[:, None, :] - rows[None]) ** 2).sum(axis=2))
    return [[(far[q, i], ids[i]) for i in np.lexsort([ids, far[q]])[:k]] for q in range(len(points))]


@pytest.mark.parametrize("seed", range(4))
def test_search_in_batches_is_exact(seed):
    draw = np.random.default_rng(seed)
    rows = np.round(draw.normal(size=(2500, 3)) * 3)  # many ties
    ids, points = draw.permutation(2500), np.round(draw.normal(size=(70, 3)) * 3)
    search = Search(points, 9)
    for part in np.array_split(np.arange(2500), 3):
        search.show(rows[part], ids[part])
    assert [list(zip(d, i, strict=True)) for d, i in zip(search.distance, search.id, strict=True)] == _plain(rows, ids, points, 9)


def test_search_compares_few_of_clustered_rows():
    draw = np.random.default_rng(1)
    homes = draw.uniform(-1000, 1000, (30, 24))
    rows = homes[draw.integers(0, 30, 10_000)] + draw.normal(size=(10_000, 24))
    points = homes[draw.integers(0, 30, 300)] + draw.normal(size=(300, 24))
    search = Search(points, 5)
    search.show(rows, np.arange(10_000))
    want = _plain(rows, np.arange(10_000), points, 5)
    assert [list(i) for i in search.id] == [[i for _, i in row] for row in want]
    assert search.compared < 0.2 * len(rows) * len(points)
