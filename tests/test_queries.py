"""Every registered query against its SQL, row by row."""

import pytest

from __spark_entry__ import oracle_sql, queries
from check import compare

# run below, or beside the operators they belong to
APART = {n for n in queries() if n.startswith(("job_", "rows_of_", "op")) or n in ("elastic_net_cv", "cv_best_row", "pipeline")}
JOBS = sorted(n for n in queries() if n.startswith(("job_", "rows_of_")) or n in ("elastic_net_cv", "cv_best_row"))


@pytest.mark.parametrize("name", sorted(set(queries()) - APART))
def test_query_gives_the_sql_rows(spark, duck, small, name):
    assert compare(spark, duck, name, small) is None


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", JOBS)
def test_job_runs_and_agrees_with_its_sql_if_it_has_one(spark, duck, small, name):
    assert compare(spark, duck, name, small) is None


@pytest.mark.parametrize("name", ["job_tree_month_split_first", "job_linear_month_means"])
def test_job_explains_the_label(spark, small, name):
    quality = queries()[name](spark, small).first()
    assert quality["n_test"] > 0
    assert quality["r2_test"] > 0.8


def test_band_report_holds_300_ranked_rows(spark, small):
    rows = queries()["job_band_report"](spark, "/root/testdata/sf0.01").collect()
    bands = {band: sorted(r["rnk"] for r in rows if r["band"] == band) for band in ("first", "middle", "last")}
    total = bands["last"][-1]
    assert bands["first"] == list(range(1, 101))
    assert bands["middle"] == list(range(total // 2 - 49, total // 2 + 51))
    assert bands["last"] == list(range(total - 99, total + 1))
