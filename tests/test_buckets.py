"""Stages in buckets, and stages of several writers."""

import os
from multiprocessing.pool import ThreadPool

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardspan.plans import registry
from wardspan.sources.stage import bucketed_stage, files_mark, stage

FOLDER = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_features_join_from_buckets_without_an_exchange(spark, no_broadcast):
    staged = _plan(registry._staged(spark, FOLDER, 4))
    assert staged.count("SortMergeJoin") == 3 and "Exchange" not in staged and "SelectedBucketsCount: 4 out of 4" in staged


def test_buckets_are_reused_and_registered_again(spark, no_broadcast, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(100).select((F.col("id") * 7 % 31).alias("k"), F.col("id").alias("a b.c"))

    def kept():
        return bucketed_stage(spark, str(tmp_path), "t", {"x": 1}, build, "k", 3)

    want = rows(build())
    assert rows(kept()) == want and rows(kept()) == want and len(built) == 2
    name = next(t.name for t in spark.catalog.listTables() if t.name.startswith("wardspan_t_"))
    spark.sql(f"DROP TABLE `{name}`")  # as a new session starts
    assert rows(kept()) == want and len(built) == 2
    joined = kept().join(kept().groupBy("k").count(), "k")
    assert "Exchange" not in _plan(joined) and joined.count() == 100
    files = list(tmp_path.glob("t/*/part-*"))
    assert len(files) == 3 and not list(tmp_path.glob("t/*attempt*"))
    bucketed_stage(spark, str(tmp_path), "t", {"x": 2}, build, "k", 3)
    assert len(built) == 3


def test_concurrent_writers_leave_one_whole_table(spark, tmp_path):
    def build(writer):
        return stage(spark, str(tmp_path), "t", {}, lambda: spark.range(1000).select("id", F.lit(writer).alias("writer")))

    with ThreadPool(6) as pool:
        tables = pool.map(lambda w: build(w).select("id", "writer").collect(), range(6))
    final = stage(spark, str(tmp_path), "t", {}, lambda: pytest.fail("built again"))
    assert final.count() == 1000 and final.select("writer").distinct().count() == 1
    assert all(len(t) == 1000 and len({r["writer"] for r in t}) == 1 for t in tables)
    assert not list(tmp_path.glob("t/*attempt*"))


def test_unfinished_folder_is_replaced(spark, tmp_path):
    stage(spark, str(tmp_path), "t", {}, lambda: spark.range(5))
    done = next(tmp_path.glob("t/*"))
    (done / "_SUCCESS").unlink()
    assert stage(spark, str(tmp_path), "t", {}, lambda: spark.range(7)).count() == 7


def test_mark_follows_the_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("1")
    first = files_mark(spark, str(tmp_path))
    assert first == files_mark(spark, str(tmp_path)) and first[:2] == [1, 1]
    os.utime(tmp_path / "a" / "x.csv", (1, 1))
    second = files_mark(spark, str(tmp_path))
    (tmp_path / "y.csv").write_text("22")
    third = files_mark(spark, str(tmp_path))
    assert first[2] != second[2] != third[2] and third[:2] == [2, 3]
