"""A caller's function on whole groups."""

import sys

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardspan.operators.grouped import apply_grouped

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import a test module

SCHEMA = StructType().add("k", "long").add("n", "long").add("total", "double").add("most", "double")


def summary(rows: pa.Table) -> pa.Table:
    v = rows["v"]
    return pa.table({"most": [pc.max(v).as_py()], "k": rows["k"][:1], "n": [rows.num_rows], "total": [pc.sum(v).as_py()]})


def joined(parts: pa.Table) -> pa.Table:
    return pa.table(
        {
            "k": parts["k"][:1],
            "n": [pc.sum(parts["n"]).as_py()],
            "total": [pc.sum(parts["total"]).as_py()],
            "most": [pc.max(parts["most"]).as_py()],
        }
    )


@pytest.fixture(scope="module")
def table(spark):
    """A third of the rows in group 0, as many without a key, the rest in groups of three."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit(0)).when(i % 3 == 1, F.floor(i / 9) + 1)
    return spark.range(0, 60_000, 1, 6).select(key.cast("long").alias("k"), (i % 1001).cast("double").alias("v"))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


@pytest.mark.parametrize("max_rows, combine", [(1_000_000, None), (1_000, joined), (2, joined)])
def test_whole_groups_or_partials_give_the_same(table, max_rows, combine):
    want = table.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.max("v").alias("most"))
    assert _rows(apply_grouped(table, ["k"], summary, SCHEMA, max_rows, combine)) == _rows(want)


def test_large_groups_are_refused(table):
    with pytest.raises(ValueError, match="no combine.*20000"):
        apply_grouped(table, ["k"], summary, SCHEMA, 1_000)


def test_bad_declarations(table, spark):
    with pytest.raises(ValueError, match="keys in the schema"):
        apply_grouped(table, ["k"], summary, StructType().add("n", "long"), 1_000, joined)
    few = table.where("k = 1")
    with pytest.raises(Exception, match="no column .'other'"):
        apply_grouped(few, ["k"], summary, StructType().add("k", "long").add("other", "long")).collect()
    assert apply_grouped(table.where("false"), ["k"], summary, SCHEMA).collect() == []


def test_many_small_groups_share_a_batch(table, spark):
    # One stream a group took most of the time; now groups are cut out of sorted batches.
    got = apply_grouped(table, ["k"], summary, SCHEMA)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsInArrow" not in plan
    few = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # groups go on over batches
    try:
        want = table.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.max("v").alias("most"))
        assert _rows(apply_grouped(table, ["k"], summary, SCHEMA)) == _rows(want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", few)


@pytest.mark.parametrize("dtype", ["double", "int", "string"])
def test_keys_of_several_types(spark, dtype):
    values = {"double": [0.0, -0.0, None, float("nan"), float("nan")], "int": [1, 1, None, 0, None], "string": ["a", "b", None, "a", None]}
    held = spark.createDataFrame([(v, 1, i % 2) for v in values[dtype] for i in range(4)], f"k {dtype}, v int, `o.p` int")

    def size(rows: pa.Table) -> pa.Table:
        return pa.table({"n": [rows.num_rows]})

    for keys in (["k"], ["k", "o.p"]):
        want = held.groupBy(*[F.col(f"`{k}`") for k in keys]).count()
        got = apply_grouped(held.withColumnRenamed("o.p", "op"), [k.replace(".", "") for k in keys], size, StructType().add("n", "long"))
        assert sorted(r["n"] for r in got.collect()) == sorted(r["count"] for r in want.collect())
