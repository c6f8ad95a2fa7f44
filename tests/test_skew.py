"""Hot keys: split plans must give what the plain plans give."""

import random

from conftest import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardspan.operators.skew import OrderedGroups, hot_keys, lookup, salted_lookup


def _table(spark, n=3000):
    """A third of the rows under one key, some under NULL."""
    rng = random.Random(1)
    data = []
    for i in range(n):
        key = 7 if i % 3 == 0 else None if i % 50 == 1 else rng.randrange(200)
        data.append((key, rng.randrange(400), i))
    return spark.createDataFrame(data, "key long, t long, id long").repartition(5)


def test_only_keys_over_the_limit_are_hot(spark):
    df = _table(spark)
    assert hot_keys(df, ["key"], 100_000) is None
    assert [r["key"] for r in hot_keys(df, ["key"], 100).collect()] == [7]


def test_cut_groups_agree_with_plain_windows(spark):
    df = _table(spark)
    groups = OrderedGroups(df, "key", ["t", "id"], min_rows=100)
    assert groups.cuts is not None
    hot_pieces = groups.rows.where("key = 7").groupBy("_piece").count()
    assert hot_pieces.count() > 10  # really split
    kept = F.col("id") % 4 != 0
    got = groups.count_before(groups.rows, "before").where(kept)
    got = groups.next_value(got, "t", "next_t", kept)
    names = spark.range(200).select(F.col("id").alias("key"), (F.col("id") * 2).alias("name"))
    got = groups.lookup(got, names)

    w = W.partitionBy("key").orderBy("t", "id")
    want = df.withColumn("before", F.row_number().over(w) - 1).where(kept)
    want = want.withColumn("next_t", F.lead("t").over(w)).join(names, "key", "left")
    columns = ("id", "key", "before", "next_t", "name")
    assert rows(got, *columns) == rows(want, *columns)


def test_ties_on_time_can_still_be_cut(spark):
    df = spark.range(2000).select(F.lit(1).alias("key"), F.lit(5).alias("t"), "id")
    groups = OrderedGroups(df, "key", ["t", "id"], min_rows=100)
    assert groups.rows.select("_piece").distinct().count() > 10
    got = groups.count_before(groups.rows, "before")
    assert got.where("before <> id").count() == 0


def test_salted_lookup_agrees_with_a_plain_join(spark):
    df = _table(spark)
    names = spark.range(150).select(F.col("id").alias("key"), (F.col("id") * 2).alias("name"))
    for how in ("left", "inner"):
        want = rows(df.join(names, "key", how), "id", "key", "t", "name")
        assert rows(salted_lookup(df, names, ["key"], how, min_rows=10), "id", "key", "t", "name") == want
        assert rows(lookup(df, names, ["key"], how, broadcast_rows=10), "id", "key", "t", "name") == want
        assert rows(lookup(df, names, ["key"], how), "id", "key", "t", "name") == want


def test_salted_lookup_spreads_the_hot_key(spark):
    df = _table(spark)
    names = spark.range(200).select(F.col("id").alias("key"), (F.col("id") * 2).alias("name"))
    salted = salted_lookup(df, names, ["key"], min_rows=10)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_next_value_where_the_next_row_has_none(spark):
    """Hot and plain paths agree though some rows of the hot key have no order value."""
    data = [(7, None if i % 50 == 0 else (i * 37) % 900, i) for i in range(2000)]
    df = spark.createDataFrame(data, "key long, t long, id long").repartition(5)
    groups = OrderedGroups(df, "key", ["t", "id"], min_rows=100)
    assert groups.cuts is not None
    w = W.partitionBy("key").orderBy("t", "id")
    want = df.withColumn("next_t", F.lead("t").over(w))
    assert rows(groups.next_value(groups.rows, "t", "next_t"), "id", "next_t") == rows(want, "id", "next_t")
