from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardspan.functions.seeded import seeded_hash, standard_normal, uniform
from wardspan.operators.ranking import kfold, seeded_rank, stratified_split, undersample


def _labelled(spark, sizes):
    data = [(i * 100 + label, label) for label, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(data, "id long, label int")


@pytest.mark.parametrize("strata", [[], ["label"]])
def test_rank_equals_one_window(spark, strata):
    df = spark.range(2000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("label"))
    w = W.partitionBy(*strata).orderBy(seeded_hash(5, "id"), "id")
    want = rows(df.withColumn("rank", F.row_number().over(w)), "id", "rank")
    for digits in (1, 3):
        for parts in (1, 7):
            got = seeded_rank(df.repartition(parts), "id", 5, strata, digits)
            assert rows(got, "id", "rank") == want


def test_split_per_label(spark):
    split = stratified_split(_labelled(spark, {0: 10, 1: 5}), "id", "label")
    assert rows(split.groupBy("label", "is_test").count()) == [(0, 0, 8), (0, 1, 2), (1, 0, 4), (1, 1, 1)]


def test_split_with_more_labels_and_sizes(spark):
    split = stratified_split(_labelled(spark, {0: 11, 1: 1, 2: 6}), "id", "label")
    assert rows(split.where("is_test = 1").groupBy("label").count()) == [(0, 3), (1, 1), (2, 2)]


def test_folds_are_even_and_cover(spark):
    folds = kfold(spark.range(23), "id", 10)
    sizes = Counter(r["fold"] for r in folds.collect())
    assert sorted(sizes.values(), reverse=True) == [3, 3, 3, 2, 2, 2, 2, 2, 2, 2]
    assert sorted(sizes) == list(range(10))
    assert rows(folds) == rows(kfold(spark.range(23).repartition(7), "id", 10))


def test_stratified_folds_are_even_per_label(spark):
    folds = kfold(_labelled(spark, {0: 30, 1: 12}), "id", 5, strata=["label"])
    sizes = rows(folds.groupBy("label", "fold").count())
    assert {n for label, _, n in sizes if label == 0} == {6}
    assert {n for label, _, n in sizes if label == 1} == {2, 3}


def test_undersample_to_the_smallest_class(spark):
    kept = undersample(_labelled(spark, {0: 50, 1: 8, 2: 20}), "id", "label")
    assert rows(kept.groupBy("label").count()) == [(0, 8), (1, 8), (2, 8)]


def test_random_numbers_look_random(spark):
    stats = (
        spark.range(20000)
        .select(uniform(1, "id").alias("u"), standard_normal(1, "id").alias("z"))
        .agg(F.min("u"), F.max("u"), F.avg("u"), F.avg("z"), F.stddev("z"), F.corr("u", "z"))
        .first()
    )
    assert 0 < stats[0] < 0.001 and 0.999 < stats[1] < 1
    assert abs(stats[2] - 0.5) < 0.01 and abs(stats[3]) < 0.03
    assert abs(stats[4] - 1) < 0.03 and abs(stats[5]) < 0.03


def test_strata_of_several_columns_stay_apart(spark):
    pairs = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("", "c")]
    df = spark.createDataFrame([(i, *pairs[i % 4]) for i in range(80)], "id long, x string, y string")
    folds = kfold(df, "id", 5, strata=["x", "y"]).groupBy("x", "y", "fold").count()
    assert {r["count"] for r in folds.collect()} == {4} and folds.count() == 20
