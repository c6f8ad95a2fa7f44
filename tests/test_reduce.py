"""Bloom-filter reduction ahead of the aggregates, against plain semi-joins."""

import pytest
from pyspark.sql import functions as F

from wardspan.operators.labs import lab_features
from wardspan.operators.reduce import bloom_filter, filter_bits, keep_wanted
from wardspan.plans import roles

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def facts(spark):
    rows = spark.range(40_000).select((F.col("id") * 7919 - 90_000).alias("k"), F.lit(1).alias("v"))
    return rows.unionByName(spark.createDataFrame([(None, 1), (None, 2)], "k long, v int"))


def test_every_wanted_row_stays_and_few_others(facts):
    wanted = facts.where("k % 10 = 0").select("k")
    kept = keep_wanted(facts, wanted, "k")
    assert kept.join(wanted, "k", "left_semi").count() == wanted.count() == 4_000
    # One in a hundred of 36,000 others is expected.
    assert 4_000 <= kept.count() <= 4_000 + 1_000
    assert kept.where("k is null").count() == 0


def test_ends(facts):
    none = facts.where("false").select("k")
    assert keep_wanted(facts, none, "k").count() == 0
    assert keep_wanted(none, facts.select("k"), "k").count() == 0
    assert keep_wanted(facts, facts.select("k"), "k").count() == 40_000
    # Too many keys for the largest filter: only rows without a key go.
    assert keep_wanted(facts, facts.where("k > 0").select("k"), "k", max_bits=1 << 12).count() == 40_000
    assert filter_bits(0) == 1 << 10 and filter_bits(1000) == 1 << 14 and filter_bits(1 << 27) is None


def test_filter_is_a_row_of_bounded_size(facts):
    words = bloom_filter(facts, "k", 1 << 19).collect()
    assert len(words) == 1 and len(words[0]["words"]) == 1 << 13
    again = bloom_filter(facts.repartition(7), "k", 1 << 19).collect()
    assert words == again


def test_filter_lies_below_the_aggregate(spark):
    kept = roles.admissions(spark, FOLDER).where(F.col("admission_type") == "1-URGENT").select("hadm_id")
    events = roles.labevents(spark, FOLDER)
    reduced = keep_wanted(events, kept, "hadm_id")
    # Rows into the aggregate: those of kept admissions and one in a hundred of the rest.
    of_kept = events.join(kept, "hadm_id", "left_semi").count()
    assert of_kept <= reduced.count() <= of_kept + 0.03 * events.count()
    plan = lab_features(reduced)._jdf.queryExecution().optimizedPlan().toString()
    aggregate, condition = plan.index("Aggregate [hadm_id"), plan.index("scalar-subquery")
    assert aggregate < condition and "Join" not in plan[aggregate:condition]
    want = lab_features(events).join(kept, "hadm_id", "left_semi")
    got = lab_features(reduced).join(kept, "hadm_id", "left_semi")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_filter_is_sent_once_with_each_scan(spark):
    """Each mention of the subquery would send the whole filter along once more."""
    kept = roles.admissions(spark, FOLDER).select("hadm_id")
    plan = keep_wanted(roles.labevents(spark, FOLDER), kept, "hadm_id")._jdf.queryExecution().optimizedPlan().toString()
    condition = next(line for line in plan.splitlines() if "Filter" in line and "scalar-subquery" in line)
    assert condition.count("scalar-subquery") == 1


def test_few_others_pass_a_full_filter(spark):
    # 6,500 keys in 2^16 bits: ten bits a key, as full as a filter gets.
    facts = spark.range(106_500).select((F.col("id") * 7919 - 90_000).alias("k"))
    wanted = facts.where(F.expr("(k + 90000) div 7919 < 6500"))
    kept = keep_wanted(facts, wanted, "k", max_bits=1 << 16)
    assert kept.join(wanted, "k", "left_semi").count() == 6_500
    assert kept.count() <= 6_500 + 3_000
