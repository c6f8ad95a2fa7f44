"""The physical plans behind the scale claims."""

import re

import pytest
from fixtures import ADMISSIONS, DIAGNOSES, LABEVENTS, PATIENTS, code_tables
from pyspark.sql import functions as F

from wardspan.operators.comorbidity import comorbidity_scores
from wardspan.operators.impute import median_table
from wardspan.operators.labs import LAB_ITEMS, lab_features
from wardspan.operators.ranking import stratified_split
from wardspan.plans.features import FeatureParams, Sources, cohort
from wardspan.sources import schemas


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return re.findall(r"Exchange (\w+)\(([^)]*)\)", re.sub(r"#\d+L?", "", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The fixture tables as parquet, with a column nobody asks for."""
    folder = tmp_path_factory.mktemp("tables")
    tables = {
        "admissions": (ADMISSIONS, schemas.ADMISSIONS),
        "patients": (PATIENTS, schemas.PATIENTS),
        "diagnoses": (DIAGNOSES, schemas.DIAGNOSES),
        "labevents": (LABEVENTS, schemas.LABEVENTS),
    }
    out = {}
    for name, (data, schema) in tables.items():
        path = str(folder / name)
        spark.createDataFrame(data, schema).withColumn("extra", F.lit("x")).write.parquet(path)
        out[name] = spark.read.parquet(path)
    return out


@pytest.fixture()
def no_broadcast(spark):
    """Plans as for tables far too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_labs_filter_at_the_scan_and_hash_once(stored):
    text = plan(lab_features(stored["labevents"]))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: (.*)", text)
    assert "In(itemid" in pushed.group(1) and "IsNotNull(hadm_id)" in pushed.group(1)
    assert "extra" not in pushed.group(2)
    assert len(shuffles(text)) == 1 and "SortAggregate" not in text and "partial_max_by" in text


def test_an_unused_lab_item_is_pruned(stored):
    labs = lab_features(stored["labevents"], LAB_ITEMS).drop("lab_troponin_i_max")
    assert "itemid = 51002" not in plan(labs).replace("#", "").split("Filter")[0]


def test_windows_and_patient_join_share_a_shuffle(stored, spark, no_broadcast):
    sources = Sources(stored["admissions"], stored["patients"], *[None] * 3, *code_tables(spark))
    text = plan(cohort(sources, FeatureParams(horizons={"a": 30, "b": 365})))
    by_patient = [keys for kind, keys in shuffles(text) if keys.startswith("subject_id")]
    assert len(by_patient) == 2  # one for the admissions, one for the patients
    assert len(shuffles(text)) == 2
    assert text.count("lead(") == 1


def test_comorbidity_needs_one_shuffle_of_the_diagnoses(stored, spark):
    text = plan(comorbidity_scores(stored["diagnoses"], *code_tables(spark)))
    assert [k for _, k in shuffles(text)].count("hadm_id, 4") == 1
    assert "partial_bit_or" in text and "Generate" not in text


def test_ranks_never_gather_a_label(spark, no_broadcast):
    df = spark.range(100).withColumn("label", F.col("id") % 2)
    text = plan(stratified_split(df, "id", "label"))
    main = [keys for kind, keys in shuffles(text) if keys.startswith("_stratum, _bucket")]
    assert len(main) == 3  # the rows; their counts; the summed counts
    assert text.count("SortMergeJoin") == 1
    # Only the table of counts is gathered by stratum.
    gathered = re.search(r"hashpartitioning\(_stratum, 4\)(.*)", re.sub(r"#\d+L?", "", text), re.S)
    assert "HashAggregate(keys=[_stratum, _bucket]" in gathered.group(1)
    assert "SinglePartition" not in text


def test_medians_do_not_gather_values(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("x"))
    text = plan(median_table(df, ["x"]))
    assert "percentile(" not in text and "percentile_approx" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_hot_patients_still_cost_one_shuffle_of_the_admissions(stored, spark, no_broadcast):
    sources = Sources(stored["admissions"], stored["patients"], *[None] * 3, *code_tables(spark))
    text = re.sub(r"#\d+L?", "", plan(cohort(sources, FeatureParams(min_rows=1))))
    assert text.count("REPARTITION_BY_COL") == 1
    rows_sorted = "Sort [subject_id ASC NULLS FIRST, _piece ASC NULLS FIRST, admittime"
    assert text.count(rows_sorted) == 1 and text.count("lead(") == 1
    # By patient alone only the summary of the pieces is ever gathered.
    for part in text.split("Exchange hashpartitioning(subject_id, 4)")[1:]:
        assert part.split("\n")[1].lstrip(" :+-").startswith("HashAggregate(keys=[subject_id, _piece]")
