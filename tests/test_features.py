import pytest
from conftest import rows
from fixtures import KEPT, sources
from pyspark.sql import functions as F

from wardspan.operators import admissions as adm
from wardspan.operators.comorbidity import comorbidity_scores
from wardspan.operators.impute import fill_from, median_impute, median_table
from wardspan.operators.label import HORIZONS, readmit_labels
from wardspan.operators.labs import LAB_ITEMS, align, lab_features
from wardspan.plans.features import FeatureParams, assemble, build_features

# min_rows 1 cuts every patient with several admissions into pieces.
CUTTING = [1_000_000, 1]


@pytest.mark.parametrize("min_rows", CUTTING)
def test_prior_count_sees_every_type(spark, min_rows):
    got = rows(adm.prior_admissions(sources(spark).admissions, min_rows), "hadm_id", "prior_admissions")
    prior = {101: 0, 102: 1, 103: 2, 104: 3, 201: 0, 202: 1, 203: 2, 204: 3, 301: 0}
    assert got == sorted(prior.items())


@pytest.mark.parametrize("min_rows", CUTTING)
def test_labels_at_three_horizons(spark, min_rows):
    got = readmit_labels(sources(spark).admissions, adm.of_type(), HORIZONS, min_rows=min_rows)
    assert rows(got, "hadm_id", "gap_days", *HORIZONS) == [
        (101, 1972, 0, 0, 0),
        (103, -1, 1, 1, 1),
        (104, None, 0, 0, 0),
        (201, 365, 0, 1, 1),
        (202, 366, 0, 0, 1),
        (203, -1, 1, 1, 1),
        (204, None, 0, 0, 0),
        (301, None, 0, 0, 0),
    ]


def test_label_options(spark):
    got = readmit_labels(
        sources(spark).admissions, adm.of_type(), {"r": 400}, min_gap_days=0, censored=True
    )
    by_id = {r[0]: r[1:] for r in rows(got, "hadm_id", "r", "censored")}
    assert by_id[103] == (0, 0)  # starts before discharge
    assert by_id[201] == (1, 0)
    assert by_id[204] == (0, 1)


def test_age_flag(spark):
    s = sources(spark)
    got = dict(rows(adm.with_age_flag(s.admissions, s.patients), "hadm_id", "age_65_plus"))
    assert got == {101: 0, 102: 0, 103: 1, 104: 1, 201: 1, 202: 1, 203: 1, 204: 1, 301: 0}


def test_one_hot_has_a_column_per_listed_type(spark):
    kept = sources(spark).admissions.where(adm.of_type())
    got = adm.encode_types(kept, [*adm.ADMISSION_TYPES, "NEVER"])
    assert rows(got, "hadm_id", "admission_type_EW EMER.", "admission_type_NEVER")[2] == (104, 1, 0)
    flags = [c for c in got.columns if c.startswith("admission_type_")]
    total = sum((F.col(f"`{c}`") for c in flags), F.lit(0))
    assert got.where(total != 1).count() == 0


def test_types_can_be_found_in_the_data(spark):
    stays = sources(spark).admissions
    found = adm.categories(stays, "admission_type")
    assert len(found) == 6 and found == sorted(found)
    assert "admission_type_AMBULATORY OBSERVATION" in adm.encode_types(stays, None).columns
    with pytest.raises(ValueError, match="more than 3"):
        adm.categories(stays, "admission_type", 3)


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
@pytest.mark.parametrize("mask_groups", [248, 2])
def test_comorbidity(spark, broadcast_rows, mask_groups):
    s = sources(spark)
    got = comorbidity_scores(
        s.diagnoses, s.code_map, s.weights, None, mask_groups, broadcast_rows, min_rows=1
    )
    assert rows(got, "hadm_id", "elix_readmit", "elix_mortality", "has_chronic") == [
        (101, 5.0, -1.0, 1),
        (103, 0.0, 0.0, 0),
        (201, 7.0, 9.0, 1),
    ]


@pytest.mark.parametrize("mask_groups", [248, 2])
def test_comorbidity_with_many_groups(spark, mask_groups):
    """More groups than one number has bits, codes in several groups, a group
    without weights."""
    pairs = [(f"C{i}", f"G{j}") for i in range(100) for j in (i, (i * 7) % 100)]
    code_map = spark.createDataFrame(pairs, "icd_code string, comorbidity string")
    weights = spark.createDataFrame(
        [(f"G{j}", float(j), -1.0) for j in range(99)],
        "comorbidity string, w_readmit double, w_mortality double",
    )
    dx = [(h, f"c.{i}") for h in range(30) for i in range(h, 100, 13)]
    got = comorbidity_scores(
        spark.createDataFrame(dx, "hadm_id long, icd_code string"), code_map, weights, None, mask_groups
    )
    want = []
    for h in range(30):
        groups = {j for i in range(h, 100, 13) for j in (i, (i * 7) % 100)}
        known = groups - {99}
        want.append((h, float(sum(known)), -float(len(known)), 1))
    assert rows(got) == want


def test_comorbidity_by_code_version(spark):
    s = sources(spark)
    dx = s.diagnoses.withColumn("icd_version", F.when(F.col("hadm_id") == 101, 9).otherwise(10))
    code_map = s.code_map.withColumn("icd_version", F.lit(10))
    got = comorbidity_scores(dx, code_map, s.weights, version="icd_version")
    assert rows(got, "hadm_id", "has_chronic") == [(101, 0), (103, 0), (201, 1)]


def test_prescription_counts(spark):
    got = adm.prescription_counts(sources(spark).prescriptions)
    assert rows(got, "hadm_id", "num_prescriptions") == [(101, 3), (201, 1)]


def test_labs_pass_over_missing_results(spark):
    got = lab_features(sources(spark).labevents)
    assert [c for c in got.columns if c.startswith("lab_")] == [
        c for item in LAB_ITEMS for c in item.columns
    ]
    columns = ("lab_creatinine_max", "lab_creatinine_last", "lab_sodium_mean", "lab_crp_max")
    assert rows(got, "hadm_id", *columns) == [
        (101, 3.0, 3.0, 140.0, None),
        (104, None, None, None, None),
        (201, 2.0, 2.0, None, None),
    ]


def test_labs_last_follows_the_order_key(spark):
    events = spark.createDataFrame(
        [(1, 50912, 5.0, 30), (1, 50912, 1.0, 10), (1, 50912, 4.0, 40), (1, 50912, None, 50)],
        "hadm_id long, itemid int, valuenum double, labevent_id long",
    )
    assert rows(lab_features(events), "lab_creatinine_last") == [(4.0,)]


def test_align_is_a_full_outer_join(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "id int, a double")
    b = spark.createDataFrame([(2, 3.0), (3, 4.0)], "id int, b double")
    assert rows(align([a, b], "id")) == [(1, 1.0, None), (2, 2.0, 3.0), (3, None, 4.0)]


def test_medians_of_the_kept_admissions(spark):
    wide = assemble(sources(spark))
    medians = median_table(wide, FeatureParams().lab_columns).first().asDict()
    assert medians.pop("lab_creatinine_max") == 2.5
    assert medians.pop("lab_creatinine_last") == 2.5
    assert medians.pop("lab_sodium_mean") == 140.0
    assert set(medians.values()) == {0.0}


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 1001])
def test_median_is_exact_under_a_coarse_sketch(spark, n):
    df = spark.range(n).select(
        F.pmod(F.xxhash64("id"), F.lit(500)).cast("double").alias("a"),
        F.when(F.col("id") % 3 > 0, (F.col("id") - 5) / 7).alias("b"),
        F.lit(4.0).alias("same"),
        F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("id")).alias("nan"),
        F.lit(None).cast("double").alias("none"),
    )
    got = median_table(df, df.columns, accuracy=20).first()
    clean = df.withColumn("nan", F.when(~F.isnan("nan"), F.col("nan")))
    want = clean.agg(*[F.median(c).alias(c) for c in ("a", "b", "same", "nan")]).first()
    for c in ("a", "b", "same", "nan"):
        assert got[c] == (want[c] if want[c] is not None else 0.0)
    assert got["none"] == 0.0


def test_fill_uses_other_rows_when_fitted_there(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    test = spark.createDataFrame([(None,), (100.0,)], "x double")
    assert rows(fill_from(test, median_table(train, ["x"]), ["x"])) == [(2.0,), (100.0,)]
    assert rows(median_impute(test, ["x"])) == [(100.0,), (100.0,)]


@pytest.mark.parametrize("min_rows", CUTTING)
def test_feature_table(spark, min_rows):
    params = FeatureParams(horizons={"readmit": 365.24}, min_rows=min_rows)
    got = build_features(sources(spark), params)
    assert got.columns == ["hadm_id", "readmit", *params.features]
    assert len(params.features) == 25
    by_id = {r["hadm_id"]: r.asDict() for r in got.collect()}
    assert sorted(by_id) == KEPT
    assert [by_id[h]["readmit"] for h in KEPT] == [0, 1, 0, 1, 0, 1, 0, 0]
    assert [by_id[h]["prior_admissions"] for h in KEPT] == [0, 2, 3, 0, 1, 2, 3, 0]
    assert by_id[101]["elix_readmit"] == 5.0 and by_id[301]["elix_readmit"] == 0.0
    assert by_id[101]["num_prescriptions"] == 3 and by_id[104]["num_prescriptions"] == 0
    assert by_id[103]["lab_creatinine_max"] == 2.5 and by_id[103]["lab_hemoglobin_max"] == 0.0
    assert by_id[301]["admission_type_SURGICAL SAME DAY ADMISSION"] == 1


def test_comorbidity_refuses_repeated_weights(spark):
    import pytest

    s = sources(spark)
    twice = s.weights.unionByName(s.weights.limit(1))
    for mask_groups in (0, 248):
        with pytest.raises(ValueError, match="more than one weight row"):
            comorbidity_scores(s.diagnoses, s.code_map, twice, mask_groups=mask_groups)
