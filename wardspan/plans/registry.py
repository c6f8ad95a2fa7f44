"""Every operator as a query over the retail tables in their clinical roles."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from multiprocessing.pool import ThreadPool

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardspan.operators import admissions as adm
from wardspan.operators import evaluate, impute, quality, ranking
from wardspan.operators.comorbidity import comorbidity_scores, normalise_codes
from wardspan.operators.forest import classifier, draw_trials, tune
from wardspan.operators.grouped import apply_grouped
from wardspan.operators.importance import permutation_importance
from wardspan.operators.label import HORIZONS, readmit_labels
from wardspan.operators.labs import LAB_ITEMS, align, lab_features
from wardspan.operators.smote import smote, synthetic_points
from wardspan.operators.stages import Balanced, FeatureVector, MedianFill, MedianFillModel
from wardspan.plans import roles, studies
from wardspan.plans.features import LAB_COLUMNS, build_features, cohort, fill_labs, join_parts, part_builders
from wardspan.plans.training import train_and_evaluate
from wardspan.sources import schemas
from wardspan.sources.readers import read_hospital, read_table
from wardspan.sources.rejects import read_hospital_checked
from wardspan.sources.stage import bucketed_stage, materialise, shared_folder, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6
ALL_LABS = tuple(name for item in LAB_ITEMS for name in item.columns)
TYPE_COLUMNS = tuple(roles.PARAMS.type_columns)
FEATURES = tuple(roles.PARAMS.features)
# One point inside the search ranges, for the queries that do not search.
FOREST = {"numTrees": 50, "maxDepth": 8, "minInstancesPerNode": 3}


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


def big(name: str) -> Column:
    return F.col(f"`{name}`").cast("bigint").alias(name)


def rounded(name: str) -> Column:
    return F.round(F.col(f"`{name}`").cast("double"), DIGITS).alias(name)


# ---- sources and sinks


@query("csv_scan")
def csv_scan(spark, folder):
    """Admissions written as gzip CSV among other columns, read back by name."""
    path = f"{shared_folder(spark)}/wardspan/export-{uuid.uuid4().hex}"
    given = roles.admissions(spark, folder)
    export = given.select(F.lit('a "note", with commas').alias("note"), *reversed(given.columns))
    export.write.options(header=True, compression="gzip", escape='"').csv(path)
    stays = read_table(spark, path, schemas.ADMISSIONS)
    times = [F.col(c).cast("string").alias(c) for c in ("admittime", "dischtime")]
    return stays.select("hadm_id", "subject_id", "admission_type", *times)


EXPORT_KEYS = {"patients": "subject_id"}  # else hadm_id


def _together(spark, function, items):
    """``function`` on each of a few items at the same time, so that small tables share the cluster with large ones."""
    items = list(items)
    with ThreadPool(len(items)) as pool:
        return pool.map(inheritable_thread_target(spark)(function), items, chunksize=1)


def _odd_exports(spark, folder):
    """The folder of the five hospital tables as gzip CSV, with odd ids and values."""
    base = f"{shared_folder(spark)}/wardspan/exports-{uuid.uuid4().hex}"
    tables = {
        "admissions": roles.admissions(spark, folder),
        "patients": roles.patients(spark, folder),
        "diagnoses_icd": roles.diagnoses(spark, folder),
        "prescriptions": roles.prescriptions(spark, folder),
        "labevents": roles.labevents(spark, folder).withColumn("labevent_id", F.col("hadm_id")),
    }

    def write(given):
        name, table = given
        key = EXPORT_KEYS.get(name, "hadm_id")
        number = F.col(key)
        odd = F.when(number % 97 == 0, "n/a").when(number % 2 == 0, F.concat(number.cast("string"), F.lit(".0")))
        dirty = {key: F.coalesce(odd, number.cast("string"))}
        if name == "labevents":
            dirty["valuenum"] = F.when(number % 89 == 0, "NaN").otherwise(F.col("valuenum").cast("string"))
        export = table.withColumns(dirty).select(F.lit('a "note", with commas').alias("note"), *reversed(table.columns))
        export.write.options(header=True, compression="gzip", escape='"').csv(f"{base}/hosp/{name}.csv.gz")

    _together(spark, write, tables.items())
    return base


@query("hospital_scan")
def hospital_scan(spark, folder):
    """The five hospital tables as gzip CSV, with odd ids and values, read back: what each holds."""
    values = {
        "admissions": F.col("subject_id"),
        "patients": F.col("anchor_age"),
        "diagnoses_icd": F.length("icd_code"),
        "prescriptions": F.col("hadm_id"),
        "labevents": F.col("valuenum"),
    }
    held = [
        table.select(
            F.lit(name).alias("table_name"),
            F.col(EXPORT_KEYS.get(name, "hadm_id")).alias("id"),
            values[name].cast("double").alias("value"),
        )
        for name, table in read_hospital(spark, _odd_exports(spark, folder)).items()
    ]
    return reduce(DataFrame.unionByName, held).groupBy("table_name").agg(
        F.count("*").alias("n"),
        F.count("id").alias("n_ids"),
        F.sum("id").alias("sum_ids"),
        F.count("value").alias("n_values"),
        F.round(F.sum("value"), 2).alias("sum_values"),
    )


@query("scan_rejects")
def scan_rejects(spark, folder):
    """Unreadable values of the odd exports by column: those counted while the tables
    are written, and those in the rejected rows."""
    scans = read_hospital_checked(spark, _odd_exports(spark, folder))
    _together(spark, lambda scan: materialise(scan[1].table, scan[0]), scans.items())
    counted, held = [], []
    for name, scan in scans.items():
        counts = scan.counts()
        counted += [(name, c, counts["rows"], n) for c, n in counts.items() if c != "rows"]
        held.append(scan.rejected.select(F.lit(name).alias("table_name"), F.explode("unreadable").alias("column_name")))
    rejected = reduce(DataFrame.unionByName, held).groupBy("table_name", "column_name").agg(F.count("*").alias("n_rejected"))
    seen = spark.createDataFrame(counted, "table_name string, column_name string, n_rows long, n_unreadable long")
    return seen.join(rejected, ["table_name", "column_name"], "left").na.fill(0, ["n_rejected"])


@query("stage_reuse")
def stage_reuse(spark, folder):
    """A stage built once, then answered from its table."""
    base = f"{shared_folder(spark)}/wardspan/stages-{uuid.uuid4().hex}"

    def kept():
        return stage(
            spark,
            base,
            "prescription_counts",
            {"data": folder},
            lambda: adm.prescription_counts(roles.prescriptions(spark, folder)),
        )

    kept()
    return kept().select("hadm_id", big("num_prescriptions"))


# ---- admissions and labels


@query("prior_admissions")
def prior_admissions(spark, folder):
    return adm.prior_admissions(roles.admissions(spark, folder)).select(
        "hadm_id", "subject_id", big("prior_admissions")
    )


@query("admission_type_filter")
def admission_type_filter(spark, folder):
    kept = roles.admissions(spark, folder).where(adm.of_type(roles.TYPES))
    return kept.select("hadm_id", "subject_id", "admission_type")


def _labels(spark, folder, horizons):
    return readmit_labels(roles.admissions(spark, folder), adm.of_type(roles.TYPES), horizons)


@query("readmit_label")
def readmit_label(spark, folder):
    labels = _labels(spark, folder, {"readmit": 365})
    return labels.select("hadm_id", F.col("gap_days").cast("double"), big("readmit"))


@query("readmit_horizons")
def readmit_horizons(spark, folder):
    labels = _labels(spark, folder, HORIZONS)
    return labels.select("hadm_id", *[big(h) for h in HORIZONS])


@query("readmit_label_bounded")
def readmit_label_bounded(spark, folder):
    """Readmissions within the horizon that start after discharge, with a
    flag on each patient's last known admission."""
    labels = readmit_labels(
        roles.admissions(spark, folder),
        adm.of_type(roles.TYPES),
        {"readmit": 365},
        min_gap_days=0,
        censored=True,
    )
    return labels.select("hadm_id", big("readmit"), big("censored"))


@query("age_flag")
def age_flag(spark, folder):
    flagged = adm.with_age_flag(roles.admissions(spark, folder), roles.patients(spark, folder))
    return flagged.select("hadm_id", big("age_65_plus"))


@query("one_hot")
def one_hot(spark, folder):
    kept = roles.admissions(spark, folder).where(adm.of_type(roles.TYPES))
    encoded = adm.encode_types(kept, roles.TYPES)
    return encoded.select("hadm_id", *[big(c) for c in TYPE_COLUMNS])


@query("one_hot_discovered")
def one_hot_discovered(spark, folder):
    """All types found in the data, encoded without a given list."""
    encoded = adm.encode_types(roles.admissions(spark, folder), None)
    flags = [c for c in encoded.columns if c.startswith("admission_type_")]
    return encoded.select("hadm_id", *[big(c) for c in flags])


# ---- diagnoses, prescriptions, labs


@query("code_normalise")
def code_normalise(spark, folder):
    return normalise_codes(roles.diagnoses(spark, folder)).select("hadm_id", "icd_code")


@query("comorbidity_score")
def comorbidity_score(spark, folder):
    scores = comorbidity_scores(
        roles.diagnoses(spark, folder), roles.code_map(spark), roles.weights(spark)
    )
    return scores.select("hadm_id", "elix_readmit", "elix_mortality", big("has_chronic"))


def _score_in_python(code_map, weights):
    """A plain function from the diagnoses of one admission to its row of scores."""
    groups = {}
    for r in normalise_codes(code_map).collect():
        groups.setdefault(r["icd_code"], set()).add(r["comorbidity"])
    weight = {r["comorbidity"]: (r["w_readmit"], r["w_mortality"]) for r in weights.collect()}

    def score(rows: pa.Table) -> pa.Table:
        codes = {c.upper().replace(".", "") for c in rows["icd_code"].to_pylist() if c}
        found = set().union(*[groups.get(c, ()) for c in codes])
        totals = [sum(weight.get(g, (0.0, 0.0))[i] for g in found) for i in (0, 1)]
        return pa.table(
            {"hadm_id": rows["hadm_id"][:1], "elix_readmit": [totals[0]], "elix_mortality": [totals[1]], "has_chronic": [int(bool(found))]}
        )

    return score


@query("comorbidity_by_function")
def comorbidity_by_function(spark, folder):
    """Comorbidity by a caller's plain function on the rows of each admission."""
    score = _score_in_python(roles.code_map(spark), roles.weights(spark))
    schema = StructType.fromDDL("hadm_id long, elix_readmit double, elix_mortality double, has_chronic long")
    return apply_grouped(roles.diagnoses(spark, folder), ["hadm_id"], score, schema)


@query("prescription_counts")
def prescription_counts(spark, folder):
    counts = adm.prescription_counts(roles.prescriptions(spark, folder))
    return counts.select("hadm_id", big("num_prescriptions"))


@query("lab_features")
def lab_features_query(spark, folder):
    labs = lab_features(roles.labevents(spark, folder))
    return labs.select("hadm_id", *[rounded(c) for c in ALL_LABS])


@query("lab_align")
def lab_align(spark, folder):
    """Per-item results of all items put side by side on the admission."""
    events = roles.labevents(spark, folder)
    frames = [lab_features(events, [item]) for item in LAB_ITEMS]
    return align(frames, "hadm_id").select("hadm_id", *[rounded(c) for c in ALL_LABS])


@query("median_impute")
def median_impute(spark, folder):
    labs = materialise(lab_features(roles.labevents(spark, folder)), "labs")
    filled = impute.median_impute(labs, ALL_LABS)
    return filled.select("hadm_id", *[rounded(c) for c in ALL_LABS])


@query("lab_medians")
def lab_medians(spark, folder):
    """The medians alone, one row."""
    labs = materialise(lab_features(roles.labevents(spark, folder)), "labs")
    return impute.median_table(labs, ALL_LABS).select(*[rounded(c) for c in ALL_LABS])


@query("median_fill_applied")
def median_fill_applied(spark, folder):
    """Medians learned on training rows, saved, and applied to the test rows."""
    labs = lab_features(roles.labevents(spark, folder))
    rows = ranking.stratified_split(_labelled(spark, folder), "hadm_id", "readmit").join(labs, "hadm_id", "left")
    rows = materialise(rows.select("hadm_id", "is_test", *ALL_LABS), "labs")
    path = f"{shared_folder(spark)}/wardspan/medians-{uuid.uuid4().hex}"
    MedianFill(inputCols=list(ALL_LABS)).fit(rows.where("is_test = 0")).save(path)
    filled = MedianFillModel.load(path).transform(rows.where("is_test = 1"))
    return filled.select("hadm_id", *[rounded(c) for c in ALL_LABS])


def _staged(spark, folder, buckets):
    """The joined feature rows, from bucketed stages of the cohort and of every aggregate."""
    base, sources = f"{shared_folder(spark)}/wardspan/buckets-{uuid.uuid4().hex}", roles.sources(spark, folder)
    builders = {**part_builders(sources, roles.PARAMS), "cohort": lambda: cohort(sources, roles.PARAMS)}
    parts = {
        name: bucketed_stage(spark, base, name, {"data": folder}, made, "hadm_id", buckets) for name, made in builders.items()
    }
    return join_parts(parts.pop("cohort"), parts, roles.PARAMS)


@query("feature_table_bucketed")
def feature_table_bucketed(spark, folder):
    """The feature table joined from bucketed stages, without an exchange."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _feature_columns(fill_labs(_staged(spark, folder, buckets), roles.PARAMS))


@query("feature_table_reduced")
def feature_table_reduced(spark, folder):
    """The feature table, rows of other admissions dropped before the aggregates shuffle."""
    return _feature_columns(build_features(roles.sources(spark, folder), replace(roles.PARAMS, reduce_first=True)))


@query("feature_table")
def feature_table(spark, folder):
    return _feature_columns(build_features(roles.sources(spark, folder), roles.PARAMS))


def _feature_columns(built):
    return built.select(
        "hadm_id",
        big("readmit"),
        "elix_mortality",
        "elix_readmit",
        *[big(c) for c in ("prior_admissions", "num_prescriptions", "has_chronic", "age_65_plus")],
        *[rounded(c) for c in LAB_COLUMNS],
        *[big(c) for c in TYPE_COLUMNS],
    )


# ---- random order


def _labelled(spark, folder):
    return _labels(spark, folder, {"readmit": 365}).select("hadm_id", big("readmit"))


@query("stratified_split")
def stratified_split(spark, folder):
    split = ranking.stratified_split(_labelled(spark, folder), "hadm_id", "readmit")
    return split.select("hadm_id", "readmit", big("is_test"))


@query("kfold_assign")
def kfold_assign(spark, folder):
    folds = ranking.kfold(_labelled(spark, folder), "hadm_id", 10)
    folds = folds.withColumnRenamed("fold", "plain_fold")
    folds = ranking.kfold(folds, "hadm_id", 10, strata=["readmit"])
    return folds.select("hadm_id", big("plain_fold"), big("fold"))


@query("undersample")
def undersample(spark, folder):
    return ranking.undersample(_labelled(spark, folder), "hadm_id", "readmit")


# ---- data quality


@query("noise_inject")
def noise_inject(spark, folder):
    orders = roles.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return quality.inject_noise(orders, "o_orderkey", ["o_totalprice"], 0.5).select(
        "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice")
    )


@query("missing_inject")
def missing_inject(spark, folder):
    orders = roles.table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority"
    )
    return quality.inject_missing(orders, "o_orderkey", ["o_totalprice", "o_orderpriority"], 0.1)


LINE_RANGES = {"l_quantity": (5.0, 45.0), "l_discount": (0.01, 0.09)}


@query("clean_ranges")
def clean_ranges(spark, folder):
    """Repeated line numbers removed, values out of range replaced by medians."""
    lines = roles.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_discount"
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey"]
    cleaned = quality.clean(lines, ["l_orderkey", "l_linenumber"], order, LINE_RANGES)
    cleaned = materialise(cleaned, "cleaned")
    filled = impute.median_impute(cleaned, list(LINE_RANGES))
    return filled.select(
        "l_orderkey", big("l_linenumber"), "l_partkey", "l_suppkey", rounded("l_quantity"), rounded("l_discount")
    )


@query("clean_null_keys")
def clean_null_keys(spark, folder):
    """Repeats of a customer and priority removed; orders without a customer all stay."""
    orders = roles.table(spark, folder, "orders").select(
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderpriority", "o_orderkey"
    )
    return quality.drop_duplicates(orders, ["o_custkey", "o_orderpriority"], ["o_orderkey"])


@query("quality_profile_keys")
def quality_profile_keys(spark, folder):
    """Share of rows that repeat a key of two columns."""
    lines = roles.table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    profile = quality.quality_profile(lines, ["l_orderkey", "l_suppkey"], {"l_quantity": (5.0, 45.0)})
    return profile.select("column_name", "metric", rounded("share"))


@query("quality_profile")
def quality_profile(spark, folder):
    events = roles.labevents(spark, folder)
    profile = quality.quality_profile(
        events, "hadm_id", {"valuenum": (5.0, 40.0), "itemid": (50000.0, 60000.0)}
    )
    return profile.select("column_name", "metric", rounded("share"))


# ---- balancing


def _checksums(points: DataFrame, *keys: str) -> DataFrame:
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x)
    return points.select(
        *keys,
        F.round(total, DIGITS).alias("vec_sum"),
        F.round(F.col("embedding")[0], DIGITS).alias("vec_first"),
    )


@query("smote")
def smote_points(spark, folder):
    """Synthetic vectors that bring every class up to the largest."""
    vectors = roles.table(spark, folder, "embeddings")
    made = synthetic_points(vectors, "vec_id", "label", "embedding")
    return _checksums(made, big("label"), "seed_id", "copy", "neighbour_id")


@query("smote_rows")
def smote_rows(spark, folder):
    """Given and synthetic admissions, the readmission classes equally large."""
    rows = (
        adm.prescription_counts(roles.prescriptions(spark, folder))
        .join(_labelled(spark, folder), "hadm_id")
        .join(
            roles.table(spark, folder, "orders").select(
                F.col("o_orderkey").alias("hadm_id"), "o_totalprice"
            ),
            "hadm_id",
        )
    )
    rows = materialise(rows, "rows")
    columns = ["num_prescriptions", "o_totalprice"]
    made = smote(
        rows, "hadm_id", "readmit", columns, rounded=["num_prescriptions"],
        scales={"o_totalprice": 10000.0},
    )
    return made.select("hadm_id", "copy", "readmit", *[rounded(c) for c in columns])


# ---- evaluation


def _scored(spark, folder):
    """Labelled admissions with a rule as the model: many line items."""
    counts = adm.prescription_counts(roles.prescriptions(spark, folder))
    rows = _labelled(spark, folder).join(counts, "hadm_id", "left").na.fill(0)
    return rows.select(
        "hadm_id",
        F.col("readmit").alias("label"),
        (F.col("num_prescriptions") >= 4).cast("bigint").alias("prediction"),
        (F.col("num_prescriptions") / 20.0).alias("probability"),
    )


@query("confusion_matrix_absent")
def confusion_matrix_absent(spark, folder):
    """With a class that nobody has and nobody is predicted to have."""
    matrix = evaluate.confusion_matrix(_scored(spark, folder), [0, 1, 2])
    return matrix.select(*[big(c) for c in ("label", "predicted_0", "predicted_1", "predicted_2")])


@query("confusion_matrix")
def confusion_matrix(spark, folder):
    matrix = evaluate.confusion_matrix(_scored(spark, folder), [0, 1])
    return matrix.select(*[big(c) for c in ("label", "predicted_0", "predicted_1")])


@query("classification_report")
def classification_report(spark, folder):
    report = evaluate.classification_report(_scored(spark, folder))
    return report.select("name", *[rounded(c) for c in ("precision", "recall", "f1")], big("support"))


@query("weighted_f1")
def weighted_f1(spark, folder):
    return evaluate.weighted_f1(_scored(spark, folder)).select(rounded("weighted_f1"))


@query("regression_metrics")
def regression_metrics(spark, folder):
    lines = roles.table(spark, folder, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") * 1500).alias("guess")
    )
    metrics = evaluate.regression_metrics(lines, "l_extendedprice", "guess")
    return metrics.select(big("n"), F.round("mse", 2).alias("mse"), F.round("mae", 2).alias("mae"), F.round("r2", 4).alias("r2"))


@query("roc_auc")
def roc_auc(spark, folder):
    area = evaluate.roc_auc(_scored(spark, folder))
    return spark.range(1).select(F.round(F.lit(area), DIGITS).alias("roc_auc"))


RULE_FEATURES = ("prior_admissions", "num_prescriptions", "age_65_plus")


def _rule_rows(spark, folder):
    rows = cohort(roles.sources(spark, folder), roles.PARAMS)
    counts = adm.prescription_counts(roles.prescriptions(spark, folder))
    rows = rows.join(counts, "hadm_id", "left").na.fill(0)
    return rows.select("hadm_id", "readmit", *RULE_FEATURES)


def _rule(df: DataFrame) -> DataFrame:
    hit = (F.col("prior_admissions") <= 5) | (F.col("num_prescriptions") >= 6)
    return df.withColumn("prediction", hit.cast("int"))


@query("permutation_importance")
def permutation_importance_rule(spark, folder):
    table = permutation_importance(
        _rule_rows(spark, folder), "hadm_id", RULE_FEATURES, "readmit", _rule
    )
    return table.select("feature", rounded("importance_mean"), rounded("importance_std"))


@query("permutation_importance_f1")
def permutation_importance_f1(spark, folder):
    """The same by weighted F1 instead of accuracy."""
    table = permutation_importance(
        _rule_rows(spark, folder), "hadm_id", RULE_FEATURES, "readmit", _rule, 5, metric="weighted avg"
    )
    return table.select("feature", rounded("importance_mean"), rounded("importance_std"))


def _logistic(df: DataFrame) -> DataFrame:
    odds = F.col("o_totalprice") / 100000 - F.col("age_days") / 500
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
    return df.withColumn("probability", chance).withColumn(
        "prediction", (chance > 0.5).cast("int")
    )


@query("stability")
def stability(spark, folder):
    start = F.lit("1992-01-01").cast("date")
    rows = roles.table(spark, folder, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.datediff(F.col("o_orderdate"), start).cast("double").alias("age_days"),
    )
    result = studies.stability(
        rows, "o_orderkey", ["o_totalprice", "age_days"], _logistic, [0.1, 0.5, 1.0]
    )
    return result.select("level", *[rounded(c) for c in result.columns if c != "level"])


# ---- forests

# One tree of one split on all rows and all 0/1 features leaves nothing to
# chance, so SQL can work out the same split, leaves and scores.
STUMP = {"numTrees": 1, "maxDepth": 1, "minInstancesPerNode": 1}
CERTAIN = {"bootstrap": False, "featureSubsetStrategy": "all"}
FLAGS = ("has_chronic", "age_65_plus", *TYPE_COLUMNS, "many_priors", "many_prescriptions")


def _with_flags(table):
    return table.withColumns(
        {
            "many_priors": (F.col("prior_admissions") > 5).cast("int"),
            "many_prescriptions": (F.col("num_prescriptions") >= 4).cast("int"),
        }
    )


def _flags(spark, folder):
    flagged = _with_flags(_table(spark, folder))
    return materialise(flagged.select("hadm_id", "readmit", *[f"`{c}`" for c in FLAGS]), "flags")


def _stump_study(spark, folder, repeats):
    table = _flags(spark, folder)
    return train_and_evaluate(
        table, "hadm_id", "readmit", FLAGS, {**STUMP, **CERTAIN}, balancing="undersample", repeats=repeats
    )


@query("rf_predict_exact")
def rf_predict_exact(spark, folder):
    """Split, undersampling, a certain forest and its predictions on the test rows."""
    predictions = _stump_study(spark, folder, 0).predictions
    return predictions.select("hadm_id", "prediction", rounded("probability"))


@query("forest_importance_exact")
def forest_importance_exact(spark, folder):
    importance = _stump_study(spark, folder, 5).importance
    return importance.select("feature", rounded("importance_mean"), rounded("importance_std"))


@query("cv_tune_exact")
def cv_tune_exact(spark, folder):
    """Ten folds of the undersampled rows; the second trial may not split at all."""
    rows = materialise(ranking.undersample(_flags(spark, folder), "hadm_id", "readmit"), "even")
    trials = [STUMP, {**STUMP, "minInstancesPerNode": 2_000_000_000}]
    table = tune(rows, "hadm_id", FLAGS, "readmit", trials, folds=10, fixed=CERTAIN)
    return table.select(big("trial"), rounded("weighted_f1"), big("is_best"))


@query("quality_compare_exact")
def quality_compare_exact(spark, folder):
    """Clean rows, rows with gaps, and rows whose gaps are filled by training medians."""
    report = studies.quality_compare(
        _flags(spark, folder), "hadm_id", "readmit", FLAGS, {**STUMP, **CERTAIN}, level=0.0, missing_rate=0.3,
        ranges={c: (0.0, 1.0) for c in FLAGS}, balancing="undersample",
    )
    return report.select("variant", "name", *[rounded(c) for c in ("precision", "recall", "f1")], big("support"))


@query("pipeline_saved_exact")
def pipeline_saved_exact(spark, folder):
    """Fill, vector, undersampling and forest fitted as one pipeline on rows with gaps; saved, read back, applied to the test rows."""
    split = ranking.stratified_split(_flags(spark, folder), "hadm_id", "readmit")
    split = materialise(quality.inject_missing(split, "hadm_id", list(FLAGS), 0.3), "split")
    learner = classifier("readmit", {**STUMP, **CERTAIN}, 42)
    stages = [
        MedianFill(inputCols=list(FLAGS)),
        FeatureVector(inputCols=list(FLAGS), outputCol="_features"),
        Balanced(learner, idCol="hadm_id", labelCol="readmit", featuresCol="_features", how="undersample"),
    ]
    path = f"{shared_folder(spark)}/wardspan/pipeline-{uuid.uuid4().hex}"
    Pipeline(stages=stages).fit(split.where("is_test = 0")).save(path)
    scored = PipelineModel.load(path).transform(split.where("is_test = 1"))
    chance = F.round(vector_to_array("probability")[1], DIGITS).alias("probability")
    return scored.select("hadm_id", big("prediction"), chance)


@query("horizon_study_exact")
def horizon_study_exact(spark, folder):
    """A forest and its report for each horizon, on one split and one feature vector."""
    built = build_features(roles.sources(spark, folder), replace(roles.PARAMS, horizons=HORIZONS))
    flagged = _with_flags(built).select("hadm_id", *HORIZONS, *[f"`{c}`" for c in FLAGS])
    report = studies.horizon_study(
        materialise(flagged, "flags"), "hadm_id", list(HORIZONS), FLAGS, {**STUMP, **CERTAIN}, balancing="undersample"
    )
    return report.select("horizon", "name", *[rounded(c) for c in ("precision", "recall", "f1")], big("support"))


@query("horizon_study")
def horizon_study(spark, folder):
    """The study at 30 days, one and five years, by SMOTE and random forests on all features."""
    built = build_features(roles.sources(spark, folder), replace(roles.PARAMS, horizons=HORIZONS))
    return studies.horizon_study(materialise(built, "features"), "hadm_id", list(HORIZONS), FEATURES, FOREST)


def _table(spark, folder):
    return build_features(roles.sources(spark, folder), roles.PARAMS)


@query("rf_predict")
def rf_predict(spark, folder):
    """Split, SMOTE, forest and report on the test rows."""
    result = train_and_evaluate(
        _table(spark, folder), "hadm_id", "readmit", FEATURES, FOREST, repeats=0
    )
    return result.report


@query("forest_importance")
def forest_importance(spark, folder):
    result = train_and_evaluate(
        _table(spark, folder), "hadm_id", "readmit", FEATURES, FOREST, repeats=5
    )
    return result.importance


@query("cv_tune")
def cv_tune(spark, folder):
    """Five trials of the whole search ranges on ten folds: 50 fits."""
    return tune(_table(spark, folder), "hadm_id", FEATURES, "readmit", draw_trials(5, 42), folds=10)


@query("full_study")
def full_study(spark, folder):
    """Split, search on the training rows, SMOTE, forest, report and importance, as
    rows (part, name, measure, value)."""
    result = train_and_evaluate(_table(spark, folder), "hadm_id", "readmit", FEATURES)
    parts = {"trials": (result.trials, "trial"), "report": (result.report, "name"), "importance": (result.importance, "feature")}
    tables = []
    for part, (table, name) in parts.items():
        measures = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in table.columns if c != name]
        rows = table.select(F.lit(part).alias("part"), F.col(name).cast("string").alias("name"), F.inline(F.array(*measures)))
        tables.append(rows)
    return reduce(DataFrame.unionByName, tables)


@query("quality_compare")
def quality_compare(spark, folder):
    ranges = {c: (1.0, 45.0) for c in LAB_COLUMNS}
    return studies.quality_compare(
        _table(spark, folder), "hadm_id", "readmit", FEATURES, FOREST, ranges=ranges
    )
