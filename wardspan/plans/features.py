"""One feature row per kept admission, with its readmission labels."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardspan.functions.clinical import one_hot
from wardspan.operators.admissions import (
    ADMISSION_TYPES,
    age_flag,
    by_patient,
    of_type,
    prescription_counts,
)
from wardspan.operators.comorbidity import comorbidity_scores
from wardspan.operators.impute import fill_from, fill_missing, median_table
from wardspan.operators.label import label_columns, with_gap
from wardspan.operators.labs import LAB_ITEMS, LabItem, lab_features
from wardspan.operators.reduce import keep_wanted
from wardspan.operators.skew import MIN_HOT_ROWS
from wardspan.sources.readers import read_hospital
from wardspan.sources.stage import bucketed_stage, content_mark, files_mark, materialise, stage

BASE_FEATURES = (
    "elix_mortality",
    "elix_readmit",
    "prior_admissions",
    "num_prescriptions",
    "has_chronic",
    "age_65_plus",
)
# The lab columns of the feature table, in its order.
LAB_COLUMNS = (
    "lab_creatinine_max",
    "lab_creatinine_last",
    "lab_hemoglobin_max",
    "lab_hemoglobin_last",
    "lab_inr_max",
    "lab_inr_last",
    "lab_creatine_kinase_max",
    "lab_lactate_max",
    "lab_lactate_last",
    "lab_albumin_mean",
    "lab_sodium_mean",
    "lab_crp_max",
)


@dataclass(frozen=True)
class Sources:
    """The input tables, with the columns of ``wardspan.sources.schemas``."""

    admissions: DataFrame
    patients: DataFrame
    diagnoses: DataFrame
    prescriptions: DataFrame
    labevents: DataFrame
    code_map: DataFrame
    weights: DataFrame


@dataclass(frozen=True)
class FeatureParams:
    horizons: Mapping[str, float] = field(default_factory=lambda: {"readmit": 365})
    types: Sequence[str] = ADMISSION_TYPES
    lab_items: Sequence[LabItem] = LAB_ITEMS
    lab_columns: Sequence[str] = LAB_COLUMNS
    order_key: str = "labevent_id"
    min_gap_days: int | None = None
    censored: bool = False
    min_rows: int = MIN_HOT_ROWS
    #: Drop rows of other admissions by a Bloom filter before the aggregates shuffle.
    reduce_first: bool = False

    @property
    def type_columns(self) -> list[str]:
        return [f"admission_type_{t}" for t in self.types]

    @property
    def features(self) -> list[str]:
        return [*BASE_FEATURES, *self.lab_columns, *self.type_columns]


def cohort(sources: Sources, params: FeatureParams) -> DataFrame:
    """Kept admissions with prior count, labels, age flag and type flags.

    The prior count sees every admission, the label only the kept ones. Both
    windows and the patient join run on one shuffle by patient.
    """
    kept = of_type(params.types)
    groups = by_patient(sources.admissions, params.min_rows)
    rows = groups.count_before(groups.rows, "prior_admissions").where(kept)
    rows = with_gap(groups.next_value(rows, "admittime", "next_admittime", kept))
    rows = label_columns(rows, params.horizons, params.min_gap_days, params.censored)
    rows = groups.lookup(rows, sources.patients)
    labels = [*params.horizons, *(["censored"] if params.censored else [])]
    return rows.select(
        "hadm_id",
        *labels,
        "prior_admissions",
        age_flag(rows).alias("age_65_plus"),
        *one_hot(F.col("admission_type"), params.types, "admission_type"),
    )


def part_builders(
    sources: Sources, params: FeatureParams = FeatureParams()
) -> dict[str, Callable[[], DataFrame]]:
    """The per-admission aggregates by name; none depends on the horizons.

    With ``reduce_first`` they hold the kept admissions and a few others, which
    the join drops: worth a pass over the admissions where few are kept.
    """
    if params.reduce_first:
        kept = sources.admissions.where(of_type(params.types)).select("hadm_id")
        large = ("diagnoses", "prescriptions", "labevents")
        sources = replace(sources, **{name: keep_wanted(getattr(sources, name), kept, "hadm_id") for name in large})
    return {
        "comorbidity": lambda: comorbidity_scores(
            sources.diagnoses, sources.code_map, sources.weights, min_rows=params.min_rows
        ),
        "prescription_counts": lambda: prescription_counts(sources.prescriptions),
        "labs": lambda: lab_features(sources.labevents, params.lab_items, params.order_key),
    }


def join_parts(
    stays: DataFrame, parts: Mapping[str, DataFrame], params: FeatureParams
) -> DataFrame:
    """The feature table before imputation. Every join is one row to one row
    on hadm_id, and a freshly built part arrives already shuffled by it."""
    labels = [*params.horizons, *(["censored"] if params.censored else [])]
    wide = (
        stays.join(parts["comorbidity"], "hadm_id", "left")
        .join(parts["prescription_counts"], "hadm_id", "left")
        .join(parts["labs"].select("hadm_id", *params.lab_columns), "hadm_id", "left")
    )
    wide = fill_missing(wide, 0, ["elix_readmit", "elix_mortality", "has_chronic", "num_prescriptions"])
    return wide.select("hadm_id", *labels, *[F.col(f"`{c}`") for c in params.features])


def assemble(sources: Sources, params: FeatureParams = FeatureParams()) -> DataFrame:
    parts = {name: build() for name, build in part_builders(sources, params).items()}
    return join_parts(cohort(sources, params), parts, params)


def fill_labs(wide: DataFrame, params: FeatureParams) -> DataFrame:
    """Missing labs filled with the median of their column. The joined rows are
    written once: medians and filling scan them again."""
    wide = materialise(wide, "assembled")
    return fill_from(wide, median_table(wide, params.lab_columns), params.lab_columns)


def build_features(sources: Sources, params: FeatureParams = FeatureParams()) -> DataFrame:
    return fill_labs(assemble(sources, params), params)


def as_float(df: DataFrame, key: str = "hadm_id") -> DataFrame:
    """Every column but the key as 32-bit float, the stored form."""
    return df.select(key, *[F.col(f"`{c}`").cast("float").alias(c) for c in df.columns if c != key])


def hospital_features(
    spark: SparkSession,
    data_path: str,
    cache_path: str,
    code_map: DataFrame,
    weights: DataFrame,
    time_delta_days: float = 365,
    partitions: int | None = None,
    version: str | None = "1",
    params: FeatureParams | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Feature table of a folder of hospital exports, kept under ``cache_path``.

    Admissions, patients and the aggregates are kept once per data path, code
    map, weights and ``params``, the result once per horizon as well, so another
    horizon reads no large export again. Change ``version`` when the exports
    change, or give None, and the names, lengths and times of their files decide.
    ``time_delta_days`` is the horizon, whatever ``params`` says. With
    ``buckets`` the aggregates and the cohort are kept in so many buckets by
    hadm_id, and join without another exchange.
    """
    params = replace(params or FeatureParams(), horizons={"readmit": time_delta_days})
    given = {
        "data": data_path,
        "version": files_mark(spark, data_path) if version is None else version,
        "code_map": content_mark(code_map),
        "weights": content_mark(weights),
        "params": repr(replace(params, horizons={})),
    }

    def kept(name: str, build: Callable[[], DataFrame], **more) -> DataFrame:
        return stage(spark, cache_path, name, {**given, **more}, build)

    def by_admission(name: str, build: Callable[[], DataFrame], **more) -> DataFrame:
        if buckets is None:
            return kept(name, build, **more)
        return bucketed_stage(spark, cache_path, name, {**given, **more}, build, "hadm_id", buckets)

    def build() -> DataFrame:
        tables = read_hospital(spark, data_path, partitions)
        sources = Sources(
            admissions=kept("admissions", lambda: tables["admissions"]),
            patients=kept("patients", lambda: tables["patients"]),
            diagnoses=tables["diagnoses_icd"],
            prescriptions=tables["prescriptions"],
            labevents=tables["labevents"],
            code_map=code_map,
            weights=weights,
        )
        parts = {name: by_admission(name, made) for name, made in part_builders(sources, params).items()}
        stays = cohort(sources, params)
        if buckets is not None:
            stays = by_admission("cohort", lambda: cohort(sources, params), horizon=time_delta_days)
        return as_float(fill_labs(join_parts(stays, parts, params), params))

    return kept("features", build, horizon=time_delta_days)
