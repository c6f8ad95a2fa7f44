"""Per-admission features from admissions, patients and prescriptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.functions.clinical import age_at, flag, one_hot
from wardspan.operators.skew import MIN_HOT_ROWS, OrderedGroups, lookup

# The admission types kept.
ADMISSION_TYPES = (
    "DIRECT EMER.",
    "ELECTIVE",
    "EU OBSERVATION",
    "EW EMER.",
    "OBSERVATION ADMIT",
    "URGENT",
    "SURGICAL SAME DAY ADMISSION",
)

SENIOR_AGE = 65


def by_patient(admissions: DataFrame, min_rows: int = MIN_HOT_ROWS) -> OrderedGroups:
    """Admissions in time order per patient; hadm_id breaks ties."""
    return OrderedGroups(admissions, "subject_id", ["admittime", "hadm_id"], min_rows)


def prior_admissions(admissions: DataFrame, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Number of earlier admissions of the patient, of any type."""
    groups = by_patient(admissions, min_rows)
    return groups.count_before(groups.rows, "prior_admissions").drop("_piece")


def age_flag(df: DataFrame) -> Column:
    """1 from age 65 at admission; 0 where the age is not known."""
    age = age_at(F.col("anchor_age"), F.col("anchor_year"), F.col("admittime"))
    return flag(age >= SENIOR_AGE)


def with_age_flag(
    admissions: DataFrame, patients: DataFrame, min_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """Admissions with ``age_65_plus``."""
    joined = lookup(admissions, patients, ["subject_id"], min_rows=min_rows)
    return joined.withColumn("age_65_plus", age_flag(joined)).drop("anchor_age", "anchor_year")


def of_type(types: Sequence[str] = ADMISSION_TYPES) -> Column:
    return F.col("admission_type").isin(*types)


def categories(df: DataFrame, column: str, limit: int = 1000) -> list[str]:
    """The distinct values of a column, sorted; refused beyond ``limit``."""
    known = df.select(column).where(F.col(column).isNotNull()).distinct()
    found = [r[0] for r in known.limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values: too many to encode as columns")
    return sorted(found)


def encode_types(
    admissions: DataFrame,
    types: Sequence[str] | None = ADMISSION_TYPES,
    column: str = "admission_type",
) -> DataFrame:
    """Replace the type by one 0/1 column per listed type. The list fixes the
    schema; a type absent from the data gives a column of zeros. With None the
    types are looked up in the data first."""
    if types is None:
        types = categories(admissions, column)
    rest = [c for c in admissions.columns if c != column]
    return admissions.select(*rest, *one_hot(F.col(column), types, column))


def row_counts(df: DataFrame, key: str, out: str) -> DataFrame:
    """Rows per key, rows without a key left out."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(out))


def prescription_counts(prescriptions: DataFrame) -> DataFrame:
    return row_counts(prescriptions, "hadm_id", "num_prescriptions")
