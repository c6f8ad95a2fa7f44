"""The readmission label: time from discharge to the patient's next admission."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.functions.clinical import flag, whole_days
from wardspan.operators.admissions import by_patient
from wardspan.operators.skew import MIN_HOT_ROWS

# The horizons studied, in days.
HORIZONS = {"readmit_30d": 30, "readmit_1y": 365.24, "readmit_5y": 1826.2}


def readmitted(horizon: float, min_gap_days: int | None = None) -> Column:
    """1 where the next admission starts within ``horizon`` whole days.

    A next admission that starts before discharge counts, unless
    ``min_gap_days`` sets a lower bound. No next admission gives 0.
    """
    gap = F.col("gap_days")
    near = gap <= F.lit(float(horizon))
    if min_gap_days is not None:
        near = near & (gap >= min_gap_days)
    return flag(near)


def with_gap(df: DataFrame) -> DataFrame:
    return df.withColumn("gap_days", whole_days(F.col("dischtime"), F.col("next_admittime")))


def label_columns(
    df: DataFrame,
    horizons: Mapping[str, float],
    min_gap_days: int | None = None,
    censored: bool = False,
) -> DataFrame:
    """One label column per horizon over ``gap_days``; optionally ``censored``,
    1 for a patient's last known admission."""
    labels = {name: readmitted(days, min_gap_days) for name, days in horizons.items()}
    if censored:
        labels["censored"] = F.col("next_admittime").isNull().cast("int")
    return df.withColumns(labels)


def readmit_labels(
    admissions: DataFrame,
    kept: Column,
    horizons: Mapping[str, float],
    min_gap_days: int | None = None,
    censored: bool = False,
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """(hadm_id, gap_days, labels). Only ``kept`` admissions are labelled, and
    only they count as a next admission. One window serves every horizon."""
    groups = by_patient(admissions.where(kept), min_rows)
    labelled = with_gap(groups.next_value(groups.rows, "admittime", "next_admittime"))
    labelled = label_columns(labelled, horizons, min_gap_days, censored)
    extra = ["censored"] if censored else []
    return labelled.select("hadm_id", "gap_days", *horizons, *extra)
