"""The hand-made hospital rows of FIXTURES.md."""

import datetime as dt

from wardspan.plans.features import Sources
from wardspan.sources import schemas

NAN = float("nan")


def _t(text):
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M")


ADMISSIONS = [
    (1, 101, _t("2150-01-01 10:00"), _t("2150-01-05 12:00"), "URGENT"),
    (1, 102, _t("2150-01-20 08:00"), _t("2150-01-22 09:00"), "AMBULATORY OBSERVATION"),
    (1, 103, _t("2155-06-01 00:00"), _t("2155-06-03 00:00"), "ELECTIVE"),
    (1, 104, _t("2155-06-02 12:00"), _t("2155-06-10 00:00"), "EW EMER."),
    (2, 201, _t("2160-02-01 00:00"), _t("2160-02-02 00:00"), "DIRECT EMER."),
    (2, 202, _t("2161-02-01 23:59"), _t("2161-02-03 00:00"), "URGENT"),
    (2, 203, _t("2162-02-04 00:00"), _t("2162-02-05 00:00"), "ELECTIVE"),
    (2, 204, _t("2162-02-04 00:00"), _t("2162-02-04 06:00"), "URGENT"),
    (3, 301, _t("2170-01-01 00:00"), _t("2170-01-02 00:00"), "SURGICAL SAME DAY ADMISSION"),
]
PATIENTS = [(1, 2150, 60), (2, 2160, 70)]
LABEVENTS = [
    (1, 101, 50912, 1.0),
    (2, 101, 50912, 3.0),
    (3, 101, 50912, None),
    (4, 101, 50912, NAN),
    (5, 101, 50983, 140.0),
    (6, 101, 50983, 130.0),
    (7, 101, 50983, 150.0),
    (8, None, 50912, 9.0),
    (9, 103, 99999, 5.0),
    (10, 104, 50912, None),
    (11, 201, 50912, 2.0),
]
DIAGNOSES = [
    (101, "i10"), (101, "I10"), (101, "E11.9"), (103, "Z00.0"), (201, "I50.9"), (None, "I10"),
]
PRESCRIPTIONS = [(101,), (101,), (101,), (201,), (None,)]
CODE_MAP = [("I10", "HTN"), ("E119", "DIAB"), ("I509", "CHF")]
WEIGHTS = [("HTN", 1.0, -1.0), ("DIAB", 4.0, 0.0), ("CHF", 7.0, 9.0)]

KEPT = [101, 103, 104, 201, 202, 203, 204, 301]


def code_tables(spark):
    code_map = spark.createDataFrame(CODE_MAP, "icd_code string, comorbidity string")
    weights = spark.createDataFrame(
        WEIGHTS, "comorbidity string, w_readmit double, w_mortality double"
    )
    return code_map, weights


def sources(spark) -> Sources:
    code_map, weights = code_tables(spark)
    return Sources(
        admissions=spark.createDataFrame(ADMISSIONS, schemas.ADMISSIONS),
        patients=spark.createDataFrame(PATIENTS, schemas.PATIENTS),
        diagnoses=spark.createDataFrame(DIAGNOSES, schemas.DIAGNOSES),
        prescriptions=spark.createDataFrame(PRESCRIPTIONS, schemas.PRESCRIPTIONS),
        labevents=spark.createDataFrame(LABEVENTS, schemas.LABEVENTS),
        code_map=code_map,
        weights=weights,
    )
