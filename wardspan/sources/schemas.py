"""Columns read from each hospital table (a subset of each file)."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


ADMISSIONS = _struct(
    subject_id=T.LongType(),
    hadm_id=T.LongType(),
    admittime=T.TimestampNTZType(),
    dischtime=T.TimestampNTZType(),
    admission_type=T.StringType(),
)
PATIENTS = _struct(
    subject_id=T.LongType(), anchor_year=T.IntegerType(), anchor_age=T.IntegerType()
)
DIAGNOSES = _struct(hadm_id=T.LongType(), icd_code=T.StringType())
PRESCRIPTIONS = _struct(hadm_id=T.LongType())
# labevent_id orders the results of one admission; "last" needs such a key.
LABEVENTS = _struct(
    labevent_id=T.LongType(),
    hadm_id=T.LongType(),
    itemid=T.IntegerType(),
    valuenum=T.DoubleType(),
)

TABLES = {
    "admissions": ADMISSIONS,
    "patients": PATIENTS,
    "diagnoses_icd": DIAGNOSES,
    "prescriptions": PRESCRIPTIONS,
    "labevents": LABEVENTS,
}
