import datetime as dt
import gzip

import pytest
from conftest import rows
from fixtures import ADMISSIONS, DIAGNOSES, LABEVENTS, PATIENTS, PRESCRIPTIONS, code_tables
from pyspark.sql import types as T

from wardspan.plans.features import FeatureParams, hospital_features
from wardspan.sources import schemas
from wardspan.sources.readers import read_hospital, read_parquet, read_table
from wardspan.sources.stage import materialise, shared_folder, stage


def _gzip(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.write("\n".join(lines) + "\n")
    return str(path)


def _text(value):
    if value is None:
        return ""
    if isinstance(value, dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S")
    return str(value)


def _export(folder):
    """The fixture tables as gzip CSV, with other columns around them."""
    tables = {
        "admissions": (schemas.ADMISSIONS, ADMISSIONS),
        "patients": (schemas.PATIENTS, PATIENTS),
        "diagnoses_icd": (schemas.DIAGNOSES, DIAGNOSES),
        "prescriptions": (schemas.PRESCRIPTIONS, PRESCRIPTIONS),
        "labevents": (schemas.LABEVENTS, LABEVENTS),
    }
    for name, (schema, data) in tables.items():
        header = ["note", *reversed(schema.fieldNames())]
        lines = [",".join(header)]
        lines += [",".join(['"a, b"', *[_text(v) for v in reversed(r)]]) for r in data]
        _gzip(folder / "hosp" / f"{name}.csv.gz", lines)
    return str(folder)


def test_columns_are_found_by_name(spark, tmp_path):
    path = _gzip(
        tmp_path / "labs.csv.gz",
        [
            "extra,valuenum,hadm_id,itemid,labevent_id",
            '"x, y",1.5,101,50912,1',
            "x,NaN,102.0,50912,2",
            "x,,,50912,3",
            "x,___,10.5,abc,4",
        ],
    )
    got = read_table(spark, path, schemas.LABEVENTS, partitions=3)
    assert got.rdd.getNumPartitions() == 3
    assert got.schema == schemas.LABEVENTS
    assert rows(got) == [
        (1, 101, 50912, 1.5), (2, 102, 50912, None), (3, None, 50912, None), (4, None, None, None),
    ]


def test_a_missing_column_is_named(spark, tmp_path):
    path = _gzip(tmp_path / "p.csv.gz", ["subject_id,anchor_age", "1,60"])
    with pytest.raises(ValueError, match="anchor_year"):
        read_table(spark, path, schemas.PATIENTS)


def test_files_with_differing_headers_are_refused(spark, tmp_path):
    a = _gzip(tmp_path / "a.csv.gz", ["subject_id,anchor_year,anchor_age", "1,2150,60"])
    b = _gzip(tmp_path / "b.csv.gz", ["subject_id,anchor_year,anchor_age", "2,2160,70"])
    assert rows(read_table(spark, [a, b], schemas.PATIENTS)) == sorted(PATIENTS)
    c = _gzip(tmp_path / "c.csv.gz", ["anchor_age,subject_id,anchor_year", "60,3,2150"])
    with pytest.raises(Exception, match="(?i)header"):
        read_table(spark, [a, c], schemas.PATIENTS).collect()


def test_times_carry_no_zone(spark, tmp_path):
    path = _gzip(tmp_path / "t.csv.gz", ["at", "2150-03-10 02:30:00", "soon"])
    got = read_table(spark, path, T.StructType([T.StructField("at", T.TimestampNTZType())]))
    # 02:30 does not exist on that day in the session's zone.
    assert rows(got) == [(dt.datetime(2150, 3, 10, 2, 30),), (None,)]


def test_hospital_folder(spark, tmp_path):
    tables = read_hospital(spark, _export(tmp_path))
    assert rows(tables["admissions"]) == sorted(ADMISSIONS)
    assert tables["labevents"].count() == len(LABEVENTS)


def test_parquet_round_trip(spark, tmp_path):
    path = str(tmp_path / "p.parquet")
    spark.createDataFrame(PATIENTS, schemas.PATIENTS).write.mode("overwrite").parquet(path)
    assert rows(read_parquet(spark, path)) == sorted(PATIENTS)
    wide = T.StructType([T.StructField("anchor_age", T.DoubleType())])
    assert rows(read_parquet(spark, path, wide)) == [(60.0,), (70.0,)]


def test_stage_is_built_once_per_parameters(spark, tmp_path):
    built = []

    def build(n):
        built.append(n)
        return spark.range(n)

    for n in (3, 3, 4, 3):
        got = stage(spark, str(tmp_path), "ids", {"n": n}, lambda n=n: build(n))
        assert got.count() == n
    assert built == [3, 4]


def test_unfinished_stage_is_built_again(spark, tmp_path):
    stage(spark, str(tmp_path), "ids", {}, lambda: spark.range(3))
    for marker in tmp_path.rglob("_SUCCESS"):
        marker.unlink()
    assert stage(spark, str(tmp_path), "ids", {}, lambda: spark.range(5)).count() == 5


def test_materialise_writes_to_the_shared_folder(spark):
    got = materialise(spark.range(10), "ten")
    assert got.count() == 10
    assert shared_folder(spark) in got.inputFiles()[0]


class _Session:
    """A session as far as the choice of the folder looks at it."""

    def __init__(self, master, folder=None):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.folder = folder

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.folder or default


def test_where_tables_go():
    assert shared_folder(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn"))
    own = shared_folder(_Session("local[4]"))
    assert own and own == shared_folder(_Session("local[4]"))


def test_feature_table_from_exports_and_again_from_cache(spark, tmp_path):
    data = _export(tmp_path / "data")
    cache = str(tmp_path / "cache")
    tables = code_tables(spark)
    first = hospital_features(spark, data, cache, *tables, time_delta_days=365.24)
    assert first.columns == ["hadm_id", "readmit", *FeatureParams().features]
    assert {t for c, t in first.dtypes if c != "hadm_id"} == {"float"}
    assert first.agg({"readmit": "sum"}).first()[0] == 3
    again = hospital_features(spark, data, cache, *tables, time_delta_days=365.24)
    assert rows(again) == rows(first)
    # Another horizon is not answered by the table of the first, and reuses
    # the aggregates: the large exports are no longer needed.
    for name in ("diagnoses_icd", "prescriptions", "labevents"):
        path = tmp_path / "data" / "hosp" / f"{name}.csv.gz"
        with gzip.open(path, "rt") as lines:
            header = lines.readline()
        _gzip(path, [header.strip()])
    longer = hospital_features(spark, data, cache, *tables, time_delta_days=400)
    assert longer.agg({"readmit": "sum", "num_prescriptions": "sum"}).first()[:] == (4, 4)


def test_changed_weights_are_not_answered_by_an_older_stage(spark):
    from wardspan.sources.stage import content_mark

    _, weights = code_tables(spark)
    assert content_mark(weights) == content_mark(weights.repartition(3))
    assert content_mark(weights) != content_mark(weights.withColumn("w_readmit", weights.w_readmit + 1))


def test_changed_export_is_built_again(spark, tmp_path):
    """Without a version the files decide; buckets change nothing in the rows."""
    data, tables = _export(tmp_path / "data"), code_tables(spark)
    plain = rows(hospital_features(spark, data, str(tmp_path / "a"), *tables))
    kept = [hospital_features(spark, data, str(tmp_path / "b"), *tables, version=None, buckets=3) for _ in range(2)]
    assert rows(kept[0]) == rows(kept[1]) == plain
    path = tmp_path / "data" / "hosp" / "prescriptions.csv.gz"
    with gzip.open(path, "rt") as lines:
        header = lines.readline()
    _gzip(path, [header.strip()])
    changed = hospital_features(spark, data, str(tmp_path / "b"), *tables, version=None, buckets=3)
    assert changed.agg({"num_prescriptions": "sum"}).first()[0] == 0
    assert sum(r["num_prescriptions"] for r in kept[0].collect()) > 0


def test_a_written_table_leaves_no_shuffle_files(spark):
    import time

    from wardspan.sources import stage

    def shuffled():
        files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().endswith(".data")}

    before, given = shuffled(), spark.conf.get(stage._FILES_GO)
    table = spark.range(1000).repartition(3, "id")
    kept = stage.materialise(table, "rows")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
    assert spark.conf.get(stage._FILES_GO) == given
    assert kept.count() == table.count() == 1000
