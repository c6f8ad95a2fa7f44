"""Tables written between stages, in the folder the cluster shares.

A written table cuts lineage and survives lost executors. The folder is the
one named by ``spark.checkpoint.dir``; a private folder is made only in local
mode with nothing configured.
"""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="wardspan-")


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


#: Lets the shuffle files of a query go when it ends, not when the driver next collects garbage.
_FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writes = Counter()  # going on, by session
_given: dict[int, str | None] = {}  # the setting before them
_writing = Lock()


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """For a write: what it shuffled is of no use once the table stands, and can fill the disks of a long job."""
    session = spark._jsparkSession.hashCode()
    with _writing:
        if not _writes[session]:
            _given[session] = spark.conf.get(_FILES_GO, None)
            spark.conf.set(_FILES_GO, "true")
        _writes[session] += 1
    try:
        yield
    finally:
        with _writing:
            _writes[session] -= 1
            if not _writes[session]:
                before = _given.pop(session)
                spark.conf.unset(_FILES_GO) if before is None else spark.conf.set(_FILES_GO, before)


def _written(df: DataFrame, path: str) -> DataFrame:
    with _shuffles_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder and read it back."""
    if scratch := _passing.get():
        return scratch.write(df, name)
    return _written(df, f"{shared_folder(df.sparkSession)}/wardspan/{name}-{uuid.uuid4().hex}")


class Scratch:
    """Tables of one computation, in a folder of their own that ends with it.

    A result that outlives the computation is written with ``materialise``
    first; then ``drop`` removes all that was only on the way to it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/wardspan/scratch-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` to a fresh folder and read it back."""
        return _written(df, f"{self.folder}/{name}-{uuid.uuid4().hex[:12]}")

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Takes the tables that this thread materialises, if any.
_passing: ContextVar[Scratch | None] = ContextVar("_passing", default=None)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables this thread materialises inside go when it ends, so nothing lazy may outlive it."""
    scratch = Scratch(spark)
    before = _passing.set(scratch)
    try:
        yield
    finally:
        _passing.reset(before)
        scratch.drop()


def _finished(spark: SparkSession, path: str) -> bool:
    """True where a writer left its success marker, on any Hadoop file system."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def content_mark(table: DataFrame) -> list[int]:
    """Row count and two hashes of a table's rows in any order: other content, another mark."""
    row = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in sorted(table.columns)])
    return list(table.agg(F.count("*"), F.bit_xor(row), F.sum(F.pmod(row, F.lit(1 << 32)))).first())


def files_mark(spark: SparkSession, path: str) -> list:
    """Count, bytes and a digest of paths, lengths and times of all files under ``path``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    lines, size = [], 0
    while files.hasNext():
        found = files.next()
        lines.append(f"{found.getPath().toString()}|{found.getLen()}|{found.getModificationTime()}")
        size += found.getLen()
    return [len(lines), size, hashlib.sha256("\n".join(sorted(lines)).encode()).hexdigest()]


def _place(folder: str, name: str, params: dict) -> tuple[str, str]:
    digest = hashlib.sha256(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()[:16]
    return f"{folder.rstrip('/')}/{name}/{digest}", digest


def _publish(spark: SparkSession, attempt: str, path: str) -> None:
    """Give a finished attempt its place, unless another writer was first; then the attempt goes.

    A folder is renamed as a whole, so a reader sees all of a table or nothing
    of it, and never files of two writers.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    source, target = hadoop.Path(attempt), hadoop.Path(path)
    system = target.getFileSystem(conf)
    if not _finished(spark, path):
        system.delete(target, True)  # left unfinished by a writer without attempts
        plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            hadoop.FileContext.getFileContext(target.toUri(), conf).rename(source, target, plain)
        except Exception:
            if not _finished(spark, path):
                raise
    system.delete(source, True)


def stage(
    spark: SparkSession,
    folder: str,
    name: str,
    params: dict,
    build: Callable[[], DataFrame],
) -> DataFrame:
    """Reuse ``<folder>/<name>/<hash of params>`` if finished, else build it.

    ``params`` holds all that the stage depends on, so another horizon or
    another input path cannot be answered by an older table; put
    ``files_mark`` of the inputs in it where these may change in place. Every
    writer builds in a folder of its own, and the first to finish is kept.
    """
    path, _ = _place(folder, name, params)
    if not _finished(spark, path):
        attempt = f"{path}-attempt-{uuid.uuid4().hex}"
        build().write.parquet(attempt)
        _publish(spark, attempt, path)
    return spark.read.parquet(path)


#: The columns of a bucketed stage, beside its files: an empty table has none to tell them.
_COLUMNS = "_columns"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def bucketed_stage(
    spark: SparkSession,
    folder: str,
    name: str,
    params: dict,
    build: Callable[[], DataFrame],
    key: str,
    buckets: int,
) -> DataFrame:
    """As ``stage``, in ``buckets`` files by the hash of ``key``, each sorted by it.

    Tables with the same key and number of buckets join and group by the key
    without an exchange. The table is known to the session's catalog by a name of
    its own; a later session registers the finished files again.
    """
    path, digest = _place(folder, name, {**params, "buckets": [key, buckets]})
    if not _finished(spark, path):
        attempt = uuid.uuid4().hex
        table = f"wardspan_{name}_attempt_{attempt}"
        # One task a bucket, so one file a bucket.
        rows = build().repartition(buckets, F.col(f"`{key}`"))
        writer = rows.write.format("parquet").bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{path}-attempt-{attempt}").saveAsTable(table)
        spark.sql(f"DROP TABLE `{table}`")  # the files stay
        _write_text(spark, f"{path}-attempt-{attempt}/{_COLUMNS}", rows.schema.toDDL())
        _publish(spark, f"{path}-attempt-{attempt}", path)
    place = hashlib.sha256(path.encode()).hexdigest()[:8]
    table = f"wardspan_{name}_{digest}_{place}"
    if not spark.catalog.tableExists(table):
        columns = _read_text(spark, f"{path}/{_COLUMNS}")
        spark.sql(
            f"CREATE TABLE `{table}` ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(table)
