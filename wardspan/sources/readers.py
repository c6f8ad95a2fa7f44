"""Typed scans of header CSV (plain or gzip) and parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardspan.functions.clinical import null_nan
from wardspan.sources.schemas import TABLES

SMALL = ("admissions", "patients")


def parsed(name: str, dtype: T.DataType) -> Column:
    """Text to type; unreadable text becomes NULL."""
    text = F.trim(F.col(f"`{name}`"))
    if isinstance(dtype, T.StringType):
        return F.col(f"`{name}`")
    if isinstance(dtype, T.IntegralType):
        # Integer columns with gaps are often exported as "101.0".
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast(dtype))
        return F.coalesce(text.try_cast(dtype), whole)
    return text.try_cast(dtype)


def without_nan(value: Column, dtype: T.DataType) -> Column:
    return null_nan(value) if isinstance(dtype, (T.DoubleType, T.FloatType)) else value


def typed(name: str, dtype: T.DataType) -> Column:
    """Text to type; unreadable text and NaN become NULL."""
    return without_nan(parsed(name, dtype), dtype).alias(name)


def spread_rows(table: DataFrame, partitions: int | None) -> DataFrame:
    """``table`` in so many partitions, without a shuffle where its scan has as many tasks already."""
    if not partitions or table.rdd.getNumPartitions() >= partitions:
        return table
    return table.repartition(partitions)


def raw_table(spark: SparkSession, path: str | list[str], columns: T.StructType) -> DataFrame:
    """All columns of a CSV with a header as text; refused if one of ``columns`` is absent."""
    raw = spark.read.options(header=True, escape='"', enforceSchema=False).csv(path)
    missing = [f.name for f in columns if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: no column {missing}; the header has {raw.columns}")
    return raw


def read_table(
    spark: SparkSession,
    path: str | list[str],
    columns: T.StructType,
    partitions: int | None = None,
) -> DataFrame:
    """Read ``columns`` of a CSV with a header, found by name in any order.

    A schema handed to the CSV reader would bind by position, so the file is
    read as text (only the asked columns are parsed) and cast. Several files
    must share one header; the reader refuses a file that differs. One gzip
    file is one task: give ``partitions`` to spread its rows before heavy work;
    a scan of as many tasks is left as it is.
    """
    raw = raw_table(spark, path, columns)
    table = raw.select(*[typed(f.name, f.dataType) for f in columns])
    return spread_rows(table, partitions)


def read_hospital(
    spark: SparkSession, folder: str, partitions: int | None = None
) -> dict[str, DataFrame]:
    """The five hospital tables under ``<folder>/hosp/<table>.csv.gz``.

    Rows of the large exports are spread over ``partitions``, by default as
    many as the cluster runs tasks; the two small tables stay as they are read.
    """
    spread = partitions or spark.sparkContext.defaultParallelism
    return {
        name: read_table(spark, f"{folder}/hosp/{name}.csv.gz", schema, None if name in SMALL else spread)
        for name, schema in TABLES.items()
    }


def read_parquet(
    spark: SparkSession, path: str, columns: T.StructType | None = None
) -> DataFrame:
    """Parquet scan, cut down to and cast to ``columns`` where given."""
    table = spark.read.parquet(path)
    if columns is None:
        return table
    return table.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in columns])
