"""Scans that tell what they could not read.

``read_table`` turns unreadable text into NULL. The scans here give the same
rows and, beside them, how many values of each column were unreadable, counted
in the very pass that reads the table, and the rejected rows as they stand in
the file.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardspan.sources.readers import SMALL, parsed, raw_table, spread_rows, without_nan
from wardspan.sources.schemas import TABLES


@dataclass(frozen=True)
class CheckedScan:
    """A typed table, its unreadable values and the rows that hold them.

    ``rejected`` has the text of every declared column and ``unreadable``, the
    names of those that could not be read; it is a scan of its own, run only if
    asked for.
    """

    table: DataFrame
    rejected: DataFrame
    observation: Observation

    def counts(self) -> dict[str, int]:
        """Rows and unreadable values by column ("rows" for the rows), of the
        first action on ``table``; waits for it."""
        return self.observation.get

    def refuse_above(self, share: float) -> None:
        """Raise if any column of the table read was unreadable in more than ``share`` of the rows."""
        found = dict(self.counts())
        rows = found.pop("rows") or 0
        bad = {c: n for c, n in found.items() if n > share * rows}
        if bad:
            raise ValueError(f"unreadable values in {rows} rows, by column: {bad}")


def _present(name: str) -> Column:
    return F.coalesce(F.trim(F.col(f"`{name}`")) != "", F.lit(False))


def unreadable(name: str, dtype: T.DataType) -> Column:
    """Whether the text is there but is no value of the type. NaN is a missing number, not an unreadable one."""
    if isinstance(dtype, T.StringType):
        return F.lit(False)
    return _present(name) & parsed(name, dtype).isNull()


def read_checked(
    spark: SparkSession,
    path: str | list[str],
    columns: T.StructType,
    partitions: int | None = None,
) -> CheckedScan:
    """As ``read_table``, with unreadable values counted in the same pass.

    All of ``columns`` are parsed, whatever is selected later, as their values
    are counted before the rows are spread over ``partitions``.
    """
    raw = raw_table(spark, path, columns)
    fields = list(enumerate(columns))
    # Every text is parsed once: its value is looked at for the count and goes on to the table.
    values = raw.select(
        *[parsed(f.name, f.dataType).alias(f"_value{i}") for i, f in fields],
        *[_present(f.name).alias(f"_present{i}") for i, f in fields if not isinstance(f.dataType, T.StringType)],
    )
    observation = Observation()
    counted = [
        F.lit(0).cast("long").alias(f.name)
        if isinstance(f.dataType, T.StringType)
        else F.coalesce(F.count_if(F.col(f"_present{i}") & F.col(f"_value{i}").isNull()), F.lit(0)).alias(f.name)
        for i, f in fields
    ]
    seen = values.observe(observation, F.count(F.lit(1)).alias("rows"), *counted)
    table = seen.select(*[without_nan(F.col(f"_value{i}"), f.dataType).alias(f.name) for i, f in fields])
    bad = {f.name: unreadable(f.name, f.dataType) for f in columns if not isinstance(f.dataType, T.StringType)}
    names = F.filter(F.array(*[F.when(b, F.lit(c)) for c, b in bad.items()]).cast("array<string>"), lambda c: c.isNotNull())
    # Few rows are rejected, so the names are worked out for these alone.
    rejected = raw.where(reduce(or_, bad.values(), F.lit(False))).select(
        *[f"`{f.name}`" for f in columns], names.alias("unreadable")
    )
    return CheckedScan(spread_rows(table, partitions), rejected, observation)


def read_hospital_checked(spark: SparkSession, folder: str, partitions: int | None = None) -> dict[str, CheckedScan]:
    """The five hospital tables as ``read_hospital`` gives them, each with its unreadable values."""
    spread = partitions or spark.sparkContext.defaultParallelism
    return {
        name: read_checked(spark, f"{folder}/hosp/{name}.csv.gz", schema, None if name in SMALL else spread)
        for name, schema in TABLES.items()
    }
