"""A caller's own function on the whole rows of each group.

The function is plain Python over Arrow tables; Spark shuffles the rows so that
it sees a group whole. A group too large for one task is refused, or, where the
caller declares how partial results combine, taken batch by batch where its
rows lie.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wardspan.operators.skew import BROADCAST_ROWS

# Executors get these functions by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a group that one task is given whole.
MAX_GROUP_ROWS = 1_000_000

GroupFunction = Callable[[pa.Table], pa.Table]


def _checked(function: GroupFunction, schema: pa.Schema) -> GroupFunction:
    """The function, its result cast to the declared columns; refused if one is missing."""

    def run(rows: pa.Table) -> pa.Table:
        made = function(rows)
        absent = [name for name in schema.names if name not in made.column_names]
        if absent:
            raise ValueError(f"the group function gave no column {absent}; it gave {made.column_names}")
        made = made.select(schema.names)
        return made if made.schema.equals(schema) else made.cast(schema)

    return run


def _starts(batch: pa.RecordBatch, keys: list[str]) -> list[int]:
    """Where another group begins in a batch sorted by ``keys``, its first row included."""
    changes = []
    for key in keys:
        here, before = batch.column(key).slice(1), batch.column(key).slice(0, batch.num_rows - 1)
        # A missing key is one key like any other.
        changes.append(pc.or_(pc.fill_null(pc.not_equal(here, before), False), pc.xor(pc.is_null(here), pc.is_null(before))))
    return [0, *(pc.indices_nonzero(reduce(pc.or_, changes)).to_numpy() + 1).tolist()]


def _in_order(keys: list[str], function: GroupFunction):
    """The function on every group of rows sorted by ``keys``; a group may go on in the next batch.

    Many small groups share a batch, so none has a stream of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun: list[pa.RecordBatch] = []  # of the group that may go on
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            made, starts = [], _starts(batch, keys)
            for at, until in zip(starts, [*starts[1:], batch.num_rows]):
                if begun and (at or key != tuple(batch.column(k)[0] for k in keys)):
                    made.append(function(pa.Table.from_batches(begun)))
                    begun = []
                begun.append(batch.slice(at, until - at))
            key = tuple(batch.column(k)[batch.num_rows - 1] for k in keys)
            if made:
                yield from pa.concat_tables(made).combine_chunks().to_batches()
        if begun:
            yield from function(pa.Table.from_batches(begun)).to_batches()

    return run


#: Types of keys that are equal as values where Spark groups them as equal.
_PLAIN_KEYS = (T.IntegralType, T.BooleanType, T.DateType, T.BinaryType)


def _on_groups(df: DataFrame, keys: list[str], function: GroupFunction, schema: StructType) -> DataFrame:
    """``function`` on the whole rows of each group, the rows brought together by one shuffle."""
    if not keys or not all(isinstance(df.schema[k].dataType, _PLAIN_KEYS) for k in keys):
        return df.groupBy(*keys).applyInArrow(function, schema)
    # The number of partitions is stated: rows are small in bytes but dear to work on, and would be merged by size.
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(f"`{k}`") for k in keys]
    return df.repartition(n, *by).sortWithinPartitions(*by).mapInArrow(_in_order(keys, function), schema)


#: Partial rows of a group that a task holds before it combines them.
_HELD = 4096


def _partials(keys: list[str], function: GroupFunction, combine: GroupFunction):
    """One partial result per group and task: the function on the rows of each batch, combined as they pile up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, pa.Table] = {}
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for group in rows.select(keys).group_by(keys).aggregate([]).to_pylist():
                # A missing key is one key like any other.
                mine = [
                    pc.is_null(rows[k]) if v is None else pc.fill_null(pc.equal(rows[k], pa.scalar(v, rows[k].type)), False)
                    for k, v in group.items()
                ]
                part, key = function(rows.filter(reduce(pc.and_, mine))), tuple(group.values())
                part = pa.concat_tables([held[key], part]) if key in held else part
                held[key] = combine(part) if part.num_rows > _HELD else part
        for part in held.values():
            yield from combine(part).to_batches()

    return run


def apply_grouped(
    df: DataFrame,
    keys: Sequence[str],
    function: GroupFunction,
    schema: StructType,
    max_rows: int = MAX_GROUP_ROWS,
    combine: GroupFunction | None = None,
) -> DataFrame:
    """``function`` applied to all rows of each group of ``keys``, its rows cast to ``schema``.

    A group comes whole, in no order, as one Arrow table of all columns of
    ``df``; NULL keys are a group. Groups of more than ``max_rows`` rows are
    counted first: without ``combine`` they are refused by name, before any work.
    With it, their rows are not gathered at all: ``function`` runs on what each
    batch holds of them, and ``combine``, from rows of ``schema`` (which must
    hold ``keys``) to fewer such rows, is applied in each task and once more to
    what the tasks give; so it must not matter in what portions it is applied.
    """
    keys, names = list(keys), to_arrow_schema(schema)
    whole = _checked(function, names)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows)
    if combine is None:
        large = counts.orderBy(F.desc("_n")).limit(5).collect()
        if large:
            raise ValueError(f"groups of more than {max_rows} rows, and no combine: {[tuple(r) for r in large]}")
        return _on_groups(df, keys, whole, schema)
    if missing := [k for k in keys if k not in schema.names]:
        raise ValueError(f"combine needs the keys in the schema: {missing}")
    # At most one large group per max_rows rows of the table.
    large = counts.select(*[F.col(f"`{k}`").alias(f"_large_{i}") for i, k in enumerate(keys)])
    found = large.limit(BROADCAST_ROWS + 1).count()
    if not found:
        return _on_groups(df, keys, whole, schema)
    large = F.broadcast(large) if found <= BROADCAST_ROWS else large
    same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"_large_{i}")) for i, k in enumerate(keys)])
    small = _on_groups(df.join(large, same, "left_anti"), keys, whole, schema)
    gather = _checked(combine, names)
    parts = df.join(large, same, "left_semi").mapInArrow(_partials(keys, whole, gather), schema)
    return small.unionByName(_on_groups(parts, keys, gather, schema))
