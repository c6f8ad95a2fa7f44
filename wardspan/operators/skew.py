"""Keeping one hot key from becoming one hot task.

A key is hot when it holds more rows than ``min_rows`` and more than 1/1024 of
the table. So at most 1024 keys are hot whatever the data size; that bounds all
that is fetched or broadcast here. Hot keys are looked for first, by one
aggregation of the key column, and a table without any gets the plain plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardspan.functions.seeded import uniform

MIN_HOT_ROWS = 1_000_000
HOT_SHARE = 1024
BROADCAST_ROWS = 200_000
_PIECES = 4  # pieces cut out of a key per 1/1024 of the table
_DRAWS = 32  # rows drawn per cut point, so that pieces come out even


def hot_keys(
    df: DataFrame, keys: Sequence[str], min_rows: int = MIN_HOT_ROWS
) -> DataFrame | None:
    """(keys, _pieces) of the hot keys, ``_pieces`` the number of parts each
    should be split into; None if there are none. NULL can be a hot key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    largest = counts.where(F.col("_n") > min_rows).orderBy(F.desc("_n")).limit(HOT_SHARE)
    found = largest.collect()
    if not found:
        return None
    limit = max(float(min_rows), df.count() / HOT_SHARE)
    hot = [r for r in found if r["_n"] > limit]
    if not hot:
        return None
    table = df.sparkSession.createDataFrame(hot, largest.schema)
    pieces = F.ceil(F.lit(_PIECES) * F.col("_n") / F.lit(limit))
    return table.select(*keys, pieces.cast("int").alias("_pieces"), "_n")


class OrderedGroups:
    """Ordered computations inside groups (running count, next value) where a
    group may be far larger than one task should hold.

    A hot group is cut along its sort order, at a few thousand cut points in
    all: every 32nd of the rows drawn by a hash of the order columns. Rows are shuffled by (key,
    piece), windows run inside a piece, and a small table of one row per piece
    of a hot group carries counts and first values across the cuts.

    ``order`` must be unique within a group.
    """

    def __init__(
        self, df: DataFrame, key: str, order: Sequence[str], min_rows: int = MIN_HOT_ROWS
    ):
        self.key = key
        self.order = list(order)
        self.cuts = self._cut_points(df, min_rows)
        self.by = [key]
        self.rows = df
        if self.cuts is not None:
            self.by = [key, "_piece"]
            self._cut_rows = self._with_piece(df, "inner")
            # Said outright: a shuffle by the key alone would satisfy the
            # windows too, and bring the hot group together again.
            self.rows = self._with_piece(df, "left").repartition(key, "_piece")
        self._window = W.partitionBy(*self.by).orderBy(*order)

    def _cut_points(self, df: DataFrame, min_rows: int) -> DataFrame | None:
        """(_key, _cuts): the sorted cut points of every hot group."""
        hot = hot_keys(df.select(self.key), [self.key], min_rows)
        if hot is None:
            return None
        hot = hot.withColumnRenamed(self.key, "_key")
        same = F.col(self.key).eqNullSafe(F.col("_key"))
        drawn = (
            df.select(self.key, *self.order)
            .join(F.broadcast(hot), same)
            .where(uniform("cut", *self.order) < _DRAWS * F.col("_pieces") / F.col("_n"))
            .groupBy("_key")
            .agg(F.sort_array(F.collect_list(F.struct(*self.order))).alias("_drawn"))
        )
        thinned = F.filter("_drawn", lambda _, i: i % _DRAWS == _DRAWS - 1)
        drawn = drawn.select("_key", thinned.alias("_cuts"))
        return df.sparkSession.createDataFrame(drawn.collect(), drawn.schema)

    def _with_piece(self, df: DataFrame, how: str) -> DataFrame:
        here = F.struct(*self.order)
        piece = F.size(F.filter("_cuts", lambda cut: cut <= here))
        return (
            df.join(F.broadcast(self.cuts), F.col(self.key).eqNullSafe(F.col("_key")), how)
            .withColumn("_piece", F.when(F.col("_cuts").isNull(), 0).otherwise(piece))
            .drop("_cuts", "_key")
        )

    def _carry(self, rows: DataFrame, carried: Column, **summary: Column) -> DataFrame:
        """Adds ``_carried``: ``carried`` over the per-piece columns ``summary``."""
        pieces = self._cut_rows.groupBy(self.key, "_piece").agg(*[c.alias(n) for n, c in summary.items()])
        carry = pieces.select(
            F.col(self.key).alias("_key"), F.col("_piece").alias("_at"), carried.alias("_carried")
        )
        here = F.col(self.key).eqNullSafe(F.col("_key")) & (F.col("_piece") == F.col("_at"))
        return rows.join(F.broadcast(carry), here, "left").drop("_key", "_at")

    def count_before(self, rows: DataFrame, out: str) -> DataFrame:
        """0-based position of the row in its group."""
        place = F.row_number().over(self._window).cast("bigint") - 1
        counted = rows.withColumn(out, place)
        if self.cuts is None:
            return counted
        pieces = W.partitionBy(self.key).orderBy("_piece")
        before = F.sum("_s").over(pieces.rowsBetween(W.unboundedPreceding, -1))
        counted = self._carry(counted, before, _s=F.count(F.lit(1)))
        return counted.withColumn(out, F.col(out) + F.coalesce("_carried", F.lit(0))).drop("_carried")

    def next_value(
        self, rows: DataFrame, value: str, out: str, kept: Column | None = None
    ) -> DataFrame:
        """``value`` of the following row. ``value`` is the leading order
        column. Where ``rows`` were filtered, ``kept`` is that filter."""
        if self.cuts is None:
            return rows.withColumn(out, F.lead(value).over(self._window))
        # Wrapped, so that a next row whose own value is NULL still counts as one.
        row = F.struct(F.col(value).alias("value"))
        led = rows.withColumn("_next", F.lead(row).over(self._window))
        here = F.lit(True) if kept is None else kept
        none, low = F.max(F.when(here, F.col(value).isNull())), F.min(F.when(here, F.col(value)))
        pieces = W.partitionBy(self.key).orderBy("_piece").rowsBetween(1, W.unboundedFollowing)
        # NULL comes before all values, so one in any later piece is the next row.
        later = F.when(~F.max("_none").over(pieces), F.min("_low").over(pieces))
        led = self._carry(led, later, _none=none, _low=low)
        following = F.when(F.col("_next").isNotNull(), F.col("_next.value")).otherwise(F.col("_carried"))
        return led.withColumn(out, following).drop("_carried", "_next")

    def lookup(self, rows: DataFrame, dimension: DataFrame) -> DataFrame:
        """Left join of a table with one row per group key, on the shuffle the
        windows made. The row of a hot key is repeated per piece."""
        if self.cuts is None:
            return rows.join(dimension, self.key, "left")
        pieces = F.sequence(F.lit(0), F.coalesce(F.size("_cuts"), F.lit(0)))
        repeated = (
            dimension.join(F.broadcast(self.cuts), F.col(self.key) == F.col("_key"), "left")
            .withColumn("_piece", F.explode(pieces))
            .drop("_cuts", "_key")
        )
        return rows.join(repeated, self.by, "left")


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Join facts to a table with one row per key.

    The table is broadcast after counting that it has at most
    ``broadcast_rows`` rows. A larger one is joined by shuffle, with the rows
    of a hot key salted over several tasks.
    """
    if dimension.count() <= broadcast_rows:
        return facts.join(F.broadcast(dimension), list(keys), how)
    return salted_lookup(facts, dimension, keys, how, min_rows)


def salted_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Shuffle join to a table with one row per key, hot keys salted.

    The salt is a hash of the rest of the row, so that a retried task places
    every row where it was before. Fact rows without a key match nothing and
    are spread as well.
    """
    keys = list(keys)
    hot = hot_keys(facts.select(*keys), keys, min_rows)
    if hot is None:
        return facts.join(dimension, keys, how)
    hot = F.broadcast(hot.select(*keys, "_pieces"))
    rest = [F.col(f"`{c}`") for c, t in facts.dtypes if c not in keys and not t.startswith("map")]
    if not rest:
        raise ValueError("facts need a column besides the join keys")
    row = F.xxhash64(*rest)
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    salt = (
        F.when(no_key, F.pmod(row, F.lit(HOT_SHARE)))
        .when(F.col("_pieces").isNotNull(), F.pmod(row, F.col("_pieces")))
        .otherwise(0)
    )
    salted = facts.join(hot, keys, "left").withColumn("_salt", salt.cast("int"))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    repeated = dimension.join(hot, keys, "left").withColumn("_salt", copies)
    joined = salted.drop("_pieces").join(repeated.drop("_pieces"), [*keys, "_salt"], how)
    return joined.drop("_salt")
