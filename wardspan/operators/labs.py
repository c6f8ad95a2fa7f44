"""Lab results per admission."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.functions.clinical import null_nan


@dataclass(frozen=True)
class LabItem:
    itemid: int
    name: str
    aggregates: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [f"lab_{self.name}_{a}" for a in self.aggregates]


# Tracked lab items with their aggregates.
LAB_ITEMS = (
    LabItem(50912, "creatinine", ("max", "last")),
    LabItem(51222, "hemoglobin", ("max", "last")),
    LabItem(51002, "troponin_i", ("max",)),
    LabItem(50813, "lactate", ("max", "last")),
    LabItem(50862, "albumin", ("mean",)),
    LabItem(50983, "sodium", ("mean",)),
    LabItem(50889, "crp", ("max",)),
    LabItem(51237, "inr", ("max", "last")),
    LabItem(50910, "creatine_kinase", ("max",)),
)


def _aggregate(item: LabItem, kind: str, order_key: str) -> Column:
    mine = F.col("itemid") == item.itemid
    value = F.when(mine, F.col("valuenum"))
    if kind == "max":
        return F.max(value)
    if kind == "mean":
        return F.avg(value)
    if kind == "last":
        return F.max_by(F.col("valuenum"), F.when(mine, F.col(order_key)))
    raise ValueError(f"unknown lab aggregate {kind!r}")


def lab_features(
    labevents: DataFrame,
    items: Sequence[LabItem] = LAB_ITEMS,
    order_key: str = "labevent_id",
) -> DataFrame:
    """One row per admission with a tracked item, ``lab_<name>_<aggregate>``.

    One filtered scan and one aggregation serve all items; every aggregate
    combines before the shuffle. ``order_key`` (unique within an admission, and
    best a number, so that the hash aggregate applies) says which result is
    last. Missing results (NULL or NaN) never count; an admission whose tracked
    results are all missing keeps a row of NULLs.
    """
    tracked = labevents.where(
        F.col("itemid").isin(*[i.itemid for i in items]) & F.col("hadm_id").isNotNull()
    ).withColumn("valuenum", null_nan(F.col("valuenum")))
    # A missing result has no place in the order, so "last" passes over it.
    tracked = tracked.withColumn(
        order_key, F.when(F.col("valuenum").isNotNull(), F.col(order_key))
    )
    return tracked.groupBy("hadm_id").agg(
        *[
            _aggregate(item, kind, order_key).alias(name)
            for item in items
            for kind, name in zip(item.aggregates, item.columns)
        ]
    )


def align(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Tables with one row per key side by side: every key of any table, NULL
    where a table lacks it. One shuffle for all tables, which combines first; a
    NULL key is one key like any other."""
    stacked = reduce(lambda above, below: above.unionByName(below, allowMissingColumns=True), frames)
    values = [c for c in stacked.columns if c != key]
    return stacked.groupBy(key).agg(*[F.first(f"`{c}`", ignorenulls=True).alias(c) for c in values])
