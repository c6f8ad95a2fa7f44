"""Comorbidity scores per admission from diagnosis codes.

The code-to-group map and the group weights are input tables (the published
Elixhauser index, or any other of that form).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from wardspan.functions.clinical import normalise_code
from wardspan.operators.skew import BROADCAST_ROWS, MIN_HOT_ROWS, lookup

MASK_GROUPS = 248  # up to this many groups are kept as bits
_WORD = 62  # bits used of one 64-bit number


def normalise_codes(diagnoses: DataFrame, column: str = "icd_code") -> DataFrame:
    return diagnoses.withColumn(column, normalise_code(F.col(column)))


def _groups(code_map: DataFrame, weights: DataFrame) -> DataFrame:
    """(comorbidity, w_readmit, w_mortality), no weight counting as 0."""
    twice = weights.groupBy("comorbidity").count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"more than one weight row for {[r['comorbidity'] for r in twice]}")
    weighted = code_map.select("comorbidity").distinct().join(weights, "comorbidity", "left")
    return weighted.select("comorbidity", "w_readmit", "w_mortality").na.fill(0.0)


def _by_mask(
    coded: DataFrame, code_map: DataFrame, groups: list[Row], join: Callable
) -> DataFrame:
    """Scores by bit masks: each code brings the bits of its groups, an
    admission the bitwise or of its codes. One shuffle of one number per
    admission and map task, and nothing is repeated."""
    place = {r["comorbidity"]: i for i, r in enumerate(groups)}
    words = [list(place)[i : i + _WORD] for i in range(0, len(place), _WORD)]
    bit = F.create_map(*[F.lit(x) for c, i in place.items() for x in (c, 1 << (i % _WORD))])
    keys = [c for c in coded.columns if c != "hadm_id"]

    def mask(word):
        return F.bit_or(F.when(F.col("comorbidity").isin(word), bit[F.col("comorbidity")]))

    names = [f"_m{w}" for w in range(len(words))]
    masks = code_map.groupBy(*keys).agg(*[mask(w).alias(n) for n, w in zip(names, words)])
    gathered = join(coded, masks).groupBy("hadm_id").agg(*[F.bit_or(n).alias(n) for n in names])

    def total(weight: str):
        terms = [
            F.getbit(f"_m{i // _WORD}", F.lit(i % _WORD)) * F.lit(float(r[weight]))
            for i, r in enumerate(groups)
        ]
        return reduce(add, [F.coalesce(t, F.lit(0.0)) for t in terms], F.lit(0.0))

    return gathered.select(
        "hadm_id",
        total("w_readmit").alias("elix_readmit"),
        total("w_mortality").alias("elix_mortality"),
        F.coalesce(*names).isNotNull().cast("int").alias("has_chronic"),
    )


def _by_distinct(
    coded: DataFrame, code_map: DataFrame, groups: DataFrame, join: Callable
) -> DataFrame:
    """Scores by distinct (admission, group) pairs, for any number of groups."""
    keys = [c for c in coded.columns if c != "hadm_id"]
    entry = F.struct("comorbidity", "w_readmit", "w_mortality")
    scored = code_map.join(groups, "comorbidity").groupBy(*keys).agg(F.collect_set(entry).alias("g"))
    # An unmapped code keeps its admission, with a NULL group.
    pairs = join(coded, scored).select("hadm_id", F.explode_outer("g").alias("g"))

    def total(weight: str):
        return F.coalesce(F.sum(weight), F.lit(0.0))

    return (
        pairs.select("hadm_id", "g.*")
        .distinct()
        .groupBy("hadm_id")
        .agg(
            total("w_readmit").alias("elix_readmit"),
            total("w_mortality").alias("elix_mortality"),
            F.max(F.col("comorbidity").isNotNull().cast("int")).alias("has_chronic"),
        )
    )


def comorbidity_scores(
    diagnoses: DataFrame,
    code_map: DataFrame,
    weights: DataFrame,
    version: str | None = None,
    mask_groups: int = MASK_GROUPS,
    broadcast_rows: int = BROADCAST_ROWS,
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """(hadm_id, elix_readmit, elix_mortality, has_chronic).

    A group counts once per admission however many of its codes occur, and an
    admission with no mapped code gets zeros. ``version`` names a code-version
    column present in both the diagnoses and the map.
    """
    keys = ["icd_code", *([version] if version else [])]
    coded = normalise_codes(diagnoses.where(F.col("hadm_id").isNotNull())).select("hadm_id", *keys)
    code_map = normalise_codes(code_map).where(F.col("comorbidity").isNotNull())

    def join(facts: DataFrame, table: DataFrame) -> DataFrame:
        return lookup(facts, table, keys, "left", broadcast_rows, min_rows)

    groups = _groups(code_map, weights)
    few = groups.limit(mask_groups + 1).collect()
    if 0 < len(few) <= mask_groups:
        return _by_mask(coded, code_map, few, join)
    return _by_distinct(coded, code_map, groups, join)
