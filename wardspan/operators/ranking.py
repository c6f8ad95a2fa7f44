"""A reproducible random order of rows, and what follows from it: splits,
folds, undersampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardspan.functions.seeded import seeded_hash


def seeded_rank(
    df: DataFrame,
    id_col: str | Sequence[str],
    seed,
    strata: Sequence[str] = (),
    digits: int = 3,
    rank: str = "rank",
    size: str | None = None,
) -> DataFrame:
    """1-based rank by ``md5(seed|id)`` within each stratum; optionally the
    stratum ``size``. An id may be made of several columns.

    A window over a stratum would put a two-valued label in two tasks. The
    rank is taken in two levels instead: inside a bucket of the hash (16 to the
    power ``digits`` per stratum), plus the number of rows in earlier buckets
    from a prefix sum over the bucket counts. Both the windows and the join run
    on the one shuffle by (stratum, bucket). ``df`` is scanned twice.
    """
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    parts = [F.col(f"`{c}`").alias(f"s{i}") for i, c in enumerate(strata)]
    stratum = F.struct(*parts) if parts else F.lit("")
    keyed = (
        df.withColumn("_h", seeded_hash(seed, *ids))
        .withColumn("_stratum", stratum)
        .withColumn("_bucket", F.substring("_h", 1, digits))
    )
    cells = keyed.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy("_stratum")
    earlier = whole.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = cells.select(
        "_stratum",
        "_bucket",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(whole).alias("_size"),
    )
    local = F.row_number().over(W.partitionBy("_stratum", "_bucket").orderBy("_h", *ids))
    ranked = (
        keyed.repartition("_stratum", "_bucket")
        .withColumn("_local", local)
        .join(offsets, ["_stratum", "_bucket"])
        .withColumn(rank, F.col("_offset") + F.col("_local"))
    )
    if size:
        ranked = ranked.withColumn(size, F.col("_size"))
    return ranked.drop("_h", "_stratum", "_bucket", "_local", "_offset", "_size")


def stratified_split(
    df: DataFrame, id_col: str, label: str, test_share: float = 0.2, seed=42
) -> DataFrame:
    """``is_test`` 1 for ``ceil(test_share * n)`` rows of every label."""
    ranked = seeded_rank(df, id_col, seed, [label], rank="_rank", size="_n_label")
    is_test = F.col("_rank") <= F.ceil(F.lit(test_share) * F.col("_n_label"))
    return ranked.withColumn("is_test", is_test.cast("int")).drop("_rank", "_n_label")


def kfold(
    df: DataFrame, id_col: str, folds: int = 10, seed=42, strata: Sequence[str] = ()
) -> DataFrame:
    """``fold`` in 0..folds-1; sizes differ by at most one (per stratum)."""
    ranked = seeded_rank(df, id_col, seed, strata, rank="_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank")


def undersample(df: DataFrame, id_col: str, label: str, seed=42) -> DataFrame:
    """Cut every class down to the size of the smallest, by seeded rank."""
    ranked = seeded_rank(df, id_col, seed, [label], rank="_rank", size="_n_label")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    smallest = sizes.agg(F.min("n"))
    return ranked.where(F.col("_rank") <= smallest.scalar()).drop("_rank", "_n_label")
