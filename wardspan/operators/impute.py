"""Exact medians and filling of missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardspan.functions.clinical import known_double

SKETCH_ACCURACY = 10_000


def median_table(
    df: DataFrame, columns: Sequence[str], accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """One row with the exact median of every column (0.0 if all missing).

    An exact percentile keeps every distinct value in one task. Here a quantile
    sketch, whose rank error is bounded, first brackets each median; a second
    pass counts the values below the bracket and the distinct values inside it,
    about ``8 / accuracy`` of the rows, and the middle ranks are read off those.
    """
    cells = F.array(*[known_double(F.col(f"`{c}`")) for c in columns])
    values = df.select(F.posexplode(cells).alias("i", "v")).where("v IS NOT NULL")
    margin = min(0.5, 4.0 / accuracy)
    ends = F.percentile_approx("v", [0.5 - margin, 0.5 + margin], accuracy)
    sketch = values.groupBy("i").agg(F.count(F.lit(1)).alias("n"), ends.alias("ends"))
    # One row per column. Values below the bracket are counted under NULL.
    counted = (
        values.join(F.broadcast(sketch), "i")
        .where(F.col("v") <= F.col("ends")[1])
        .groupBy("i", "n", F.when(F.col("v") >= F.col("ends")[0], F.col("v")).alias("v"))
        .agg(F.count(F.lit(1)).alias("m"))
    )
    by_value = W.partitionBy("i").orderBy(F.col("v").asc_nulls_first())
    upto = F.sum("m").over(by_value.rowsBetween(W.unboundedPreceding, W.currentRow))
    ranked = counted.select("i", "n", "v", upto.alias("upto"), (upto - F.col("m")).alias("before"))

    def at(rank):
        return F.max(F.when((F.col("before") <= rank) & (rank < F.col("upto")), F.col("v")))

    middle = (at(F.expr("(n - 1) div 2")) + at(F.expr("n div 2"))) / 2
    # The sketch guarantees the bracket; never answer wrongly if it ever fails.
    failed = F.raise_error(F.lit("median outside its bracket")).cast("double")
    medians = ranked.groupBy("i").agg(F.coalesce(middle, failed).alias("median"))
    return medians.groupBy().agg(
        *[
            F.coalesce(F.max(F.when(F.col("i") == i, F.col("median"))), F.lit(0.0)).alias(c)
            for i, c in enumerate(columns)
        ]
    )


def fill_from(df: DataFrame, values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill missing (NULL or NaN) cells from a one-row table of values.

    ``values`` may come from other rows than ``df``: fit it on all rows, or on
    the training rows alone to keep test rows out of it. Its one row is fetched
    here, so that ``df`` can be filled again and again without refitting.
    """
    row = values.first()
    return df.withColumns(
        {c: F.coalesce(known_double(F.col(f"`{c}`")), F.lit(row[c])) for c in columns}
    )


def fill_missing(df: DataFrame, value: float, columns: Sequence[str]) -> DataFrame:
    """Fill missing cells of ``columns`` with one constant."""
    return df.na.fill(value, subset=list(columns))


def median_impute(df: DataFrame, columns: Sequence[str], accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Fill ``columns`` with their own medians. ``df`` is scanned three times:
    pass a written table when it is dear to compute."""
    return fill_from(df, median_table(df, columns, accuracy), columns)
