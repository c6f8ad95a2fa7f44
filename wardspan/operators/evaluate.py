"""Scores of predictions. Everything after the first aggregation works on
class counts, whatever the number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def confusion_counts(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """(by, label, prediction, n)."""
    return df.groupBy(
        *by, F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(
    df: DataFrame, classes: Sequence, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per class, one column ``predicted_<class>`` per class, absent
    classes as zeros. A label or prediction outside ``classes`` is an error
    when the result is read."""
    counts = confusion_counts(df, label, prediction)
    known = F.col("label").isin(*classes) & F.col("prediction").isin(*classes)
    message = F.concat(F.lit("class outside the list: "), F.concat_ws(", ", "label", "prediction"))
    checked = F.when(known, F.col("label")).otherwise(F.raise_error(message))
    cells = [
        F.sum(F.when(F.col("prediction") == F.lit(c), F.col("n")).otherwise(0)).alias(f"predicted_{c}")
        for c in classes
    ]
    given = counts.withColumn("label", checked).groupBy("label").agg(*cells)
    every = F.array(*map(F.lit, classes)).cast(T.ArrayType(counts.schema["label"].dataType))
    rows = df.sparkSession.range(1).select(F.explode(every).alias("label"))
    return rows.join(given, "label", "left").na.fill(0, [f"predicted_{c}" for c in classes])


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """(by, name, precision, recall, f1, support): one row per class, then
    ``accuracy`` (under f1), ``macro avg`` and ``weighted avg``.

    A zero denominator gives 0. Classes are those of label or prediction.
    ``by`` columns give a report each, all from one aggregation.
    """
    return report_of_counts(confusion_counts(df, label, prediction, by), by)


def report_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The classification report of (by, label, prediction, n)."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")

    def side(cls, true_positive, support, predicted):
        return F.struct(
            F.col(cls).cast("string").alias("cls"),
            true_positive.cast("bigint").alias("tp"),
            support.alias("support"),
            predicted.alias("predicted"),
        )

    sides = F.array(side("label", hit, F.col("n"), none), side("prediction", none, none, F.col("n")))
    per_class = (
        counts.select(*by, F.explode(sides).alias("s"))
        .select(*by, "s.*")
        .groupBy(*by, "cls")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
        .withColumn("p", _ratio(F.col("tp"), F.col("predicted")))
        .withColumn("r", _ratio(F.col("tp"), F.col("support")))
        .withColumn("f", _ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    )
    # Every line of the report is a weighted mean over the class rows.
    one, support, blank = F.lit(1.0), F.col("support").cast("double"), F.lit(None).cast("double")

    def line(name, weight, p, r, f):
        return F.struct(
            name.alias("name"), weight.alias("w"), p.alias("p"), r.alias("r"), f.alias("f"), "support"
        )

    p, r, f = F.col("p"), F.col("r"), F.col("f")
    lines = F.array(
        line(F.col("cls"), one, p, r, f),
        line(F.lit("accuracy"), support, blank, blank, r),
        line(F.lit("macro avg"), one, p, r, f),
        line(F.lit("weighted avg"), support, p, r, f),
    )

    def mean(c):
        return F.sum(F.col("w") * F.col(c)) / F.sum("w")

    weighted = per_class.select(*by, F.explode(lines).alias("l")).select(*by, "l.*")
    return weighted.groupBy(*by, "name").agg(
        mean("p").alias("precision"),
        mean("r").alias("recall"),
        mean("f").alias("f1"),
        F.sum("support").alias("support"),
    )


def weighted_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(weighted_f1): the F1 of the classes weighted by support."""
    report = classification_report(df, label, prediction)
    return report.where("name = 'weighted avg'").select(F.col("f1").alias("weighted_f1"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(n, mse, mae, r2) in one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    known = df.select(y.alias("y"), p.alias("p")).where("y IS NOT NULL AND p IS NOT NULL")
    error = F.col("y") - F.col("p")
    sums = known.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop("y").alias("_var"),
    )
    return sums.withColumn("r2", F.lit(1.0) - F.try_divide(F.col("mse"), F.col("_var"))).drop("_var")


def roc_auc(df: DataFrame, label: str = "label", score: str = "probability") -> float:
    """Exact area under the ROC curve (no binning of the scores)."""
    evaluator = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="score", metricName="areaUnderROC", numBins=0
    )
    columns = [F.col(label).cast("double").alias("label"), F.col(score).cast("double").alias("score")]
    return evaluator.evaluate(df.select(*columns))
