"""Confusion matrix, metrics and reports, each from a single aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from txrisk.operators.labels import ClassWeights


def confusion(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """``tp, tn, fp, fn, total``; rows with a null label or prediction count nowhere.

    One map-side aggregated pass, however large a group is.
    """
    actual, predicted = F.col(label).cast("int"), F.col(prediction).cast("int")
    return (
        df.groupBy(*by)
        .agg(
            F.count_if((actual == 1) & (predicted == 1)).alias("tp"),
            F.count_if((actual == 0) & (predicted == 0)).alias("tn"),
            F.count_if((actual == 0) & (predicted == 1)).alias("fp"),
            F.count_if((actual == 1) & (predicted == 0)).alias("fn"),
        )
        .withColumn("total", F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """A quotient that is 0.0 for a zero denominator."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def metrics(cells: DataFrame) -> DataFrame:
    """Add ``accuracy, precision, recall, f1`` to the rows of :func:`confusion`."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    precision, recall = F.col("precision"), F.col("recall")
    return cells.withColumns(
        {
            "accuracy": ratio(tp + tn, F.col("total")),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
        }
    ).withColumn("f1", ratio(2 * precision * recall, precision + recall))


def correct_counts(
    df: DataFrame, label: str = "is_fraud", prediction: str = "prediction"
) -> list[Column]:
    """Aggregates ``n_correct`` and ``n_rows``; without a label column ``n_correct`` is null."""
    if label in df.columns:
        correct = F.count_if(F.col(label) == F.col(prediction))
    else:
        correct = F.max(F.lit(None).cast("bigint"))
    return [correct.alias("n_correct"), F.count(F.lit(1)).alias("n_rows")]


def batch_accuracy(
    df: DataFrame,
    label: str = "is_fraud",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """``n_correct, n_rows, accuracy`` with *all* rows as denominator.

    A null label therefore counts as wrong. Without a label column there is nothing to
    compare, and ``accuracy`` is null as well.
    """
    correct = F.col("n_correct")
    accuracy = F.when(correct.isNotNull(), ratio(correct, F.col("n_rows")))
    counts = df.groupBy(*by).agg(*correct_counts(df, label, prediction))
    return counts.withColumn("accuracy", accuracy)


def report(
    predictions: DataFrame,
    name: str,
    weights: ClassWeights | None = None,
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """One row: model name, class weights, confusion matrix and metrics."""
    weight_pos, weight_neg = (
        (weights.weight_pos, weights.weight_neg) if weights else (1.0, 1.0)
    )
    measured = metrics(confusion(predictions, label, prediction))
    return measured.select(
        F.lit(name).alias("model"),
        F.lit(weight_pos).alias("weight_pos"),
        F.lit(weight_neg).alias("weight_neg"),
        "*",
    )


def report_text(row: Row) -> str:
    """A :func:`report` row as text for a console or a log."""
    width = max(len(name) for name in row.asDict())
    lines = []
    for name, value in row.asDict().items():
        shown = f"{value:.4f}" if isinstance(value, float) else value
        lines.append(f"{name.ljust(width)}  {shown}")
    return "\n".join(lines)
