"""Labels, class counts and class weights."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ClassWeights:
    """Weight of each class, with the counts they come from."""

    n_pos: int
    n_neg: int
    weight_pos: float
    weight_neg: float


def with_label(df: DataFrame, source: str = "is_fraud", label: str = "label") -> DataFrame:
    """Add an integer 0/1 label; a null source stays null."""
    return df.withColumn(label, F.col(source).cast("int"))


def class_counts(df: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Rows per class, in one aggregate: ``n_pos``, ``n_neg``, and ``n_null`` in neither."""
    value = F.col(label)
    return df.groupBy(*by).agg(
        F.count_if(value == 1).alias("n_pos"),
        F.count_if(value == 0).alias("n_neg"),
        F.count_if(value.isNull()).alias("n_null"),
    )


def balanced_weight(n_class: Column, n_other: Column) -> Column:
    """Larger class over this class; 1.0 when either class is empty."""
    usable = (n_class > 0) & (n_other > 0)
    return F.when(usable, F.greatest(n_class, n_other) / n_class).otherwise(F.lit(1.0))


def class_weights(df: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """:func:`class_counts` plus ``weight_pos`` and ``weight_neg``."""
    n_pos, n_neg = F.col("n_pos"), F.col("n_neg")
    return class_counts(df, label, by).withColumns(
        {
            "weight_pos": balanced_weight(n_pos, n_neg),
            "weight_neg": balanced_weight(n_neg, n_pos),
        }
    )


def fit_class_weights(df: DataFrame, label: str = "label") -> ClassWeights:
    """Run the one-row :func:`class_weights` aggregate and return its values."""
    row = class_weights(df, label).first()
    return ClassWeights(row.n_pos, row.n_neg, row.weight_pos, row.weight_neg)


def with_weight(
    df: DataFrame, weights: ClassWeights, label: str = "label", weight: str = "weight"
) -> DataFrame:
    """Add each row's class weight. A null label takes the weight of the negative class."""
    chosen = F.when(F.col(label) == 1, F.lit(weights.weight_pos)).otherwise(
        F.lit(weights.weight_neg)
    )
    return df.withColumn(weight, chosen)
