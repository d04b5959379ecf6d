"""Train/test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions import md5_bucket


def _key_text(keys: Sequence[str]) -> Column:
    columns = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return columns[0] if len(columns) == 1 else F.concat_ws("\x1f", *columns)


def with_split(
    df: DataFrame, *keys: str, train_tenths: int = 8, column: str = "split"
) -> DataFrame:
    """Add ``'train'`` or ``'test'`` from a hash of the key columns.

    The side depends on the key alone, so it is the same in every run, file layout and
    engine, and rows that share a key stay together. Needs no shuffle.
    """
    bucket = md5_bucket(_key_text(keys), 10)
    return df.withColumn(
        column, F.when(bucket < train_tenths, F.lit("train")).otherwise(F.lit("test"))
    )


def hash_split(df: DataFrame, *keys: str, train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """Train and test sides of :func:`with_split`."""
    marked = with_split(df, *keys, train_tenths=train_tenths, column="__split")
    return (
        marked.filter(F.col("__split") == "train").drop("__split"),
        marked.filter(F.col("__split") == "test").drop("__split"),
    )


def random_split(
    df: DataFrame, train_fraction: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Spark's seeded split. Which rows land where changes with the input's partitioning."""
    train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    return train, test
