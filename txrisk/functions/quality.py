"""Checks on feature values and access to model probabilities."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def all_present(columns: Iterable[str]) -> Column:
    """True where every named numeric column is neither null nor NaN."""
    checks = (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns)
    return reduce(Column.__and__, checks, F.lit(True))


def p_positive(probability: str = "probability") -> Column:
    """Probability of class 1 as a plain double."""
    return vector_to_array(F.col(probability))[1]
