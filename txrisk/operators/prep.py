"""Raw transactions to prepared transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions import calendar
from txrisk.schema import UNINFORMATIVE


def drop_uninformative(df: DataFrame, columns: Sequence[str] = UNINFORMATIVE) -> DataFrame:
    """Remove columns, refusing names that are absent (Spark alone would ignore those)."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"columns to drop are missing: {', '.join(missing)}")
    return df.drop(*columns)


def with_calendar(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Add ``hour_of_day``, ``day_of_week`` (Monday = 1) and ``is_weekend``."""
    ts = F.col(timestamp)
    return df.withColumns(
        {
            "hour_of_day": calendar.hour_of_day(ts),
            "day_of_week": calendar.day_of_week(ts),
            "is_weekend": calendar.is_weekend(ts),
        }
    )


def prepare(
    df: DataFrame,
    *,
    timestamp: str = "timestamp",
    drop: Sequence[str] = UNINFORMATIVE,
    strict: bool = True,
    extra_formats: Sequence[str] = (),
) -> DataFrame:
    """Drop columns, parse the timestamp text and derive the calendar columns.

    One projection over the scan: no shuffle, and dropped columns are never carried along.
    """
    parsed = drop_uninformative(df, drop).withColumn(
        timestamp,
        calendar.parse_timestamp(F.col(timestamp), strict=strict, extra_formats=extra_formats),
    )
    return with_calendar(parsed, timestamp)
