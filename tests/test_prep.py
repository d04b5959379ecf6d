from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from txrisk.functions import parse_timestamp
from txrisk.operators import prep
from txrisk.schema import UNINFORMATIVE
from txrisk.sources import fixtures


def parsed(spark, texts, **settings):
    df = spark.createDataFrame([(t,) for t in texts], "s STRING")
    return [r.ts for r in df.select(parse_timestamp(F.col("s"), **settings).alias("ts")).collect()]


def test_formats_vary_by_row(spark):
    assert parsed(
        spark,
        ["2024-01-02T03:04:05.123456", "2024-01-02 03:04:05", "01/02/2024 03:04:05.000001",
         "1/2/2024", "2024-01-02", " 2024-01-02 03:04 "],
    ) == [
        datetime(2024, 1, 2, 3, 4, 5, 123456),
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2, 3, 4, 5, 1),
        datetime(2024, 1, 2),
        datetime(2024, 1, 2),
        datetime(2024, 1, 2, 3, 4),
    ]


def test_same_answers_as_pandas(spark, tiny):
    rows = fixtures.raw_transactions(spark, tiny).select("timestamp").collect()
    texts = [r.timestamp for r in rows]
    expected = pd.to_datetime(pd.Series(texts), format="mixed")
    assert parsed(spark, texts) == [t.to_pydatetime() for t in expected]


def test_missing_text_is_null_even_when_strict(spark):
    assert parsed(spark, [None, "", "  "]) == [None, None, None]


@pytest.mark.parametrize("text", ["soon", "13/45/2024 00:00:00", "2024-02-30"])
def test_malformed_text(spark, text):
    assert parsed(spark, [text], strict=False) == [None]
    with pytest.raises(PySparkException, match="unparseable timestamp"):
        parsed(spark, [text])


def test_extra_formats(spark):
    assert parsed(spark, ["02.Jan.2024 03:04"], extra_formats=["dd.MMM.yyyy HH:mm"]) == [
        datetime(2024, 1, 2, 3, 4)
    ]


def test_more_forms(spark):
    texts = ["2024/01/05 03:04:05", "20240105", "20240105 03:04", "01-05-2024", "25/12/2024 10:00:00", "25-12-2024",
             "Jan 5, 2024", "5 January 2024 03:04", "05-Jan-2024", "December 25, 2024 03:04:05 PM", "01/05/2024 12:04 AM",
             "01/05/2024 12:04 pm", "1/5/2024 3:04:05.5 PM"]
    assert parsed(spark, texts) == [t.to_pydatetime() for t in pd.to_datetime(pd.Series(texts), format="mixed")]


def test_patterns_know_no_zone(spark):
    """Neither hour exists once and only once in New York, where clocks change."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert parsed(spark, ["10.03.2024 02:30", "03.11.2024 01:30"], extra_formats=["dd.MM.yyyy HH:mm"]) == [
            datetime(2024, 3, 10, 2, 30), datetime(2024, 11, 3, 1, 30),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_session_zone_does_not_matter(spark):
    """02:30 on this day does not exist in Berlin."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = spark.createDataFrame([("2024-03-31 02:30:00",)], "timestamp STRING")
        (row,) = prep.prepare(df, drop=()).collect()
        assert (row.timestamp, row.hour_of_day) == (datetime(2024, 3, 31, 2, 30), 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_calendar_against_python(spark):
    days = [datetime(2023, 12, 20) + timedelta(hours=17 * n) for n in range(400)]
    df = spark.createDataFrame([(d,) for d in days], "timestamp TIMESTAMP_NTZ")
    for r in prep.with_calendar(df).collect():
        assert r.hour_of_day == r.timestamp.hour
        assert r.day_of_week == r.timestamp.isoweekday()
        assert r.is_weekend == int(r.timestamp.isoweekday() >= 6)


def test_missing_timestamp_is_no_weekend(spark):
    df = spark.createDataFrame([(None,)], "timestamp TIMESTAMP_NTZ")
    (row,) = prep.with_calendar(df).collect()
    assert (row.hour_of_day, row.day_of_week, row.is_weekend) == (None, None, 0)


def test_drop_refuses_absent_columns(spark):
    with pytest.raises(ValueError, match="geo_anomaly_score"):
        prep.drop_uninformative(spark.range(1))


def test_dropped_columns_are_not_computed(spark, tiny):
    prepared = prep.prepare(fixtures.raw_transactions(spark, tiny))
    assert not set(UNINFORMATIVE) & set(prepared.columns)
    plan = prepared._jdf.queryExecution().executedPlan().toString()
    assert "ACC" not in plan and "Exchange" not in plan
