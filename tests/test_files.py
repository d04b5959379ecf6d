from datetime import datetime
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from txrisk.sources import files, fixtures
from txrisk.storage import materialize, scratch_path


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(
        tmp_path / "t.csv",
        "extra,is_fraud,amount,timestamp,hour_of_day",
        "x,True,1.5,2024-01-02 03:04:05.000007,9",
        ",False,,2024-01-02 03:04:05,",
    )
    df = files.read_transactions(spark, path)
    assert dict(df.dtypes) == {
        "extra": "string", "is_fraud": "boolean", "amount": "double",
        "timestamp": "timestamp_ntz", "hour_of_day": "int",
    }
    first, second = df.collect()
    assert first.timestamp == datetime(2024, 1, 2, 3, 4, 5, 7) and first.is_fraud is True
    assert (second.extra, second.amount, second.hour_of_day, second.is_fraud) == (None, None, None, False)


def test_integers_written_as_floats(spark, tmp_path):
    path = write(tmp_path / "t.csv", "hour_of_day,day_of_week", "9.0,1", ",2.5", "x,7")
    rows = [tuple(r) for r in files.read_transactions(spark, path).collect()]
    assert rows == [(9, 1), (None, None), (None, 7)]


def test_labels_and_times_as_other_tools_write_them(spark, tmp_path):
    path = write(
        tmp_path / "t.csv", "is_fraud,timestamp",
        "True,2024-01-02T03:04:05.5", "0,2024-01-02", "1,later", "maybe,", "FALSE,2024-01-02 03:04:05",
    )
    rows = [tuple(r) for r in files.read_transactions(spark, path).collect()]
    assert rows == [
        (True, datetime(2024, 1, 2, 3, 4, 5, 500_000)),
        (False, datetime(2024, 1, 2)),
        (True, None),
        (None, None),
        (False, datetime(2024, 1, 2, 3, 4, 5)),
    ]


def test_other_header_in_a_second_file_fails(spark, tmp_path):
    write(tmp_path / "a.csv", "amount,location", "1.5,Tokyo")
    write(tmp_path / "b.csv", "location,amount", "Tokyo,1.5")
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.read_transactions(spark, str(tmp_path)).collect()


def test_raw_timestamp_stays_text(spark, tmp_path):
    path = write(tmp_path / "t.csv", "timestamp,amount", "01/02/2024,1.5")
    assert files.read_raw(spark, path).first().timestamp == "01/02/2024"


def test_roundtrip_keeps_odd_text_and_microseconds(spark):
    path = scratch_path(spark, "csv")
    rows = [(datetime(2024, 1, 2, 3, 4, 5, 1), 'a "b", c', 0.1), (None, "line", None)]
    schema = "timestamp TIMESTAMP_NTZ, location STRING, amount DOUBLE"
    files.write_prepared(spark.createDataFrame(rows, schema), path)
    assert sorted(map(tuple, files.read_transactions(spark, path).collect()), key=str) == sorted(
        rows, key=str
    )


def test_exchange_with_pandas(spark, tmp_path):
    written = pd.DataFrame(
        {
            "location": ['a "b", c', "Zürich", None],
            "amount": [0.1, None, 1e-7],
            "is_fraud": [True, False, True],
            "hour_of_day": [9.0, None, 23.0],
            "timestamp": pd.to_datetime(["2024-01-02 03:04:05.5", None, "2024-01-03"], format="mixed"),
        }
    )
    written.to_csv(tmp_path / "pandas.csv", index=False)
    rows = [tuple(r) for r in files.read_transactions(spark, str(tmp_path / "pandas.csv")).collect()]
    assert rows == [
        ('a "b", c', 0.1, True, 9, datetime(2024, 1, 2, 3, 4, 5, 500_000)),
        ("Zürich", None, False, None, None),
        (None, 1e-7, True, 23, datetime(2024, 1, 3)),
    ]
    out = tmp_path / "spark"
    files.write_prepared(files.read_transactions(spark, str(tmp_path / "pandas.csv")).coalesce(1), str(out))
    back = pd.read_csv(next(out.glob("part-*.csv")), parse_dates=["timestamp"])
    pd.testing.assert_frame_equal(back.fillna(0), written.fillna(0), check_dtype=False)


def test_only_used_columns_are_scanned(spark, tiny):
    path = scratch_path(spark, "csv")
    files.write_prepared(fixtures.transactions(spark, tiny), path)
    df = files.read_transactions(spark, path).groupBy("is_fraud").agg(F.count("*"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<is_fraud:string>" in plan


def test_preview(spark):
    df = spark.range(100)
    assert files.preview(df).count() == 20
    assert [r.id for r in files.preview(df, 3, [F.desc("id")]).collect()] == [99, 98, 97]


def test_scratch_follows_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(base) and first != second


class Session:
    """The parts of a session that decide on the shared folder, without the setting."""

    conf: dict = {}

    def __init__(self, master):
        self.sparkContext = SimpleNamespace(master=master)


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session("yarn"), "x")
    assert "/txrisk/x-" in scratch_path(Session("local[2]"), "x")


def test_materialize_reads_its_own_files(spark):
    df = materialize(spark.range(10), scratch_path(spark, "ids"))
    assert df.count() == 10 and len(df.inputFiles()) > 0
