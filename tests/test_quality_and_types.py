"""Cells that do not fit, types found in a file, and timestamps read in one pass."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.functions import parse_timestamp
from txrisk.operators import labels, prep
from txrisk.plans import models, training
from txrisk.sources import files, fixtures

LINES = ["amount,is_fraud,hour_of_day,timestamp,note", "1.5,True,9,2024-01-02,a", "x,maybe,2.5,later,b", ",,,,", " ,0,9.0,2024-01-02T03:04:05,c", "2e3,1,y,2024-01-02 99:00:00,d"]


@pytest.fixture
def path(tmp_path):
    (tmp_path / "t.csv").write_text("\n".join(LINES) + "\n")
    return str(tmp_path / "t.csv")


def test_cells_are_counted_in_the_same_job(spark, path, tmp_path):
    quality = files.CellQuality()
    frame = files.read_transactions(spark, path, quality=quality, unreadable="bad")
    assert frame.columns == ["amount", "is_fraud", "hour_of_day", "timestamp", "note", "bad"]
    spark.sparkContext.setJobGroup("counted", "")
    frame.write.parquet(str(tmp_path / "table"))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    plain = files.read_transactions(spark, path)
    spark.sparkContext.setJobGroup("plain", "")
    plain.write.parquet(str(tmp_path / "plain"))
    assert jobs == len(spark.sparkContext.statusTracker().getJobIdsForGroup("plain"))
    spark.sparkContext.setJobGroup("rest", "")
    assert quality.n_bad == {"amount": 1, "is_fraud": 1, "hour_of_day": 2, "timestamp": 2}
    assert (quality.n_rows, quality.n_bad_rows) == (5, 2)
    aside = sorted(r.bad for r in spark.read.parquet(str(tmp_path / "table")).filter("bad is not null").collect())
    assert aside == ['{"amount":"x","is_fraud":"maybe","hour_of_day":"2.5","timestamp":"later"}', '{"hour_of_day":"y","timestamp":"2024-01-02 99:00:00"}']
    with pytest.raises(files.UnreadableCells, match="2 of 5 rows.*amount: 1, is_fraud: 1"):
        quality.check()
    assert [tuple(r) for r in frame.drop("bad").collect()] == [tuple(r) for r in plain.collect()]


def test_columns_that_are_not_used_are_counted(spark, path):
    quality = files.CellQuality()
    assert files.read_transactions(spark, path, quality=quality).select("note").count() == 5
    assert quality.n_bad["amount"] == 1


def test_training_refuses_bad_cells_before_fitting(spark, tiny, tmp_path, monkeypatch):
    raw = str(tmp_path / "raw")
    fixtures.dirty_csv(spark, tiny).write.option("header", True).csv(raw)
    quality = files.CellQuality()
    df = labels.with_label(files.read_transactions(spark, raw, quality=quality))
    inputs = models.FeatureSpec(numeric=("amount",), categorical=("location",))
    monkeypatch.setattr(models, "train", lambda *a, **k: pytest.fail("fitted"))
    with pytest.raises(files.UnreadableCells, match="timestamp"):
        training.train_and_evaluate(df, models.SPECS["lr", True], inputs, is_train="hour_of_day > 5", stage_at=str(tmp_path / "stage"), after_staging=quality.check)


def test_types_of_a_mixed_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "a,b,c,d,e,f,g,h,i,j\n"
        "1,1,1.5,true,2024-01-02,2024-01-02,x,,007,+5\n"
        "-2,3000000000,.5,FALSE,2024-1-3,01/02/2024 03:04 PM,1,,8,-6\n"
        " 3 ,5,1e5,True,,2024-01-02T03:04:05.5,,,9,1.\n"
    )
    found = files.infer_types(spark, str(tmp_path / "t.csv"))
    assert {c: t.simpleString() for c, t in found.items()} == {
        "a": "int", "b": "bigint", "c": "double", "d": "boolean", "e": "date", "f": "timestamp_ntz", "g": "string", "h": "string", "i": "int", "j": "double",
    }
    files.save_types(spark, str(tmp_path / "kept"), found)
    assert files.load_types(spark, str(tmp_path / "kept")) == found and files.load_types(spark, str(tmp_path)) is None
    typed = files.read_csv(spark, str(tmp_path / "t.csv"), found)
    assert dict(typed.dtypes)["b"] == "bigint" and dict(typed.dtypes)["e"] == "date"
    assert typed.filter("b = 3000000000 and e = date'2024-01-03' and f = timestamp_ntz'2024-01-02 15:04:00'").count() == 1


def test_large_whole_numbers_keep_every_digit(spark, tmp_path):
    (tmp_path / "t.csv").write_text("n\n9007199254740993\n9.0\n2.5\n99999999999999999999\n")
    rows = files.read_csv(spark, str(tmp_path / "t.csv"), {"n": T.LongType()}).collect()
    assert [r.n for r in rows] == [9007199254740993, 9, None, None]


def test_line_breaks_are_not_written_unnoticed(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb", "c"), (2, None, "d\r\ne")], "n int, note string, more string")
    with pytest.raises(Exception, match="has a line break"):
        files.write_prepared(df, str(tmp_path / "refused"))
    files.write_prepared(df, str(tmp_path / "blank"), line_breaks="blank")
    rows = files.read_csv(spark, str(tmp_path / "blank"), {"n": T.IntegerType()}).orderBy("n").collect()
    assert [tuple(r) for r in rows] == [(1, "a b", "c"), (2, None, "d  e")]
    files.write_prepared(df, str(tmp_path / "kept"), line_breaks="keep")
    rows = files.read_csv(spark, str(tmp_path / "kept"), {"n": T.IntegerType()}, {"multiLine": "true"}).orderBy("n").collect()
    assert (rows[0].note, rows[1].more.replace("\r", "")) == ("a\nb", "d\ne")


def test_empty_file_and_blank_columns(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    assert set(map(T.DataType.simpleString, files.infer_types(spark, str(tmp_path / "t.csv")).values())) == {"string"}
    quality = files.CellQuality()
    assert files.read_csv(spark, str(tmp_path / "t.csv"), {"a": T.IntegerType()}, quality=quality).count() == 0
    assert quality.n_bad == {"a": 0} and quality.check() is None


def test_timestamps_are_read_once(spark):
    """Few regular expressions per row, however many columns use the timestamp."""
    raw = spark.createDataFrame([("05/06/2024 10:00:00",)], "timestamp string")
    plan = prep.prepare(raw, drop=[])._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("regexp") + plan.count("rlike") < 30


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-02T03:04:05.123456", "2024-01-02 03:04:05.123456"), ("2024/1/2 3:04:05", "2024-01-02 03:04:05"), ("20240102T030405", None), ("20240102 03:04:05", "2024-01-02 03:04:05"),
        ("13/06/2024", "2024-06-13 00:00:00"), ("06-13-2024", "2024-06-13 00:00:00"), ("5 Mar 2024 12:30:00 AM", "2024-03-05 00:30:00"), ("March 5, 2024 12:30 pm", "2024-03-05 12:30:00"),
        ("Sept. 5 2024", "2024-09-05 00:00:00"), ("01/02/2024 1:05:06.5 pm", "2024-01-02 13:05:06.500000"), ("01/02/2024 13:05 PM", None), ("2024-02-30", None), ("13/13/2024", None), ("soon", None),
        ("  2024-01-02  ", "2024-01-02 00:00:00"), ("2024-01-02 11:59:59 PM", "2024-01-02 23:59:59"), ("2024-01-02 0:30 AM", None),
    ],
)
def test_timestamp_forms(spark, text, expected):
    row = spark.createDataFrame([(text,)], "t string").select(parse_timestamp(F.col("t"), strict=False).cast("string").alias("p")).first()
    assert row.p == (expected.rstrip("0") if expected and "." in expected else expected)
