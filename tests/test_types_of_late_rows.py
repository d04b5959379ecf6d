"""Types of a CSV whose first rows fit narrower types than later ones, and the other way round."""

from txrisk.sources import files


def test_first_rows_decide_nothing_alone(spark, tmp_path):
    head = ("1", "2024-01-05", "true", "2024", "", "x", "7")
    tail = ("2.5", "2024-1-5 10:00:00", "1", "2024-02-01", "3000000000", "1", "x")
    lines = [",".join(head)] * 3000 + [",".join(tail)]
    (tmp_path / "a.csv").write_text("\n".join(["double,moment,text,year,late,code,spoiled", *lines]) + "\n")
    found = {name: kind.simpleString() for name, kind in files.infer_types(spark, str(tmp_path)).items()}
    assert found == {"double": "double", "moment": "timestamp_ntz", "text": "string", "year": "timestamp_ntz", "late": "bigint", "code": "string", "spoiled": "string"}


def test_ruled_out_types_are_not_tried_again(spark, tmp_path):
    """A column that the first rows show to be text, or to be whole numbers, parses no timestamps in the pass over the file."""
    (tmp_path / "a.csv").write_text("code,number\n" + "x,7\n" * 10)
    frame = spark.read.option("header", True).csv(str(tmp_path))
    assert files._met(frame, [63, 63]) == [0, 14]
    assert files._met(frame, [0, 14]) == [0, 14]
    assert files._met(frame.filter("false"), [63, 14]) == [None, None]
