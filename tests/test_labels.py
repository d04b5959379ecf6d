import pytest
from pyspark.sql import functions as F

from txrisk.operators import labels


def labelled(spark, values):
    return spark.createDataFrame([(v,) for v in values], "label INT")


def test_label_from_boolean(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "is_fraud BOOLEAN")
    assert [r.label for r in labels.with_label(df).collect()] == [1, 0, None]


@pytest.mark.parametrize(
    "values, expected",
    [
        ([1, 0, 0, 0], (1, 3, 3.0, 1.0)),
        ([1, 1, 0], (2, 1, 1.0, 2.0)),
        ([1, 1], (2, 0, 1.0, 1.0)),
        ([0], (0, 1, 1.0, 1.0)),
        ([], (0, 0, 1.0, 1.0)),
        ([None, None, 1, 0], (1, 1, 1.0, 1.0)),
    ],
)
def test_weights(spark, values, expected):
    w = labels.fit_class_weights(labelled(spark, values))
    assert (w.n_pos, w.n_neg, w.weight_pos, w.weight_neg) == expected


def test_null_label_takes_the_negative_weight(spark):
    df = labelled(spark, [1, 0, 0, None])
    weighted = labels.with_weight(df, labels.fit_class_weights(df))
    assert {(r.label, r.weight) for r in weighted.collect()} == {(1, 2.0), (0, 1.0), (None, 1.0)}


def test_grouped_weights(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", 0), ("b", 0)], "g STRING, label INT")
    rows = {r.g: (r.weight_pos, r.weight_neg) for r in labels.class_weights(df, by=["g"]).collect()}
    assert rows == {"a": (2.0, 1.0), "b": (1.0, 1.0)}


def test_one_aggregation_for_all_counts(spark):
    df = spark.range(1000).select((F.col("id") % 7 == 0).cast("int").alias("label"))
    plan = labels.class_weights(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan
