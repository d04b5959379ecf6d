import hashlib

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txrisk.operators import features
from txrisk.operators.features import FeatureSpec
from txrisk.sources import fixtures

SPEC = FeatureSpec(numeric=("x",), categorical=("a", "b"))
ROWS = [
    (1.0, "v", "p"), (0.0, "u", "p"), (2.0, "v", "q"), (3.0, "u", "q"), (4.0, "w", None),
    (5.0, None, "q"),
]


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(ROWS, "x DOUBLE, a STRING, b STRING")


def test_most_frequent_first_ties_alphabetical(frame):
    assert features.fit_labels(frame, SPEC) == [["u", "v", "w"], ["q", "p"]]


def test_labels_agree_with_string_indexer(spark, small):
    df = fixtures.transactions(spark, small)
    columns = list(features.TRANSACTION_FEATURES.categorical)
    native = StringIndexer(inputCols=columns, outputCols=[f"{c}_i" for c in columns]).fit(df)
    assert features.fit_labels(df) == [list(labels) for labels in native.labelsArray]


def test_ties_beyond_ascii(spark):
    odd = ["\U0001f600", "￮", "z", "é"]
    df = spark.createDataFrame([(0.0, v, "p") for v in odd], "x DOUBLE, a STRING, b STRING")
    native = StringIndexer(inputCol="a", outputCol="i").fit(df)
    assert features.fit_labels(df, SPEC)[0] == list(native.labels)


def test_too_many_categories_are_refused(spark):
    df = spark.range(100).select(
        F.lit(0.0).alias("x"), F.col("id").cast("string").alias("a"), F.lit("p").alias("b")
    )
    with pytest.raises(ValueError, match="more than 50 categories in a"):
        features.fit_labels(df, SPEC, max_categories=50)
    assert len(features.fit_labels(df, SPEC, max_categories=100)[0]) == 100


def test_hot_value_is_counted_before_the_shuffle(spark):
    df = spark.range(10_000, numPartitions=4).select(
        F.lit(0.0).alias("x"), F.lit("hot").alias("a"), (F.col("id") % 3).cast("string").alias("b")
    )
    plan = features.category_counts(df, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_count")
    assert {r.value: r.n for r in features.category_counts(df, SPEC).collect()}["hot"] == 10_000


def test_unseen_and_null_share_the_last_index(spark, frame):
    model = Pipeline(stages=features.stages(SPEC, features.fit_labels(frame, SPEC))).fit(frame)
    other = spark.createDataFrame([(1.0, "new", None)], "x DOUBLE, a STRING, b STRING")
    (row,) = model.transform(other).select("a_idx", "b_idx", vector_to_array("features")).collect()
    assert (row.a_idx, row.b_idx) == (3.0, 2.0)
    assert list(row[2]) == [1.0, 0, 0, 0, 1.0, 0, 0, 1.0]


def test_same_vectors_with_and_without_given_labels(spark, tiny):
    df = fixtures.transactions(spark, tiny)
    native = Pipeline(stages=features.stages()).fit(df)
    given = Pipeline(stages=features.stages(labels=features.fit_labels(df))).fit(df)
    pick = ["transaction_id", vector_to_array("features").alias("v")]
    a = {r.transaction_id: r.v for r in native.transform(df).select(*pick).collect()}
    b = {r.transaction_id: r.v for r in given.transform(df).select(*pick).collect()}
    assert a == b and {len(v) for v in a.values()} == {32}


def test_null_number_becomes_nan(spark, frame):
    model = Pipeline(stages=features.stages(SPEC)).fit(frame)
    missing = spark.createDataFrame([(None, "u", "p")], "x DOUBLE, a STRING, b STRING")
    (row,) = model.transform(missing).select(vector_to_array("features")).collect()
    assert row[0][0] != row[0][0]


def test_vector_slots(spark, frame):
    model = Pipeline(stages=features.stages(SPEC)).fit(frame)
    slots = features.vector_slots(model.transform(frame.limit(1)), "features", "x").collect()
    assert {(r.slot, r.value) for r in slots} == {(0, 1.0), (2, 1.0), (6, 1.0)}


def test_column_without_any_category(spark):
    df = spark.createDataFrame([(1.0, None, "p"), (2.0, None, "q")], "x DOUBLE, a STRING, b STRING")
    known = features.fit_labels(df, SPEC)
    assert known == [[], ["p", "q"]]
    given = Pipeline(stages=features.stages(SPEC, known)).fit(df).transform(df)
    native = Pipeline(stages=features.stages(SPEC)).fit(df).transform(df)
    vectors = [sorted(d.select(vector_to_array("features")).collect()) for d in (given, native)]
    assert vectors[0] == vectors[1]


def test_many_categories_share_hashed_slots(spark, tmp_path):
    values = [(i, f"v{i}" if i % 3 else ("big" if i % 2 else "even bigger" if i % 9 else None), "x") for i in range(3000)]
    df = spark.createDataFrame(values, "id long, wide string, narrow string").repartition(5)
    spec = features.FeatureSpec(numeric=(), categorical=("wide", "narrow"))
    with pytest.raises(ValueError, match="hash_slots"):
        features.fit_labels(df, spec, max_categories=10)
    found = features.fit_labels(df, spec, max_categories=10, hash_slots=8)
    assert found == [["big", "even bigger"], ["x"]] and [f.slots for f in found] == [8, 0]
    assert features.fit_labels(df.repartition(2), spec, max_categories=10, hash_slots=8) == found
    fitted = Pipeline(stages=features.stages(spec, found)).fit(df)
    fitted.write().overwrite().save(str(tmp_path / "encoder"))
    for model in (fitted, PipelineModel.load(str(tmp_path / "encoder"))):
        rows = {r.wide: r for r in model.transform(df).collect()}
        assert rows["big"].wide_idx == 0 and rows["even bigger"].wide_idx == 1 and rows[None].wide_idx == 10
        others = {v: r.wide_idx for v, r in rows.items() if v and v.startswith("v")}
        assert set(others.values()) == set(range(2, 10))
        for v, index in list(others.items())[:50]:
            assert index == 2 + int(hashlib.md5(v.encode()).hexdigest()[:8], 16) % 8
        assert rows["big"].features.size == 2 + 8 + 1 + 1 + 1
        unseen = spark.createDataFrame([(1, "new", "y")], df.schema)
        assert 2 <= model.transform(unseen).first().wide_idx < 10


def test_many_categories_without_a_frequent_one(spark):
    df = spark.range(500).selectExpr("id", "concat('v', id) AS wide")
    spec = features.FeatureSpec(numeric=("id",), categorical=("wide",))
    (found,) = features.fit_labels(df, spec, max_categories=20, hash_slots=4)
    assert found == [] and found.slots == 4
    rows = Pipeline(stages=features.stages(spec, [found])).fit(df).transform(df).select("wide_idx").distinct().collect()
    assert {r.wide_idx for r in rows} == {0, 1, 2, 3}


def test_two_hundred_thousand_values_fit(spark):
    df = spark.range(200_000).selectExpr("id", "CASE WHEN id % 10 < 3 THEN concat('f', id % 3) ELSE concat('v', id) END AS wide", "cast(id % 2 AS double) AS y")
    spec = features.FeatureSpec(numeric=("id",), categorical=("wide",))
    (found,) = features.fit_labels(df, spec, max_categories=100, hash_slots=16)
    assert sorted(found) == ["f0", "f1", "f2"]
