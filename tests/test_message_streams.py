"""Stream queries on tables whose layout or size differs from that of the test tables."""

import pytest
from pyspark.sql import functions as F

from txrisk.operators import labels
from txrisk.plans import catalog, models
from txrisk.plans.catalog import QUERIES
from txrisk.sources import fixtures


@pytest.fixture
def empty_first(spark, tiny, tmp_path):
    """The tiny event log, read in several splits of which the first holds no rows, so that the first message file is empty."""
    spark.read.parquet(f"{tiny}/events.parquet").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    sizes = spark.read.parquet(f"{tmp_path}/events.parquet").groupBy(F.spark_partition_id()).count().collect()
    assert all(r[0] > 0 for r in sizes)
    yield str(tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_report_with_an_empty_batch(spark, empty_first):
    assert [tuple(r) for r in QUERIES["saved_predictions_report"](spark, empty_first).collect()] == [(1000, 0)]


def test_versions_with_an_empty_batch(spark, empty_first):
    rows = QUERIES["stream_model_versions"](spark, empty_first).groupBy("has_score", "has_version", "few_loads").count()
    assert [tuple(r) for r in rows.collect()] == [(True, True, True, 1000)]


def test_longer_streams_have_larger_batches():
    """The number of batches stays where it is at 100,000 rows, until a batch is as large as a trigger may be."""
    for files_per_batch, most in ((1, 40), (10, 4)):
        for n_rows in (1_000, 100_000, 600_000, 6_000_000):
            rows, files = catalog._batching(n_rows, files_per_batch)
            assert n_rows / (rows * files) <= most
    for n_rows in (36_000_000, 360_000_000):
        rows, files = catalog._batching(n_rows, 10)
        assert 4_000_000 <= rows * files <= catalog.ROWS_PER_TRIGGER
    assert catalog._batching(100_000, 10) == (2_500, 10)


def test_leaves_of_all_trees_at_once(spark, tiny):
    """The leaf that is found for a row answers what its tree answers, for every tree."""
    df = labels.with_label(fixtures.transactions(spark, tiny)).limit(300)
    model = models.train(df, models.SPECS["gbt", False])
    encoded = df
    for stage in model.stages[:-1]:
        encoded = stage.transform(encoded)
    values = catalog._leaf_values(model.stages[-1])
    rows = catalog._with_leaves(model.stages[-1], encoded).select("leaves", "features").collect()
    for row in rows[:40]:
        assert [v[i] for v, i in zip(values, row.leaves)] == [t.predict(row.features) for t in model.stages[-1].trees]


def test_shares_of_all_leaves_of_a_forest_at_once(spark, tiny, monkeypatch):
    """The leaf that is found for a row holds what its tree answers; rows go through the forest once for each of two checks."""
    df = labels.with_label(fixtures.transactions(spark, tiny)).limit(300)
    model = models.train(df, models.SPECS["rf", False])
    encoded = df.withColumn("weight", F.lit(1.0))
    for stage in model.stages[:-1]:
        encoded = stage.transform(encoded)
    forest = model.stages[-1]
    shares = catalog._leaf_shares(forest)
    rows = catalog._with_leaves(forest, encoded).select("leaves", "features").collect()
    for row in rows[:40]:
        assert [s[i] for s, i in zip(shares, row.leaves)] == [t.predictProbability(row.features)[1] for t in forest.trees]
    passes = []
    monkeypatch.setattr(catalog, "_with_leaves", lambda m, f, of=catalog._with_leaves: passes.append(m) or of(m, f))
    scored = models.score(model, df)
    assert catalog._rf_off(forest, encoded, scored) == 0 and len(passes) == 2
    assert catalog._rf_off(forest, encoded, scored.withColumn("p_fraud", F.col("p_fraud") + 0.001)) == 300
    assert catalog._leaves_off(forest, encoded.withColumn("label", 1 - F.col("label"))) > 0
