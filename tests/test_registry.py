"""Versions of a model, their contract, and a stream that changes over to a new one."""

import pytest

from txrisk.operators import labels
from txrisk.plans import models, registry, training
from txrisk.sources import fixtures


@pytest.fixture(scope="module")
def fitted(spark, tiny):
    df = labels.with_label(fixtures.transactions(spark, tiny))
    runs = {algo: training.train_and_evaluate(df, models.SPECS[algo, True], is_train="split = 'train'").model for algo in ("lr", "rf")}
    return df, runs


def test_versions_and_pointer(spark, fitted, tmp_path):
    df, runs = fitted
    at = str(tmp_path / "model")
    with pytest.raises(ValueError, match="no model"):
        registry.current(at)
    assert registry.publish(runs["lr"], at, df.schema) == "000001"
    live = registry.CurrentModel(at)
    first = live(df.schema)
    assert live() is first and live.n_loads == 1
    assert registry.publish(runs["rf"], at, df.schema) == "000002" == registry.current(at)
    assert live().stages[-1].numClasses == 2 and live.version == "000002" and live.n_loads == 2
    registry.use(at, "000001")
    live()
    assert live.version == "000001" and live.n_loads == 3
    with pytest.raises(ValueError, match="no version 000009"):
        registry.use(at, "000009")
    expected = models.score(runs["lr"], df).select("transaction_id", "p_fraud").collect()
    assert models.score(live(), df).select("transaction_id", "p_fraud").collect() == expected


def test_contract_is_checked_when_a_version_is_first_used(spark, fitted, tmp_path):
    df, runs = fitted
    at = str(tmp_path / "model")
    version = registry.publish(runs["lr"], at, df.schema)
    assert registry.contract(at, version)["amount"] == "double"
    for rows, message in ((df.drop("location"), "location is missing"), (df.withColumn("amount", df.amount.cast("string")), "amount is string")):
        live = registry.CurrentModel(at)
        with pytest.raises(ValueError, match=message):
            live(rows.schema)
        assert live.version is None
    registry.CurrentModel(at)(df.withColumn("amount", df.amount.cast("float")).schema)


def test_a_fitted_model_scores_after_an_observed_write(spark, fitted, tmp_path):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    df, runs = fitted
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(str(tmp_path / "rows"))
    assert seen.get["n"] == 1000
    for model in runs.values():
        assert models.score(model, df).filter("p_fraud > 1").count() == 0
