import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txrisk.operators import evaluate, labels, split
from txrisk.operators.features import FeatureSpec
from txrisk.plans import catalog, models, registry, training
from txrisk.plans.models import SPECS, ModelSpec
from txrisk.sources import fixtures
from txrisk.storage import materialize, scratch_path

TRAIN = "split = 'train'"


@pytest.fixture(scope="module")
def data(spark, small):
    df = labels.with_label(fixtures.transactions(spark, small)).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def runs(data):
    return {key: training.train_and_evaluate(data, s, is_train=TRAIN) for key, s in SPECS.items()}


@pytest.fixture(scope="module")
def reports(runs):
    return {key: run.report.first() for key, run in runs.items()}


# Fixed values, written out once more: what each variant must be trained with.
EXPECTED = {
    "gbt": {"maxIter": 10, "maxDepth": 4, "stepSize": 0.1, "seed": 42, "lossType": "logistic"},
    "lr": {"maxIter": 20, "regParam": 0.0, "elasticNetParam": 0.0, "threshold": 0.5},
    "rf": {"numTrees": 20, "maxDepth": 6, "seed": 42, "impurity": "gini"},
}


@pytest.mark.parametrize("algo", EXPECTED)
@pytest.mark.parametrize("weighted", [True, False])
def test_parameters(spark, algo, weighted):
    classifier = models.build(SPECS[algo, weighted]).getStages()[-1]
    found = {p.name: v for p, v in classifier.extractParamMap().items()}
    assert {k: found[k] for k in EXPECTED[algo]} == EXPECTED[algo]
    assert found["labelCol"] == "label" and found["featuresCol"] == "features"
    assert found.get("weightCol") == ("weight" if weighted else None)


def test_stage_kinds(runs):
    kinds = [type(s).__name__ for s in runs["gbt", True].model.stages]
    assert kinds[:4] == ["StringIndexerModel"] * 4
    assert kinds[4:] == ["OneHotEncoderModel", "VectorAssembler", "GBTClassificationModel"]


def test_same_rows_are_held_out(reports):
    assert {(r.tp + r.fn, r.tn + r.fp) for r in reports.values()} == {(148, 1855)}


@pytest.mark.parametrize("algo", ["gbt", "lr", "rf"])
def test_weighting_raises_recall(reports, algo):
    weighted, unweighted = reports[algo, True], reports[algo, False]
    assert weighted.recall >= 0.8
    assert weighted.recall >= unweighted.recall - 0.01
    assert weighted.precision <= unweighted.precision + 0.01


def test_weights_reported(runs, reports):
    assert runs["rf", True].weights.weight_pos == pytest.approx(9216 / 784)
    assert reports["rf", True].weight_pos == pytest.approx(9216 / 784)
    assert reports["rf", False].weight_pos == 1.0


def test_weights_from_the_training_side(data):
    run = training.train_and_evaluate(data, SPECS["lr", True], is_train=TRAIN, weights_from="train")
    assert (run.weights.n_pos, run.weights.n_neg) == (636, 7361)
    assert run.weights.weight_pos == pytest.approx(7361 / 636)
    with pytest.raises(ValueError):
        training.train_and_evaluate(data, SPECS["lr", True], is_train=TRAIN, weights_from="test")


def test_agrees_with_a_plain_spark_pipeline(data, runs):
    """Same coefficients as fitting unguarded indexers on the unarranged training rows."""
    weights = labels.fit_class_weights(data)
    train = labels.with_weight(data, weights).filter(TRAIN)
    plain: Pipeline = models.build(SPECS["lr", True])
    expected = plain.fit(train).stages[-1]
    found = runs["lr", True].model.stages[-1]
    assert found.coefficients.toArray() == pytest.approx(expected.coefficients.toArray(), abs=1e-6)
    assert found.intercept == pytest.approx(expected.intercept, abs=1e-6)


def broken_rows(data):
    """Some rows without label or amount, one category missing."""
    n = F.col("transaction_id")
    return data.withColumns(
        {
            "label": F.when(n % 50 != 0, F.col("label")),
            "amount": F.when(n % 50 != 1, F.col("amount")).when(n % 100 == 1, F.lit(math.nan)),
            "location": F.when(n % 50 != 2, F.col("location")),
        }
    )


@pytest.mark.parametrize("algo", ["gbt", "lr", "rf"])
def test_unusable_rows_are_left_out_and_counted(data, algo):
    df = broken_rows(data)
    usable = "label IS NOT NULL AND amount IS NOT NULL AND NOT isnan(amount)"
    n_train = df.filter(TRAIN).count()
    n_usable = df.filter(TRAIN).filter(usable).count()
    run = training.train_and_evaluate(df, SPECS[algo, True], is_train=TRAIN)
    assert (run.n_train, run.n_dropped) == (n_usable, n_train - n_usable)
    tested = df.filter("split = 'test' AND label IS NOT NULL").count()
    assert run.report.first().total == tested


def test_missing_numbers_are_flagged_when_scoring(data, runs):
    df = broken_rows(data).filter("split = 'test'")
    scored = models.score(runs["lr", True].model, df)
    rows = scored.select("amount", "features_ok", "p_fraud", "prediction").collect()
    missing = [r for r in rows if r.amount is None or math.isnan(r.amount)]
    assert missing and not any(r.features_ok for r in missing)
    assert all(math.isnan(r.p_fraud) and r.prediction == 0.0 for r in missing)
    assert all(r.features_ok for r in rows if r not in missing)


def test_one_class_trains_with_unit_weights(data):
    run = training.train_and_evaluate(data.filter("label = 0"), SPECS["rf", True], is_train=TRAIN)
    assert (run.weights.weight_pos, run.weights.weight_neg) == (1.0, 1.0)
    row = run.report.first()
    assert (row.tp, row.fp, row.fn, row.recall) == (0, 0, 0, 0.0)


def test_nothing_to_train_on(data):
    with pytest.raises(ValueError, match="no usable training rows"):
        training.train_and_evaluate(data.filter("false"), SPECS["lr", True], is_train=TRAIN)


def test_refit_on_the_same_written_table(data):
    table = materialize(data.repartition(5), scratch_path(data.sparkSession, "refit"))
    weighted = labels.with_weight(table, labels.fit_class_weights(table))

    def trees():
        model = models.train(weighted.filter(TRAIN), SPECS["rf", True])
        return model.stages[-1].toDebugString.split("\n", 1)[1]

    assert trees() == trees()


def test_staged_run(spark, data, reports):
    path = scratch_path(spark, "staged")
    run = training.train_and_evaluate(data, SPECS["lr", True], is_train=TRAIN, stage_at=path)
    row, direct = run.report.first(), reports["lr", True]
    assert spark.read.parquet(path).count() == data.count()
    plan = run.report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "__train" in plan.split("PartitionFilters: [")[1]
    assert row.total == direct.total and row.recall == pytest.approx(direct.recall, abs=0.02)


def test_save_replaces_and_loads(spark, data, runs):
    path = scratch_path(spark, "saved")
    registry.save(runs["lr", False].model, path)
    registry.save(runs["gbt", False].model, path)
    loaded = registry.load(path)

    def answers(model):
        scored = models.score(model, data)
        pick = scored.select("transaction_id", "p_fraud", vector_to_array("probability").alias("p"))
        return sorted(pick.collect())

    assert answers(loaded) == answers(runs["gbt", False].model)


def test_other_table_other_columns(spark, small):
    inputs = FeatureSpec(numeric=("n_chars",), categorical=("lang", "source"))
    df = labels.with_label(fixtures.labelled_documents(spark, small), "toxic")
    run = training.train_and_evaluate(
        split.with_split(df, "doc_id"), ModelSpec("rf", True), inputs, is_train=TRAIN
    )
    assert run.report.first().total == df.count() - run.n_train - run.n_dropped


@pytest.mark.parametrize("algo", ["rf", "gbt"])
def test_given_partitions_fix_the_trees(data, algo):
    """Whatever the layout of the input, and so whatever the cluster."""
    weighted = labels.with_weight(data, labels.fit_class_weights(data)).filter(TRAIN)

    def trees(frame):
        model = models.train(frame, SPECS[algo, True], partitions=3)
        return model.stages[-1].toDebugString.split("\n", 1)[1]

    assert trees(weighted.repartition(7)) == trees(weighted.coalesce(1)) == trees(weighted.repartition(2, "amount"))


def test_composed_with_a_random_split(data):
    weighted = labels.with_weight(data, labels.fit_class_weights(data))
    train, test = split.random_split(weighted)
    model = models.train(train, SPECS["lr", True])
    row = evaluate.report(models.score(model, test), "lr").first()
    assert row.total == test.count() and row.recall >= 0.8


@pytest.mark.parametrize("algo", ["gbt", "rf"])
def test_trees_fitted_to_other_labels_are_noticed(spark, tiny, algo):
    """The checks of the catalog find nothing in a fit to these rows, and much in one to permuted labels."""
    df = labels.with_label(fixtures.transactions(spark, tiny)).withColumn("weight", F.lit(1.0))
    other = df.withColumn("label", (F.xxhash64("transaction_id") % 3 == 0).cast("int"))
    for fitted_on, expected in ((df, False), (other, True)):
        table = materialize(fitted_on, scratch_path(spark, "training"))
        model = models.train(table, SPECS[algo, False])
        encoded = table.drop("label").join(df.select("transaction_id", "label"), "transaction_id")
        for stage in model.stages[:-1]:
            encoded = stage.transform(encoded)
        check = catalog._gbt_off if algo == "gbt" else catalog._leaves_off
        off = check(model.stages[-1], encoded, None) if algo == "gbt" else check(model.stages[-1], encoded)
        assert (off > 5) == expected
