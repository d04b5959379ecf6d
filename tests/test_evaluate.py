import random

import pytest

from txrisk.operators import evaluate
from txrisk.operators.labels import ClassWeights


def predictions(spark, rows):
    return spark.createDataFrame(rows, "label INT, prediction DOUBLE")


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice([0, 1, 1, None]), rng.choice([0.0, 1.0, None])) for _ in range(3000)]
    cells = {
        name: sum(1 for r in rows if r == pair)
        for name, pair in {"tp": (1, 1.0), "tn": (0, 0.0), "fp": (0, 1.0), "fn": (1, 0.0)}.items()
    }
    (row,) = evaluate.metrics(evaluate.confusion(predictions(spark, rows))).collect()
    assert {c: row[c] for c in cells} == cells and row.total == sum(cells.values())
    precision = cells["tp"] / (cells["tp"] + cells["fp"])
    recall = cells["tp"] / (cells["tp"] + cells["fn"])
    assert row.accuracy == pytest.approx((cells["tp"] + cells["tn"]) / row.total)
    assert (row.precision, row.recall) == pytest.approx((precision, recall))
    assert row.f1 == pytest.approx(2 * precision * recall / (precision + recall))


@pytest.mark.parametrize("rows", [[], [(None, 1.0)], [(None, None)]])
def test_zero_denominators(spark, rows):
    (row,) = evaluate.metrics(evaluate.confusion(predictions(spark, rows))).collect()
    assert (row.total, row.accuracy, row.precision, row.recall, row.f1) == (0, 0.0, 0.0, 0.0, 0.0)


def test_only_negatives(spark):
    (row,) = evaluate.metrics(evaluate.confusion(predictions(spark, [(0, 0.0)]))).collect()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)


def test_batch_accuracy_counts_null_labels_as_wrong(spark):
    df = predictions(spark, [(1, 1.0), (0, 1.0), (None, 0.0), (0, 0.0)])
    (row,) = evaluate.batch_accuracy(df, "label").collect()
    assert (row.n_correct, row.n_rows, row.accuracy) == (2, 4, 0.5)


def test_batch_accuracy_without_labels(spark):
    df = predictions(spark, [(1, 1.0)]).drop("label")
    (row,) = evaluate.batch_accuracy(df, "label").collect()
    assert (row.n_correct, row.n_rows, row.accuracy) == (None, 1, None)


def test_batch_accuracy_of_nothing(spark):
    (row,) = evaluate.batch_accuracy(predictions(spark, []), "label").collect()
    assert (row.n_rows, row.accuracy) == (0, 0.0)


def test_one_aggregation_for_all_cells(spark):
    df = predictions(spark, [(1, 1.0), (0, 0.0)])
    plan = evaluate.metrics(evaluate.confusion(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan


def test_one_batch_with_most_rows(spark):
    df = spark.range(0, 30_000, 1, 6).selectExpr(
        "CASE WHEN id % 3 < 2 THEN 0 ELSE CAST(id % 100 AS INT) END AS batch_id",
        "CAST(id % 2 AS INT) AS label",
        "1.0D AS prediction",
    )
    rows = evaluate.batch_accuracy(df, "label", by=["batch_id"]).collect()
    assert len(rows) == 100 and sum(r.n_rows for r in rows) == 30_000
    assert sum(r.n_correct for r in rows) == 15_000
    assert max(r.n_rows for r in rows) == 20_100


def test_report_text(spark):
    df = predictions(spark, [(1, 1.0), (0, 1.0)])
    row = evaluate.report(df, "m", ClassWeights(1, 1, 1.0, 1.0)).first()
    lines = dict(line.split() for line in evaluate.report_text(row).splitlines())
    assert lines["model"] == "m" and lines["tp"] == "1" and lines["precision"] == "0.5000"
