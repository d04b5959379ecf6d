"""Saved predictions: attempts, packs and vacuum; every state is compared with what was committed last."""

import pytest
from pyspark.sql import functions as F

from txrisk.operators import evaluate
from txrisk.storage import names, read_text, write_text
from txrisk.streaming.saved import SavedPredictions

KEEP = "transaction_id long"


@pytest.fixture
def saved(spark, tmp_path):
    return SavedPredictions(spark, str(tmp_path / "saved"))


def rows(spark, batch, n=20, days=3, score=1.0):
    numbers = spark.range(n).withColumn("transaction_id", F.col("id") + 1000 * batch)
    return numbers.select(
        "transaction_id",
        F.concat(F.lit("2024-03-0"), (F.col("id") % days + 1).cast("string"), F.lit("T10:00:00")).alias("timestamp"),
        (F.col("id") % 2).cast("int").alias("is_fraud"),
        F.lit(score).alias("prediction"),
    )


def content(saved):
    found = saved.read(KEEP).groupBy("run_id", "batch_id").agg(F.count("*").alias("n"), F.countDistinct("transaction_id").alias("d"), F.sum("prediction").alias("p"))
    told = {(r.run_id, r.batch_id): r.n_rows for r in saved.batches().collect()}
    out = {(r.run_id, r.batch_id): (r.n, r.p) for r in found.collect()}
    assert all(r.n == r.d for r in found.collect())
    assert {k: n for k, n in told.items() if n} == {k: n for k, (n, _) in out.items()}
    return out


def test_batches_are_replaced_packed_and_vacuumed(spark, saved):
    for batch in range(4):
        measures = saved.commit_batch(rows(spark, batch), "a", batch)
        assert measures == {"n_rows": 20, "n_correct": 10, "tp": 10, "tn": 0, "fp": 10, "fn": 0}
    saved.commit_batch(rows(spark, 9, n=5), "b", 0)
    saved.commit_batch(rows(spark, 2, n=7, score=0.0), "a", 2)  # repeated before packing
    want = {("a", 0): (20, 20.0), ("a", 1): (20, 20.0), ("a", 2): (7, 0.0), ("a", 3): (20, 20.0), ("b", 0): (5, 5.0)}
    assert content(saved) == want
    pack = saved.pack()
    assert content(saved) == want and saved.pack() is None
    saved.commit_batch(rows(spark, 3, n=3), "a", 3)  # repeated after packing
    saved.commit_batch(rows(spark, 4), "a", 4)
    want |= {("a", 3): (3, 3.0), ("a", 4): (20, 20.0)}
    assert content(saved) == want
    assert saved.vacuum() == 0 and saved.vacuum(older_than_hours=0) == 6
    assert content(saved) == want
    again = saved.pack()
    assert again != pack and content(saved) == want
    saved.commit_batch(rows(spark, 1, n=2), "a", 1)  # repeated when its commit is long gone
    saved.vacuum(older_than_hours=0)
    want[("a", 1)] = (2, 2.0)
    assert content(saved) == want
    assert saved.pack() and saved.vacuum(older_than_hours=0) and content(saved) == want
    assert len(names(spark, saved._at("commits", "*.json"))) == 1


def test_a_batch_repeated_while_packing(spark, saved, monkeypatch):
    """The pack has read the first attempt, the second one is committed before the pack is."""
    for batch in range(3):
        saved.commit_batch(rows(spark, batch), "a", batch)
    commit, late = SavedPredictions._commit, []

    def slow(self, name, **record):
        if record["kind"] == "pack" and not late:
            late.append(name)
            saved.commit_batch(rows(spark, 1, n=4), "a", 1)
            saved.commit_batch(rows(spark, 7, n=6), "a", 7)
        commit(self, name, **record)

    monkeypatch.setattr(SavedPredictions, "_commit", slow)
    saved.pack()
    want = {("a", 0): (20, 20.0), ("a", 1): (4, 4.0), ("a", 2): (20, 20.0), ("a", 7): (6, 6.0)}
    assert late and content(saved) == want
    saved.vacuum(older_than_hours=0)
    assert content(saved) == want
    saved.pack()
    saved.vacuum(older_than_hours=0)
    assert content(saved) == want


def test_what_was_not_committed_is_not_read(spark, saved, monkeypatch):
    saved.commit_batch(rows(spark, 0), "a", 0)

    def lost(self, name, **record):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(SavedPredictions, "_commit", lost)
        with pytest.raises(RuntimeError):
            saved.commit_batch(rows(spark, 1), "a", 1)
        with pytest.raises(RuntimeError):
            saved.pack()
    assert content(saved) == {("a", 0): (20, 20.0)}
    assert saved.vacuum(older_than_hours=0) == 3  # the batch, and the pack with its members
    assert content(saved) == {("a", 0): (20, 20.0)}


def test_readers_prune_by_day_and_run(spark, saved):
    for batch in range(3):
        saved.commit_batch(rows(spark, batch), f"run{batch}", batch)
    saved.pack()
    table = saved.read(KEEP)
    assert table.columns[0] == "transaction_id" and table.columns[-4:] == ["batch_id", "model_version", "run_id", "day"]
    one = table.filter("day = date'2024-03-02' and run_id = 'run1'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert one.count() == 7
    assert len(table.inputFiles()) == 9
    assert one.select(F.input_file_name().alias("f")).distinct().count() == 1


def test_files_are_cut_by_rows(spark, saved):
    saved.commit_batch(rows(spark, 0, n=400, days=1), "a", 0)
    saved.commit_batch(rows(spark, 1, n=10, days=2), "a", 1)
    saved.pack(rows_per_file=100)
    assert 4 <= len(saved.read(KEEP).inputFiles()) <= 8 and saved.read(KEEP).count() == 410


def test_report_reads_no_rows(spark, saved):
    for batch in range(3):
        saved.commit_batch(rows(spark, batch, score=float(batch % 2)), "a", batch, model_version=f"v{batch % 2}")
    saved.pack()
    saved.commit_batch(rows(spark, 0, n=9, score=1.0), "a", 0, model_version="v2")
    recount = evaluate.metrics(evaluate.confusion(saved.read(KEEP), label="is_fraud"))
    report = saved.report()
    assert report.select(recount.columns).collect() == recount.collect()
    assert not any("/data/" in f for f in report.inputFiles())
    versions = {r.model_version: r.n_rows for r in saved.report("model_version").collect()}
    assert versions == {"v0": 20, "v1": 20, "v2": 9}
    assert {r.model_version for r in saved.read(KEEP).filter("batch_id = 0").collect()} == {"v2"}


def test_odd_batches(spark, saved):
    assert saved.read().collect() == [] and saved.batches().collect() == [] and saved.pack() is None
    assert saved.commit_batch(rows(spark, 0, n=0), "a", 0)["n_rows"] == 0
    no_label = rows(spark, 1).drop("is_fraud").withColumn("timestamp", F.when(F.col("transaction_id") % 2 == 0, "junk"))
    assert saved.commit_batch(no_label, "a", 1) == {"n_rows": 20, "n_correct": None, "tp": None, "tn": None, "fp": None, "fn": None}
    for _ in range(2):
        assert content(saved) == {("a", 1): (20, 20.0)}
        assert saved.read().filter("day is null").count() == 20
        assert saved.report().first().batch_accuracy == 0.0
        saved.pack()
    mixed = saved.read(KEEP + ", colour string")
    assert mixed.filter("colour = 'red'").count() == 0
    saved.commit_batch(rows(spark, 3).withColumn("colour", F.lit("red")), "b", 0)
    saved.pack()
    assert saved.read(KEEP + ", colour string").filter("colour = 'red' and transaction_id is not null").count() == 20
    assert saved.commit_batch(rows(spark, 5), "a", 2, day=F.lit("2030-01-01").cast("date"))["n_rows"] == 20
    assert saved.read().filter("day = date'2030-01-01'").count() == 20


def test_small_files_are_replaced_in_one_step(spark, tmp_path):
    path = str(tmp_path / "folder" / "name.txt")
    assert read_text(spark, path) is None
    for text in ("first", "zweite Fassung, länger", ""):
        write_text(spark, path, text)
        assert read_text(spark, path) == text
    assert [name for name, _ in names(spark, str(tmp_path / "folder" / "*"))] == ["name.txt"]
