import json
import math
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from txrisk.operators import labels
from txrisk.plans import models, training
from txrisk.schema import KAFKA_RECORD, PAYLOAD, SCORED
from txrisk.sources import files, fixtures, kafka
from txrisk.streaming.decode import decode
from txrisk.streaming.scoring import run_to_end, score_stream, scored_rows, write_scored

N_BATCHES = 4
NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def model(spark, tiny):
    df = labels.with_label(fixtures.transactions(spark, tiny))
    return training.train_and_evaluate(
        df, models.SPECS["gbt", True], is_train="split = 'train'"
    ).model


@pytest.fixture(scope="module")
def inbox(spark, tiny, tmp_path_factory):
    """1000 messages in four files of 250."""
    path = str(tmp_path_factory.mktemp("inbox") / "messages")
    messages = fixtures.payloads(spark, tiny).coalesce(1)
    messages.write.option("maxRecordsPerFile", 250).parquet(path)
    return path


class Job:
    """A scoring stream over an inbox, one file per batch."""

    def __init__(self, spark, inbox, model, base):
        self.spark, self.inbox, self.model = spark, inbox, model
        self.out, self.checkpoint = str(base / "out"), str(base / "checkpoint")
        self.measures = {}

    def messages(self):
        reader = self.spark.readStream.schema(KAFKA_RECORD).option("maxFilesPerTrigger", 1)
        return decode(reader.parquet(self.inbox), keep=["offset"])

    def start(self, **settings):
        settings = {
            "trigger": NOW, "keep": ["offset"], "on_batch": self.measures.__setitem__, **settings
        }
        model = settings.pop("model", self.model)
        return score_stream(self.messages(), model, self.out, self.checkpoint, **settings)

    def run(self, **settings):
        query = self.start(**settings)
        assert run_to_end(query)
        return query

    def saved(self):
        return self.spark.read.parquet(self.out)

    def ids(self):
        return sorted(r.offset for r in self.saved().select("offset").collect())


@pytest.fixture
def job(spark, inbox, model, tmp_path):
    return Job(spark, inbox, model, tmp_path)


def test_stream_equals_batch(spark, job, inbox, model):
    query = job.run()
    assert job.ids() == list(range(1000))
    columns = ["offset", *PAYLOAD.names, "prediction", "p_fraud", "decode_ok", "features_ok"]
    batch = decode(spark.read.schema(KAFKA_RECORD).parquet(inbox), keep=["offset"])
    expected = scored_rows(model, batch, keep=["offset"]).select(columns)
    assert sorted(job.saved().select(columns).collect()) == sorted(expected.collect())
    runs = job.saved().groupBy("run_id", "batch_id").count().collect()
    assert sorted((r.run_id, r.batch_id, r["count"]) for r in runs) == [
        (str(query.id), n, 250) for n in range(N_BATCHES)
    ]


def test_measures_of_each_batch(job):
    job.run()
    assert sorted(job.measures) == list(range(N_BATCHES))
    for batch_id, found in job.measures.items():
        rows = job.saved().filter(F.col("batch_id") == batch_id).collect()
        correct = sum(r.is_fraud == r.prediction for r in rows)
        assert found == {"n_rows": 250, "n_correct": correct, "accuracy": correct / 250}


def test_restart_adds_nothing(job):
    first, second = job.run(), job.run()
    assert first.id == second.id and job.ids() == list(range(1000))


def test_replay_after_a_lost_commit_adds_nothing(job):
    job.run()
    log = Path(job.checkpoint) / "commits"
    last = str(N_BATCHES - 1)
    (log / last).unlink()
    (log / f".{last}.crc").unlink(missing_ok=True)
    job.measures.clear()
    job.run()
    assert list(job.measures) == [N_BATCHES - 1]
    assert job.ids() == list(range(1000))


def test_new_checkpoint_keeps_earlier_runs(job, tmp_path):
    first = job.run()
    job.checkpoint = str(tmp_path / "other")
    second = job.run()
    assert first.id != second.id and len(job.ids()) == 2000


def test_failure_stops_the_query_and_a_restart_recovers(job):
    def failing(batch_id, measures):
        if batch_id == 2:
            raise RuntimeError("disk full")

    with pytest.raises(StreamingQueryException, match="disk full"):
        job.run(on_batch=failing)
    job.run()
    assert job.ids() == list(range(1000))


def test_model_given_as_function(job):
    asked = []

    def current():
        asked.append(1)
        return job.model

    job.run(model=current)
    assert len(asked) == N_BATCHES and job.ids() == list(range(1000))


def test_named_run(job):
    job.run(run_id="march")
    assert {r.run_id for r in job.saved().select("run_id").collect()} == {"march"}


def test_native_mode(job):
    job.run(mode="native")
    job.run(mode="native")
    assert job.ids() == list(range(1000))
    assert not {"run_id", "batch_id"} & set(job.saved().columns)


def test_modes_are_checked(job):
    with pytest.raises(ValueError):
        job.start(mode="other")
    with pytest.raises(ValueError):
        job.start(mode="native", model=lambda: job.model)


def test_stream_without_label(spark, job):
    stream = job.messages().drop("is_fraud")
    query = score_stream(
        stream, job.model, job.out, job.checkpoint, trigger=NOW, on_batch=job.measures.__setitem__
    )
    run_to_end(query)
    assert job.measures[0] == {"n_rows": 250, "n_correct": None, "accuracy": None}
    assert "is_fraud" not in job.saved().columns


def test_empty_batches_are_skipped(spark, job):
    stream = job.messages().filter("offset >= 500")
    query = score_stream(
        stream, job.model, job.out, job.checkpoint, trigger=NOW, on_batch=job.measures.__setitem__
    )
    run_to_end(query)
    assert sum(m["n_rows"] for m in job.measures.values()) == 500
    assert job.saved().count() == 500
    assert len(job.measures) == 2


def test_saved_table_schema_and_pruning(spark, job):
    query = job.run(keep=[])
    saved = files.read_predictions(spark, job.out)
    assert saved.schema == SCORED and saved.count() == 1000
    one = saved.filter((F.col("run_id") == query.id) & (F.col("batch_id") == 1))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan
    assert one.count() == 250 and len(one.inputFiles()) >= 1


def test_batches_rewrite_their_own_partition_only(spark, model, inbox, tmp_path):
    rows = scored_rows(model, decode(spark.read.schema(KAFKA_RECORD).parquet(inbox)))
    out = str(tmp_path / "out")
    write_scored(rows, out, "a", 0)
    write_scored(rows.limit(10), out, "a", 1)
    write_scored(rows.limit(20), out, "b", 1)
    write_scored(rows.limit(5), out, "a", 1)
    counts = files.read_predictions(spark, out).groupBy("run_id", "batch_id").count().collect()
    assert sorted(map(tuple, counts)) == [("a", 0, 1000), ("a", 1, 5), ("b", 1, 20)]


def test_query_handle(spark, job):
    query = job.start(trigger={"processingTime": "1 second"})
    assert query.id and query.isActive and "message" in query.status
    query.processAllAvailable()
    assert run_to_end(query, timeout=0.1) is False
    assert not query.isActive and job.ids() == list(range(1000))


def test_decode_edge_cases(spark):
    messages = [
        ("junk", "not json"),
        ("missing", None),
        ("empty", ""),
        ("array", "[1, 2]"),
        ("cut", '{"amount": 3'),
        ("wrong", '{"amount": "abc", "location": "Tokyo", "is_fraud": 1}'),
        ("fraction", '{"amount": 1.5, "hour_of_day": 2.5}'),
        ("extra", '{"amount": 2.0, "other": 1}'),
        ("nothing", "{}"),
    ]
    df = spark.createDataFrame(messages, "id STRING, value STRING")
    df = df.withColumn("value", F.col("value").cast("binary"))
    rows = {r.id: r for r in decode(df, keep=["id"]).collect()}
    assert {k for k, r in rows.items() if r.decode_ok} == {"extra", "nothing"}
    assert (rows["wrong"].amount, rows["wrong"].location, rows["wrong"].is_fraud) == (None, "Tokyo", 1)
    assert (rows["fraction"].amount, rows["fraction"].hour_of_day) == (1.5, None)
    assert rows["extra"].amount == 2.0
    assert decode(df).columns == [*PAYLOAD.names, "decode_ok"]


def test_bad_messages_are_scored_and_flagged(spark, model, tiny):
    dirty = decode(fixtures.dirty_payloads(spark, tiny), keep=["offset"])
    rows = scored_rows(model, dirty, keep=["offset"]).collect()
    assert len(rows) == 1000
    assert {r.offset % 20 for r in rows if not r.decode_ok} == {0, 1, 2, 3}
    assert all(not math.isnan(r.p_fraud) for r in rows)


def test_source_options():
    assert kafka.source_options("b:9092", "tx") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "tx", "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5000000",
    }
    assert "maxOffsetsPerTrigger" not in kafka.source_options("b", "t", max_offsets_per_trigger=None)
    assert kafka.source_options("b", "t", min_partitions=40)["minPartitions"] == "40"
    limited = kafka.source_options(
        "b:9092", "tx", starting_offsets="earliest", max_offsets_per_trigger=5, failOnDataLoss="true"
    )
    assert limited["maxOffsetsPerTrigger"] == "5" and limited["startingOffsets"] == "earliest"
    assert limited["failOnDataLoss"] == "true"


def test_sink_options():
    assert kafka.sink_options("b:9092", "tx", acks="all") == {
        "kafka.bootstrap.servers": "b:9092", "topic": "tx", "acks": "all",
    }


def test_payload_has_every_field(spark):
    df = spark.createDataFrame([("Zürich", None)], "location STRING, amount DOUBLE")
    (row,) = kafka.to_json_payload(df).collect()
    assert json.loads(bytes(row.value).decode("utf-8")) == {"location": "Zürich", "amount": None}
    (keyed,) = kafka.to_json_payload(df, key="location").collect()
    assert bytes(keyed.key).decode("utf-8") == "Zürich"
