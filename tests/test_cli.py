import csv

import pytest

from txrisk import cli
from txrisk.operators import labels
from txrisk.plans import models, registry
from txrisk.schema import KAFKA_RECORD, PAYLOAD
from txrisk.sources import files, fixtures
from txrisk.streaming.decode import decode
from txrisk.streaming.scoring import scored_rows, write_scored


def test_prepare_train_view(spark, tiny, tmp_path, capsys):
    raw, prepared, model, scored = (str(tmp_path / n) for n in ("raw", "prepared", "model", "scored"))
    fixtures.raw_transactions(spark, tiny).write.option("header", True).csv(raw)
    cli.main(["prepare", "--input", raw, "--output", prepared])
    assert files.read_transactions(spark, prepared).count() == 1000

    cli.main(["train", "--input", prepared, "--model", model, "--algo", "lr"])
    shown = capsys.readouterr().out
    assert "lr_weighted" in shown and "recall" in shown and "left out 0" in shown

    rows = scored_rows(registry.load(model), decode(fixtures.payloads(spark, tiny)))
    write_scored(rows, scored, "run", 0)
    cli.main(["view", "--path", scored, "--rows", "5"])
    assert "only showing top 5 rows" in capsys.readouterr().out


def test_stream_from_a_stand_in_source(spark, tiny, tmp_path, monkeypatch, capsys):
    """The stream command, with files in place of Kafka and an end in place of waiting."""
    model, inbox, out = (str(tmp_path / n) for n in ("model", "inbox", "out"))
    df = labels.with_label(fixtures.transactions(spark, tiny))
    registry.save(models.train(df, models.SPECS["lr", False]), model)
    fixtures.payloads(spark, tiny).write.parquet(inbox)
    asked = {}

    def source(session, servers, topic, **settings):
        asked.update(settings, servers=servers, topic=topic)
        return session.readStream.schema(KAFKA_RECORD).parquet(inbox)

    def finish(query):
        query.processAllAvailable()
        query.stop()

    monkeypatch.setattr(cli.kafka, "kafka_source", source)
    monkeypatch.setattr(cli, "run_to_end", finish)
    cli.main(
        ["stream", "--servers", "b:9092", "--topic", "t", "--model", model, "--output", out,
         "--checkpoint", str(tmp_path / "checkpoint"), "--max-offsets", "5", "--show", "3",
         "--min-partitions", "6", "--option", "kafka.security.protocol=SSL"]
    )
    assert asked == {
        "servers": "b:9092", "topic": "t", "starting_offsets": "latest", "max_offsets_per_trigger": 5,
        "min_partitions": 6, "kafka.security.protocol": "SSL",
    }
    assert files.read_predictions(spark, out).count() == 1000
    shown = capsys.readouterr().out
    assert shown.startswith("query ")


def test_a_versioned_model_scores_into_a_table_that_is_packed(spark, tiny, tmp_path, monkeypatch, capsys):
    raw, prepared, model, inbox, out, told = (str(tmp_path / n) for n in ("raw", "prepared", "model", "inbox", "out", "told"))
    fixtures.raw_transactions(spark, tiny).write.option("header", True).csv(raw)
    cli.main(["prepare", "--input", raw, "--output", prepared, "--infer-types"])
    assert files.load_types(spark, prepared)["amount"].simpleString() == "double"
    for _ in range(2):
        cli.main(["train", "--input", prepared, "--model", model, "--algo", "lr", "--versioned", "--strict", "--hash-slots", "8"])
    assert "version 000002" in capsys.readouterr().out
    fixtures.payloads(spark, tiny).write.parquet(inbox)
    monkeypatch.setattr(cli.kafka, "kafka_source", lambda session, *a, **k: session.readStream.schema(KAFKA_RECORD).parquet(inbox))
    monkeypatch.setattr(cli, "run_to_end", lambda query: (query.processAllAvailable(), query.stop()))
    cli.main(
        ["stream", "--servers", "b", "--topic", "t", "--model", model, "--output", out, "--checkpoint", str(tmp_path / "c"),
         "--mode", "saved", "--versioned", "--progress", told, "--show", "2"]
    )
    cli.main(["pack", "--path", out, "--keep-hours", "0"])
    capsys.readouterr()
    cli.main(["view", "--path", out, "--mode", "saved", "--report", "model_version"])
    shown = capsys.readouterr().out
    assert "000002" in shown and "recall" in shown
    cli.main(["view", "--path", out, "--mode", "saved", "--rows", "3"])
    assert "only showing top 3 rows" in capsys.readouterr().out


def test_publish(spark, tiny, tmp_path, monkeypatch):
    """A prepared table goes out, not invented rows."""
    sent, prepared = {}, str(tmp_path / "prepared")
    files.write_prepared(fixtures.transactions(spark, tiny), prepared)
    monkeypatch.setattr(
        cli.kafka, "publish", lambda df, servers, topic: sent.update(df=df, to=(servers, topic))
    )
    cli.main(["publish", "--servers", "b:9092", "--topic", "t", "--input", prepared])
    assert sent["to"] == ("b:9092", "t")
    assert sent["df"].count() == 1000 and sent["df"].columns == PAYLOAD.names


def test_prepared_csv_has_a_header(spark, tiny, tmp_path):
    files.write_prepared(fixtures.transactions(spark, tiny), str(tmp_path / "c"))
    part = next((tmp_path / "c").glob("part-*.csv"))
    with open(part) as lines:
        assert next(csv.reader(lines))[0] == "transaction_id"


@pytest.mark.parametrize("command", ["prepare", "train", "stream", "publish", "view"])
def test_commands_require_their_arguments(command):
    with pytest.raises(SystemExit):
        cli.parser().parse_args([command])


def test_stream_defaults():
    args = cli.parser().parse_args(
        "stream --servers b --topic t --model m --output o --checkpoint c".split()
    )
    assert (args.interval, args.starting_offsets, args.max_offsets) == ("15 seconds", "latest", 5_000_000)
