"""Command line: ``spark-submit main.py <command>``."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from txrisk.operators import evaluate, labels, prep, split
from txrisk.plans import models, registry, training
from txrisk.sources import files, kafka
from txrisk.operators.features import FeatureSpec
from txrisk.storage import remove, scratch_path
from txrisk.streaming.decode import decode
from txrisk.schema import CATEGORICAL, NUMERIC
from txrisk.streaming.progress import ProgressLog, ProgressTable
from txrisk.streaming.saved import ROWS_PER_FILE, SavedPredictions
from txrisk.streaming.scoring import run_to_end, score_stream


def prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = files.read_raw(spark, args.input, multiLine=str(args.multi_line).lower())
    ready = prep.prepare(raw, strict=not args.lenient, extra_formats=args.timestamp_format)
    files.write_prepared(ready, args.output, line_breaks="keep" if args.multi_line else "refuse")
    if args.infer_types:
        files.save_types(spark, args.output, files.infer_types(spark, args.output))


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    quality = files.CellQuality() if args.strict else None
    table = files.read_transactions(
        spark, args.input, types=files.load_types(spark, args.input), quality=quality, multiLine=str(args.multi_line).lower()
    )
    df = labels.with_label(table.withColumns({c: table[c].try_cast("double") for c in args.numeric}), args.label)
    keys = args.split_key or df.columns
    stage_at = args.stage_at or scratch_path(spark, "training")
    try:
        run = training.train_and_evaluate(
            split.with_split(df, *keys),
            models.SPECS[args.algo, not args.unweighted],
            FeatureSpec(tuple(args.numeric), tuple(args.categorical)),
            is_train="split = 'train'",
            weights_from=args.weights_from,
            max_categories=args.max_categories,
            hash_slots=args.hash_slots,
            partitions=args.partitions,
            stage_at=stage_at,
            after_staging=quality.check if quality else None,
        )
        if args.versioned:
            print(f"version {registry.publish(run.model, args.model, df.schema, FeatureSpec(tuple(args.numeric), tuple(args.categorical)))}")
        else:
            registry.save(run.model, args.model)
        print(evaluate.report_text(run.report.first()))
        if args.report:
            run.report.coalesce(1).write.mode("overwrite").json(args.report)
    finally:
        if not args.stage_at:
            remove(spark, stage_at)
    print(f"training rows {run.n_train}, left out {run.n_dropped}; weights from {args.weights_from} rows")


def _options(args: argparse.Namespace) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in args.option)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = kafka.kafka_source(
        spark,
        args.servers,
        args.topic,
        starting_offsets=args.starting_offsets,
        max_offsets_per_trigger=args.max_offsets or None,
        min_partitions=args.min_partitions,
        **_options(args),
    )
    spark.streams.addListener(ProgressTable(spark, args.progress) if args.progress else ProgressLog())
    query = score_stream(
        decode(messages),
        registry.CurrentModel(args.model) if args.versioned else registry.load(args.model),
        args.output,
        args.checkpoint,
        mode=args.mode,
        trigger={"processingTime": args.interval},
        show_rows=args.show,
    )
    print(f"query {query.id}: {query.status['message']}")
    run_to_end(query)


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    kafka.publish(
        kafka.payload_columns(files.read_transactions(spark, args.input)), args.servers, args.topic, **_options(args)
    )


def view(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.mode == "saved":
        saved = SavedPredictions(spark, args.path)
        (saved.report(*args.report) if args.report else saved.read()).show(args.rows, truncate=False)
    else:
        files.read_predictions(spark, args.path).show(args.rows, truncate=False)


def pack(spark: SparkSession, args: argparse.Namespace) -> None:
    saved = SavedPredictions(spark, args.path)
    print(f"packed into {saved.pack(rows_per_file=args.rows_per_file)}")
    print(f"{saved.vacuum(args.keep_hours)} folders deleted")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="txrisk")
    commands = top.add_subparsers(required=True)

    def command(action, *required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(action.__name__)
        sub.set_defaults(action=action)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        return sub

    sub = command(prepare, "input", "output")
    sub.add_argument("--lenient", action="store_true", help="null for unreadable timestamps")
    sub.add_argument("--infer-types", action="store_true", help="find and keep the types of all columns, for train")
    sub.add_argument("--timestamp-format", action="append", default=[], help="further Spark pattern")
    sub.add_argument("--multi-line", action="store_true", help="values may hold line breaks; a file is then one task")

    sub = command(train, "input", "model")
    sub.add_argument("--algo", choices=sorted(models.PARAMETERS), default="gbt")
    sub.add_argument("--unweighted", action="store_true")
    sub.add_argument("--weights-from", choices=["all", "train"], default="all")
    sub.add_argument("--max-categories", type=int, default=10_000)
    sub.add_argument("--hash-slots", type=int, default=0, help="slots for the rarer values of columns with more categories")
    sub.add_argument("--strict", action="store_true", help="refuse a table with cells that do not fit their type")
    sub.add_argument("--versioned", action="store_true", help="publish the model as the next version and make it current")
    sub.add_argument("--label", default="is_fraud")
    sub.add_argument("--numeric", nargs="*", default=list(NUMERIC))
    sub.add_argument("--categorical", nargs="*", default=list(CATEGORICAL))
    sub.add_argument("--partitions", type=int, help="fixed layout: the same trees on every cluster")
    sub.add_argument("--report", help="folder for the report as JSON")
    sub.add_argument("--multi-line", action="store_true", help="values may hold line breaks; a file is then one task")
    sub.add_argument("--stage-at", help="folder for the parsed table; default below spark.checkpoint.dir, removed afterwards")
    sub.add_argument("--split-key", nargs="*", help="columns that decide a row's side; default all")

    sub = command(stream, "servers", "topic", "model", "output", "checkpoint")
    sub.add_argument("--starting-offsets", default="latest")
    sub.add_argument("--max-offsets", type=int, default=kafka.DEFAULT_MAX_OFFSETS, help="0: no limit")
    sub.add_argument("--min-partitions", type=int, help="split topic partitions between so many tasks")
    sub.add_argument("--option", action="append", default=[], help="Kafka option as name=value, as often as needed")
    sub.add_argument("--interval", default="15 seconds")
    sub.add_argument("--mode", choices=["batch", "saved"], default="batch", help="saved: a table that can be packed")
    sub.add_argument("--versioned", action="store_true", help="score with the current version of a published model")
    sub.add_argument("--progress", help="folder for rows, backlog and durations of every batch")
    sub.add_argument("--show", type=int, default=0, help="rows of each batch to print")

    sub = command(publish, "input", "servers", "topic")
    sub.add_argument("--option", action="append", default=[], help="Kafka option as name=value, as often as needed")

    sub = command(view, "path")
    sub.add_argument("--rows", type=int, default=20)
    sub.add_argument("--mode", choices=["batch", "saved"], default="batch")
    sub.add_argument("--report", nargs="*", help="measures by these columns (run_id, batch_id, model_version) instead of rows")

    sub = command(pack, "path")
    sub.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE)
    sub.add_argument("--keep-hours", type=float, default=24.0, help="age at which files that nothing needs are deleted")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("txrisk").getOrCreate()
    args.action(spark, args)
