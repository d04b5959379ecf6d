"""Headline timings as one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txrisk.operators import evaluate, labels, prep
from txrisk.plans import models, training
from txrisk.plans.catalog import QUERIES
from txrisk.schema import KAFKA_RECORD
from txrisk.sources import fixtures
from txrisk.storage import materialize, scratch_path
from txrisk.streaming.decode import decode
from txrisk.streaming.scoring import run_to_end, score_stream

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
TRAIN_SIDE = "split = 'train'"
PLAIN_QUERIES = (
    "prep_calendar",
    "prep_mixed_timestamps",
    "csv_roundtrip",
    "class_weights",
    "hash_split",
    "index_labels",
    "feature_slots",
    "classification_metrics",
    "batch_accuracy",
    "json_decode_dirty",
    "stream_decode",
)


def run_fully(df: DataFrame) -> None:
    """Compute every row and column, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def seconds(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def jobs_of(spark: SparkSession, action: Callable[[], object]) -> int:
    """Number of Spark jobs that an action starts."""
    spark.sparkContext.setJobGroup("counted", "counted")
    action()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("counted")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(jobs)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed: dict[str, float] = {}
    rates: dict[str, float] = {}

    run_fully(QUERIES["class_weights"](spark, SF_DIR))  # start-up is not measured
    for name in PLAIN_QUERIES:
        timed[name] = seconds(lambda: run_fully(QUERIES[name](spark, SF_DIR)))

    # The input of the remaining steps is written once, so that they are measured alone.
    raw = materialize(fixtures.raw_transactions(spark, SF_DIR), scratch_path(spark, "bench-raw"))
    rows = materialize(labels.with_label(fixtures.transactions(spark, SF_DIR)), scratch_path(spark, "bench-rows"))
    n_rows = rows.count()

    timed["prepare"] = seconds(lambda: run_fully(prep.prepare(raw)))
    rates["prepare_rows_per_sec"] = round(n_rows / timed["prepare"])

    fitted = {}
    for spec in models.SPECS.values():

        def train() -> None:
            fitted[spec.name] = training.train_and_evaluate(rows, spec, is_train=TRAIN_SIDE)
            fitted[spec.name].report.collect()

        timed[f"train_eval_{spec.name}"] = seconds(train)

    # The fit alone, next to the same pipeline given to Spark as it is; each goes first once.
    weighted = labels.with_weight(rows, labels.fit_class_weights(rows)).filter(TRAIN_SIDE)
    fits = {}
    for (_, is_weighted), spec in models.SPECS.items():
        if is_weighted:
            ways = {
                "plain_pipeline": lambda: models.build(spec).fit(weighted),
                "train": lambda: models.train(weighted, spec),
            }
            runs = {way: [] for way in ways}
            for order in (list(ways), list(ways)[::-1]):
                for way in order:
                    runs[way].append(seconds(ways[way]))
            fits[spec.name] = {way: round(sum(found) / len(found), 3) for way, found in runs.items()}

    model = fitted["gbt_weighted"].model
    timed["score"] = seconds(lambda: run_fully(models.score(model, rows)))
    rates["score_rows_per_sec"] = round(n_rows / timed["score"])

    scored = materialize(
        models.score(model, rows).select("label", "prediction"), scratch_path(spark, "bench-scored")
    )
    report = evaluate.report(scored, "gbt_weighted")
    timed["evaluate"] = seconds(report.collect)
    evaluation_jobs = jobs_of(spark, report.collect)

    inbox = scratch_path(spark, "bench-inbox")
    messages = fixtures.payloads(spark, SF_DIR)
    messages.write.option("maxRecordsPerFile", n_rows // 8 + 1).parquet(inbox)
    stream = spark.readStream.schema(KAFKA_RECORD).option("maxFilesPerTrigger", 2).parquet(inbox)
    batches: list[int] = []

    def score_all() -> None:
        query = score_stream(
            decode(stream),
            model,
            scratch_path(spark, "bench-out"),
            scratch_path(spark, "bench-checkpoint"),
            trigger={"availableNow": True},
            on_batch=lambda batch_id, found: batches.append(found["n_rows"]),
        )
        run_to_end(query)

    timed["stream_score"] = seconds(score_all)
    assert sum(batches) == n_rows, (batches, n_rows)
    rates["stream_rows_per_sec"] = round(n_rows / timed["stream_score"])

    result = {
        "metric": "total wall-clock of the headline queries",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "rates": rates,
        "fits": fits,
        "evaluation_jobs": evaluation_jobs,
        "rows": n_rows,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
