"""Scoring a stream into a table that replays cannot duplicate."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk.operators.evaluate import correct_counts
from txrisk.operators.features import TRANSACTION_FEATURES, FeatureSpec
from txrisk.plans import models
from txrisk.plans.registry import CurrentModel
from txrisk.schema import SCORED
from txrisk.sources.files import preview
from txrisk.streaming.saved import SavedPredictions

log = logging.getLogger(__name__)

OUTPUT = tuple(c for c in SCORED.names if c not in ("run_id", "batch_id"))


def scored_rows(
    model: PipelineModel,
    df: DataFrame,
    inputs: FeatureSpec = TRANSACTION_FEATURES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decoded rows with the model's answer, in the column order of the saved table.

    Columns that the input does not have (no label, no decode flag) are left out.
    """
    scored = models.score(model, df, inputs)
    return scored.select(*keep, *[c for c in OUTPUT if c in scored.columns])


def write_scored(df: DataFrame, path: str, run_id: str, batch_id: int) -> None:
    """Save one batch in its own ``run_id/batch_id`` partition.

    Writing the same batch again replaces that partition and touches no other, so a batch
    replayed after a crash leaves no duplicates.
    """
    named = df.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(int(batch_id))})
    (
        named.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id", "batch_id")
        .parquet(path)
    )


def score_stream(
    stream: DataFrame,
    model: PipelineModel | Callable[[], PipelineModel],
    path: str,
    checkpoint: str,
    *,
    mode: str = "batch",
    inputs: FeatureSpec = TRANSACTION_FEATURES,
    label: str = "is_fraud",
    keep: Sequence[str] = (),
    run_id: str | None = None,
    trigger: dict | None = None,
    show_rows: int = 0,
    on_batch: Callable[[int, dict], None] | None = None,
) -> StreamingQuery:
    """Score a decoded stream and start saving the result; returns the running query.

    ``mode="batch"`` writes ``run_id`` / ``batch_id`` partitions and measures each batch
    while it is written: one pass, nothing cached, nothing scored twice. The measures go to
    ``on_batch(batch_id, {"n_rows", "n_correct", "accuracy"})``, for batches with rows. ``show_rows`` prints
    rows of the partition just written. ``mode="saved"`` does the same with a table of
    :class:`txrisk.streaming.saved.SavedPredictions`, for streams that run for months: batches can be packed by day and
    their measures, confusion cells included, stay with the table. ``mode="native"`` leaves
    the files to the streaming Parquet sink, without batch columns or measures.

    ``model`` is a loaded model, or a function that is asked for it in every batch when the
    model may change; a :class:`txrisk.plans.registry.CurrentModel` loads only when its version has changed, and with
    ``mode="saved"`` each row and batch carries that version. ``run_id`` defaults to the query's id, which belongs to the
    checkpoint: a restart goes on under the same id, a new checkpoint gets a new one. Never
    pass the same ``run_id`` with two checkpoints.

    An error in a batch stops the query; the next start repeats that batch from the
    checkpoint. Bad messages are no errors: they come through with ``decode_ok`` false.
    """
    trigger = trigger or {"processingTime": "15 seconds"}
    if mode == "native":
        if callable(model):
            raise ValueError("native mode needs a loaded model")
        writer = scored_rows(model, stream, inputs, keep).writeStream.format("parquet")
        return (
            writer.option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )
    if mode not in ("batch", "saved"):
        raise ValueError("mode is 'batch', 'saved' or 'native'")

    named = threading.Event()
    run = {"id": run_id}

    def handle(batch: DataFrame, batch_id: int) -> None:
        named.wait()
        now = model
        if callable(model):
            now = model(batch.schema) if isinstance(model, CurrentModel) else model()
        scored = scored_rows(now, batch, inputs, keep) if callable(model) else batch
        if mode == "saved":
            version = model.version if isinstance(model, CurrentModel) else None
            measures = SavedPredictions(batch.sparkSession, path).commit_batch(scored, run["id"], batch_id, label=label, model_version=version)
        else:
            observed = Observation(f"batch-{batch_id}")
            write_scored(scored.observe(observed, *correct_counts(scored, label)), path, run["id"], batch_id)
            measures = dict(observed.get)
        n_rows, n_correct = measures["n_rows"], measures["n_correct"]
        if not n_rows:
            log.info("batch %s is empty", batch_id)
            return
        measures["accuracy"] = None if n_correct is None else n_correct / n_rows
        log.info("batch %s: %s", batch_id, measures)
        if show_rows:
            session = scored.sparkSession
            saved = SavedPredictions(session, path).read() if mode == "saved" else session.read.parquet(path)
            written = saved.filter((F.col("run_id") == run["id"]) & (F.col("batch_id") == int(batch_id)))
            preview(written, show_rows).show(show_rows, truncate=False)
        if on_batch:
            on_batch(batch_id, measures)

    # A fixed model is part of the stream's own plan, which saves building it per batch.
    source = stream if callable(model) else scored_rows(model, stream, inputs, keep)
    query = (
        source.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    run["id"] = run_id or query.id
    named.set()
    return query


def run_to_end(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for a query and stop it on the way out, whatever happens. True if it ended."""
    try:
        if timeout is None:
            query.awaitTermination()
            return True
        return bool(query.awaitTermination(timeout))
    finally:
        query.stop()
