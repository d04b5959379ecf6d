"""Progress of running streams, in the log and as a table."""

from __future__ import annotations

import json
import logging
import threading
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from txrisk.storage import names, write_text

log = logging.getLogger(__name__)


class ProgressLog(StreamingQueryListener):
    """One line when a query starts, after each batch, and when it ends."""

    def onQueryStarted(self, event) -> None:
        log.info("query %s started", event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        log.info("query %s batch %s: %s rows, %.1f rows/s", p.id, p.batchId, p.numInputRows, p.processedRowsPerSecond or 0.0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("query %s ended%s", event.id, f": {event.exception}" if event.exception else "")


PROGRESS = (
    "query_id string, query_run string, batch_id long, started string, n_rows long, rows_per_second double, backlog long, "
    "duration_ms long, durations map<string, long>"
)


def _backlog(sources) -> int | None:
    """What the sources still hold, as far as they tell: offsets behind the latest for Kafka, files for folders."""
    told = []
    for source in sources:
        metrics = source.metrics or {}
        for name in ("maxOffsetsBehindLatest", "numFilesOutstanding"):
            if name in metrics:
                told.append(int(float(metrics[name])))
    return sum(told) if told else None


class ProgressTable(ProgressLog):
    """Keeps what every batch reports: rows, backlog and durations, one small file per batch below ``path``.

    A batch that is repeated replaces its file. Triggers without a batch are not kept.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryProgress(self, event) -> None:
        super().onQueryProgress(event)
        p = event.progress
        durations = {k: int(v) for k, v in dict(p.durationMs).items()}
        if "addBatch" not in durations:
            return
        row = {
            "query_id": str(p.id), "query_run": str(p.runId), "batch_id": p.batchId, "started": p.timestamp, "n_rows": p.numInputRows,
            "rows_per_second": p.processedRowsPerSecond, "backlog": _backlog(p.sources), "duration_ms": durations.get("triggerExecution"), "durations": durations,
        }
        write_text(self.spark, f"{self.path}/batches/{p.id}-{p.batchId}.json", json.dumps(row))

    def onQueryTerminated(self, event) -> None:
        super().onQueryTerminated(event)
        self._ended[str(event.runId)].set()

    def wait(self, query: StreamingQuery, timeout: float = 60.0) -> bool:
        """Wait until all reports of a query that has ended are written; events come in order, its end last."""
        return self._ended[str(query.runId)].wait(timeout)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The kept reports, one row for each query and batch."""
    path = path.rstrip("/")
    if not names(spark, f"{path}/batches/*.json"):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).json(f"{path}/batches")
