"""Saved predictions that stay readable after months of batches, with their measures.

Rows live in folders that only commits make visible::

    data/folder=<folder>/run_id=.../day=.../part-*    rows of one attempt at a batch, or of a pack of many batches
    commits/<folder>.json                             one small file that makes a folder count
    members/<pack>/part-*                             batches of a pack, with the folders they came from and their measures

A batch is written to a folder of its own, then committed by creating one file. Repeating a batch writes another attempt,
whose commit outranks the earlier one. ``pack`` copies the rows of all committed batches into few files per day and
commits the copy; an attempt that the pack did not read outranks the pack's rows of that batch, so it does not matter whether
a batch is repeated before, during or after packing. ``vacuum`` deletes what no commit needs any more.

The measures of a batch are taken while it is written and stand in its commit, so that a report over all batches reads
commits and members only. One pack may run at a time; batches may be committed meanwhile.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.operators import evaluate
from txrisk.schema import SCORED
from txrisk.storage import names, remove, write_text

CELLS = ("tp", "tn", "fp", "fn")
MEASURES = ("n_rows", "n_correct", *CELLS)
_BATCH = "run_id string, batch_id int, folder string, attempt long, model_version string, " + ", ".join(f"{m} long" for m in MEASURES)
_COMMIT = f"kind string, {_BATCH}, replaces array<string>, at long"
_FIELDS = [field.split()[0] for field in _BATCH.split(", ")]
_OUTPUT = [f for f in SCORED if f.name not in ("run_id", "batch_id")]
ROWS_PER_FILE = 1_000_000


def day_of(timestamp: str = "timestamp") -> Column:
    """The date that a row's timestamp text starts with; null where there is none."""
    return F.col(timestamp).try_cast("date")


def measures_of(df: DataFrame, label: str = "is_fraud", prediction: str = "prediction") -> list[Column]:
    """Aggregates of a batch; without a label column all but ``n_rows`` are null."""
    correct, rows = evaluate.correct_counts(df, label, prediction)
    if label not in df.columns:
        return [rows, correct, *(F.max(F.lit(None).cast("long")).alias(c) for c in CELLS)]
    actual, predicted = F.col(label).cast("int"), F.col(prediction).cast("int")
    values = {"tp": (1, 1), "tn": (0, 0), "fp": (0, 1), "fn": (1, 0)}
    return [rows, correct, *(F.count_if((actual == a) & (predicted == p)).alias(c) for c, (a, p) in values.items())]


@dataclass(frozen=True)
class SavedPredictions:
    """A table of scored batches below ``path``."""

    spark: SparkSession
    path: str

    def _at(self, *parts: str) -> str:
        return "/".join([self.path.rstrip("/"), *parts])

    def commit_batch(
        self, df: DataFrame, run_id: str, batch_id: int, *, label: str = "is_fraud", day: Column | None = None, model_version: str | None = None
    ) -> dict:
        """Write a batch, then make it count; returns its measures. Writing a batch again replaces it.

        ``day`` is the column that readers prune by, the date of ``timestamp`` unless given.
        """
        # Numbered by the clock, so that an attempt outranks what was packed and vacuumed before it.
        earlier = names(self.spark, self._at("commits", f"batch-{run_id}-{batch_id}-*.json"))
        attempt = max([time.time_ns() // 1_000_000, *(1 + int(name.rsplit("-", 2)[1]) for name, _ in earlier)])
        folder = f"batch-{run_id}-{batch_id}-{attempt}-{uuid.uuid4().hex[:12]}"
        observed = Observation(folder)
        named = df.withColumns(
            {
                "batch_id": F.lit(int(batch_id)),
                "model_version": F.lit(model_version).cast("string"),
                "run_id": F.lit(run_id),
                "day": day_of() if day is None else day,
            }
        )
        # The measures are taken from the rows that are written, in the same pass.
        named.observe(observed, *measures_of(df, label)).write.partitionBy("run_id", "day").parquet(self._at("data", f"folder={folder}"))
        measures = dict(observed.get)
        batch = {"run_id": run_id, "batch_id": int(batch_id), "folder": folder, "attempt": attempt, "model_version": model_version, **measures}
        self._commit(folder, kind="batch", **batch)
        return measures

    def _commit(self, name: str, **record) -> None:
        write_text(self.spark, self._at("commits", f"{name}.json"), json.dumps({**record, "at": time.time_ns() // 1_000_000}))

    def _commits(self) -> DataFrame:
        if not names(self.spark, self._at("commits", "*.json")):
            return self.spark.createDataFrame([], _COMMIT)
        return self.spark.read.schema(_COMMIT).json(self._at("commits", "*.json"))

    def _packs(self) -> list[str]:
        """Names of the packs that count: as many as there are packs, each a copy of very many batches."""
        commits = {r.folder: r.replaces or [] for r in self._commits().filter("kind = 'pack'").select("folder", "replaces").collect()}
        gone = {name for replaced in commits.values() for name in replaced}
        return sorted(set(commits) - gone)

    def _members(self, packs: list[str]) -> DataFrame:
        schema = T.StructType.fromDDL(f"{_BATCH}, pack string, source string")
        if not packs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(self._at("members", pack) for pack in packs))

    def _resolved(self) -> tuple[DataFrame, list[str]]:
        """A row for every committed batch, with the ``pack`` that serves it (null: its own folder) and whether a later attempt
        outranks it; and the packs that count."""
        packs = self._packs()
        members = self._members(packs)
        loose = self._commits().filter("kind = 'batch'")
        # An attempt that a pack has read is served by the pack.
        loose = loose.join(members.select("folder"), "folder", "left_anti").select(*_FIELDS, F.lit(None).cast("string").alias("pack"))
        latest = Window.partitionBy("run_id", "batch_id").orderBy(F.desc("attempt"), F.desc("folder"))
        ranked = loose.unionByName(members.drop("source")).withColumn("outranked", F.row_number().over(latest) > 1)
        return ranked, packs

    def batches(self) -> DataFrame:
        """``run_id, batch_id, model_version`` and the measures of every batch, from commits and members alone."""
        return self._resolved()[0].filter("not outranked").select("run_id", "batch_id", "model_version", *MEASURES)

    def report(self, *by: str) -> DataFrame:
        """Confusion cells, metrics and accuracy of all batches, or by ``run_id``, ``batch_id`` or ``model_version``; reads no rows."""
        totals = self.batches().groupBy(*by).agg(*(F.sum(m).alias(m) for m in MEASURES))
        cells = totals.withColumn("total", F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))
        correct = F.col("n_correct")
        return evaluate.metrics(cells).withColumn("batch_accuracy", F.when(correct.isNotNull(), evaluate.ratio(correct, F.col("n_rows"))))

    def _rows(self, folders: list[str], keep: str | None) -> DataFrame:
        """Rows of folders; with the columns of :meth:`read`, or all that the files have where ``keep`` is null."""
        paths = [self._at("data", f"folder={folder}") for folder in folders]
        reader = self.spark.read.option("basePath", self._at("data"))
        last = T.StructType.fromDDL("batch_id int, model_version string, folder string, run_id string, day date")
        if keep is None:
            found = reader.option("mergeSchema", "true").parquet(*paths).schema
            first = [f for f in found if f.name not in last.names]
        else:
            first = [*(T.StructType.fromDDL(keep).fields if keep else []), *_OUTPUT]
        schema = T.StructType([*first, *last.fields])
        return reader.schema(schema).parquet(*paths) if folders else self.spark.createDataFrame([], schema)

    def read(self, keep: str = "") -> DataFrame:
        """All rows that count, with ``batch_id, model_version, run_id, day`` last; filters on run and day prune folders.

        ``keep`` names the columns that were kept beside the usual ones, with types: ``"offset long"``.
        """
        resolved, packs = self._resolved()
        folders = sorted(r.folder for r in resolved.filter("pack is null and not outranked").select("folder").collect())
        rows = self._rows(packs + folders, keep)
        outranked = resolved.filter("pack is not null and outranked").select(F.col("pack").alias("folder"), "run_id", "batch_id")
        if not outranked.isEmpty():  # until the next pack leaves them out
            rows = rows.join(outranked, ["folder", "run_id", "batch_id"], "left_anti").select(*rows.columns)
        return rows.drop("folder")

    def pack(self, rows_per_file: int = ROWS_PER_FILE) -> str | None:
        """Copy all batches outside packs, and packs with outranked batches, into files of about ``rows_per_file`` rows.

        All columns are kept, those that only some batches have included. Rows are ordered by run, day and a hash of themselves and cut into equal files, so a day with very many rows is several
        files. Returns the new pack, null if there is nothing to do.
        """
        resolved, _ = self._resolved()
        outranked = sorted(r.pack for r in resolved.filter("pack is not null and outranked").select("pack").distinct().collect())
        taken = resolved.filter("not outranked").filter(F.col("pack").isNull() | F.col("pack").isin(*outranked)).drop("outranked")
        name = f"pack-{uuid.uuid4().hex}"
        # What is packed is fixed by writing the members; rows are read by them.
        taken.withColumns({"source": F.col("pack"), "pack": F.lit(name)}).write.parquet(self._at("members", name))
        members = self._members([name])
        folders = sorted(r.folder for r in members.filter("source is null").select("folder").collect())
        if not folders and not outranked:
            remove(self.spark, self._at("members", name))
            return None
        n_rows = members.agg(F.sum("n_rows")).first()[0] or 0
        rows = self._rows(folders + outranked, None) if n_rows else self._rows([], "")
        if outranked:
            wanted = members.select(F.coalesce("source", "folder").alias("folder"), "run_id", "batch_id")
            rows = rows.join(wanted, ["folder", "run_id", "batch_id"], "left_semi").select(*rows.columns)
        rows = rows.drop("folder")
        content = F.xxhash64(*(c for c in rows.columns if c != "probability"))
        dealt = rows.repartitionByRange(1 + n_rows // rows_per_file, "run_id", "day", content)
        dealt.write.partitionBy("run_id", "day").parquet(self._at("data", f"folder={name}"))
        self._commit(name, kind="pack", folder=name, replaces=outranked)
        return name

    def vacuum(self, older_than_hours: float = 24.0) -> int:
        """Delete what no commit needs any more and has been there for that long; returns how many folders went.

        The time must exceed that of the longest reader, pack and batch.
        """
        until = time.time_ns() // 1_000_000 - int(older_than_hours * 3_600_000)
        resolved, packs = self._resolved()
        needed = {*packs, *(r.folder for r in resolved.filter("pack is null and not outranked").select("folder").collect())}
        # Commits go first: a folder without one is not read.
        for name, changed in names(self.spark, self._at("commits", "*.json")):
            if changed <= until and name.removesuffix(".json") not in needed:
                remove(self.spark, self._at("commits", name))
        gone = [
            (part, name)
            for part in ("data", "members")
            for name, changed in names(self.spark, self._at(part, "*"))
            if changed <= until and name.removeprefix("folder=") not in needed
        ]
        for part, name in gone:
            remove(self.spark, self._at(part, name))
        return len(gone)
