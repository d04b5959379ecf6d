"""Reading, staging and labels, shared by the operators."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.storage import materialize, scratch_path

WORD = r"[^\x20\x09-\x0D]+"


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, through Spark's own file distribution.

    Once for each Spark application, so that a driver started from any folder works.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for folder, _, names in os.walk(os.path.join(_ROOT, "txrisk")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, _ROOT))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), "txrisk_workers.zip")
    with open(path, "wb") as out:
        out.write(held.getvalue())
    context.addPyFile(path)  # Spark reads the file again later, so it stays
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: an executor lost later costs a re-read."""
    return materialize(df, scratch_path(df.sparkSession, name))


def set_aside(docs: DataFrame, *taken: str) -> tuple[DataFrame, list[Column]]:
    """The rows with their own columns of the ``taken`` names out of the way, and the columns that give the rows back as they were."""
    own = {c: f"__own_{c}" for c in taken if c in docs.columns}
    return docs.withColumnsRenamed(own), [F.col(own.get(c, c)).alias(c) for c in docs.columns]


def id_bucket(key: Column, buckets: int) -> Column:
    """crc32 of the key as text, modulo ``buckets``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % buckets


def shuffle_width(spark: SparkSession) -> int:
    """Partitions of a shuffle, the cluster's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int) -> DataFrame:
    """``doc_id, text, n_chars, y`` of at most ``rows`` labelled documents, chosen by a hash of the id.

    The chosen ids are bounded by ``rows``, so that they are broadcast and no text is shuffled.
    A document that is labelled twice counts once per label; null labels are left out.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("__id").isNotNull())
        .filter(usable)
        .orderBy(F.xxhash64("__id"), "__id", "y")
        .limit(rows)
    )
    return docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).drop("__id")
