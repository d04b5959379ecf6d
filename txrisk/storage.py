"""Where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one, since executors cannot see each other's disks. Only a local
    session without the setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="txrisk-")
    return f"{base.rstrip('/')}/txrisk/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, path: str, *partition_by: str) -> DataFrame:
    """Write a frame as Parquet to a shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of its files, never a recomputation.
    The files also fix the partition layout, so later fits on them see the same order. The
    table is the caller's to remove.
    """
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    """A Hadoop path and the file system that it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace a small file in one step: readers see the old text or the new one, never a part."""
    target, fs = _path(spark, path)
    draft, _ = _path(spark, f"{path.rpartition('/')[0]}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, null if there is none."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return None
    source = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode("utf-8")
    finally:
        source.close()


def names(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Name and time of last change (milliseconds) of what matches a pattern, by name."""
    target, fs = _path(spark, pattern)
    found = fs.globStatus(target) or []
    return sorted((entry.getPath().getName(), entry.getModificationTime()) for entry in found if not entry.getPath().getName().startswith("."))
