"""Kafka source and sink. The connector jar is the caller's to provide."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk.functions import encode_record
from txrisk.schema import PAYLOAD


DEFAULT_MAX_OFFSETS = 5_000_000  # records of a trigger


def source_options(
    servers: str,
    topic: str,
    *,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = DEFAULT_MAX_OFFSETS,
    min_partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Reader options.

    A trigger takes at most ``max_offsets_per_trigger`` records, so that a first batch from
    ``earliest`` is bounded; ``None`` takes all that has arrived. ``min_partitions`` splits topic partitions between
    tasks, without which one partition is one task however large. ``extra`` holds any other option of the connector.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return {**options, **extra}


def kafka_source(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """Stream of Kafka records; ``settings`` as in :func:`source_options`.

    ``starting_offsets`` matters at the first start only; later the checkpoint decides.
    """
    return spark.readStream.format("kafka").options(**source_options(servers, topic, **settings)).load()


def payload_columns(df: DataFrame) -> DataFrame:
    """Prepared transactions in the fields and types of the message record; absent fields are null."""
    fields = []
    for f in PAYLOAD.fields:
        column = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name == "timestamp" and f.name in df.columns and dict(df.dtypes)[f.name] != "string":
            column = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        fields.append(column.cast(f.dataType).alias(f.name))
    return df.select(*fields)


def to_json_payload(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as message values (UTF-8 JSON), without key unless one is named.

    Leave the key out unless order per key matters: a key pins all its messages to one
    topic partition, and a frequent key would fill that partition alone.
    """
    value = encode_record(*df.columns).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").cast("binary").alias("key"), value)


def sink_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    """Writer options."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, **extra}


def publish(df: DataFrame, servers: str, topic: str, key: str | None = None, **extra: str) -> None:
    """Send every row of a batch frame as one message."""
    options = sink_options(servers, topic, **extra)
    to_json_payload(df, key).write.format("kafka").options(**options).save()


def publish_stream(
    df: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None, **extra: str
) -> StreamingQuery:
    """Send every row of a streaming frame as one message."""
    options = sink_options(servers, topic, checkpointLocation=checkpoint, **extra)
    return to_json_payload(df, key).writeStream.format("kafka").options(**options).start()
