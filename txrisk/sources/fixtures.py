"""Transaction-shaped views of the test tables.

The tables under test hold an event log, not transactions. These projections give each
event a transaction's columns, row by row, so that their size is that of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions import md5_bucket
from txrisk.operators.prep import with_calendar
from txrisk.operators.split import with_split
from txrisk.schema import KAFKA_RECORD, PAYLOAD

# The domains of the fields that the event log lacks.
DEVICES = ("mobile", "atm", "pos", "web")
LOCATIONS = (
    "Tokyo", "Toronto", "London", "Sydney", "Berlin", "Dubai", "New York", "Singapore",
)
MERCHANT_CATEGORIES = (
    "utilities", "online", "other", "entertainment", "travel", "grocery", "retail", "restaurant",
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log."""
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _pick(values: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (position + 1).cast("int"))


def _noisy_label() -> Column:
    rule = (F.col("event_type") == "error") & (F.col("value") > 20) & (F.hour("ts") < 12)
    noise = md5_bucket(F.concat(F.lit("n"), F.col("event_id").cast("string")), 100) == 0
    return rule | noise


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared transactions with a learnable label, a key and a train/test side."""
    base = events(spark, sf_dir).select(
        F.col("event_id").alias("transaction_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("transaction_type"),
        _pick(DEVICES, F.col("event_id") % 4).alias("device_used"),
        _pick(LOCATIONS, F.col("user_id") % 8).alias("location"),
        _pick(MERCHANT_CATEGORIES, md5_bucket(F.col("user_id"), 8)).alias("merchant_category"),
        _noisy_label().alias("is_fraud"),
    )
    return with_split(with_calendar(base), "transaction_id")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions before preparation: extra columns, timestamps as text in three formats."""
    ts, number = F.col("timestamp"), F.col("transaction_id")
    text = (
        F.when(number % 3 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(number % 3 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .otherwise(F.date_format(ts, "MM/dd/yyyy HH:mm:ss.SSSSSS"))
    )
    tag = number.cast("string")
    return transactions(spark, sf_dir).select(
        F.concat(F.lit("T"), tag).alias("transaction_id"),
        text.alias("timestamp"),
        F.concat(F.lit("ACC"), tag).alias("receiver_account"),
        "amount",
        "transaction_type",
        "merchant_category",
        "location",
        "device_used",
        "is_fraud",
        F.when(F.col("is_fraud"), F.lit("rule")).alias("fraud_type"),
        (number % 1000 / 10.0).cast("double").alias("time_since_last_transaction"),
        (number % 7 / 7.0).cast("double").alias("spending_deviation_score"),
        (number % 11 / 11.0).cast("double").alias("geo_anomaly_score"),
        (number % 13).cast("double").alias("velocity_score"),
        F.lit("card").alias("payment_channel"),
        F.concat(F.lit("10.0.0."), (number % 256).cast("string")).alias("ip_address"),
        F.concat(F.lit("D"), tag).alias("device_hash"),
    )


def dirty_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared transactions as text, with cells that do not fit: amounts, labels, hours, days and times of some rows."""
    number = F.col("transaction_id")

    def spoiled(every: int, rest: int, text: str, column: str) -> Column:
        return F.when(number % every == rest, text).otherwise(F.col(column).cast("string")).alias(column)

    return transactions(spark, sf_dir).select(
        "transaction_id",
        F.when(number % 17 == 0, "later").when(number % 17 == 1, "").otherwise(F.col("timestamp").cast("string")).alias("timestamp"),
        spoiled(13, 0, "12,5", "amount"),
        spoiled(11, 3, "maybe", "is_fraud"),
        spoiled(7, 2, "2.5", "hour_of_day"),
        spoiled(5, 1, "9.0", "day_of_week"),
        "location",
    )


def mixed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of text whose types must be found, each spoiled for a narrower one by rare rows; column names say how."""
    number, ts = F.col("transaction_id"), F.col("timestamp")
    rare = number % 101 == 7
    text = number.cast("string")
    day = F.date_format(ts, "yyyy-MM-dd")
    return transactions(spark, sf_dir).select(
        text.alias("whole"),
        F.when(rare, (number + 3_000_000_000).cast("string")).otherwise(text).alias("large"),
        F.when(rare, F.concat(text, F.lit(".25"))).when(number % 3 == 0, F.lit(" ")).otherwise(text).alias("fraction"),
        F.when(rare, "x1").otherwise(text).alias("code"),
        F.when(number % 2 == 0, "True").otherwise("false").alias("flag"),
        F.when(rare, "1").when(number % 2 == 0, "True").otherwise("false").alias("flag_or_number"),
        F.when(number % 5 > 0, day).alias("day"),
        F.when(rare, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(day).alias("moment"),
        F.when(rare, F.date_format(ts, "MM/dd/yyyy HH:mm:ss")).otherwise(day).alias("written_moment"),
        F.when(rare, "1e40").otherwise(text).alias("power"),
        F.lit("").alias("blank"),
    )


def many_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category with about one value for every two rows, some frequent ones, and gaps."""
    number = F.col("transaction_id")
    merchant = (
        F.when(number % 4 == 0, F.col("transaction_type"))
        .when(number % 4 == 1, F.when(number % 8 == 1, "chain").otherwise(F.lit("market")))
        .when(number % 31 != 2, F.concat(F.lit("m"), number.cast("string")))
    )
    return transactions(spark, sf_dir).select("transaction_id", merchant.alias("merchant"))


def timestamp_forms(ts: Column, number: Column) -> Column:
    """An instant as text in one of nine forms, by ``number``."""
    rest = F.date_format(ts, "HH:mm:ss.SSSSSS")
    patterns = ("yyyy/MM/dd", "yyyyMMdd", "MM-dd-yyyy", "MMMM d, yyyy", "d MMM yyyy", "M/d/yyyy", "yyyy-MM-dd")
    text = F.concat(F.date_format(ts, "dd/MM/yyyy"), F.lit(" "), rest)
    # Day first where that cannot be misread, else month first.
    text = F.when(F.dayofmonth(ts) > 12, text).otherwise(F.concat(F.date_format(ts, "MM/dd/yyyy"), F.lit(" "), rest))
    for i, pattern in enumerate(patterns):
        text = F.when(number % 9 == i, F.concat(F.date_format(ts, pattern), F.lit(" "), rest)).otherwise(text)
    return F.when(number % 9 == 7, F.date_format(ts, "MM/dd/yyyy hh:mm:ss a")).otherwise(text)


def _as_kafka(df: DataFrame, value: Column) -> DataFrame:
    columns = {
        "key": F.lit(None),
        "value": value,
        "topic": F.lit("transactions"),
        "partition": F.lit(0),
        "offset": F.col("transaction_id"),
        "timestamp": F.to_timestamp(F.lit("2024-01-01 00:00:00")),
        "timestampType": F.lit(0),
    }
    return df.select([columns[f.name].cast(f.dataType).alias(f.name) for f in KAFKA_RECORD])


def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with the field types of the stream payload, plus the key."""
    frame = transactions(spark, sf_dir).withColumns(
        {
            "timestamp": F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            "is_fraud": F.col("is_fraud").cast("int"),
        }
    )
    return frame.select("transaction_id", *PAYLOAD.names)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in Kafka's columns; the offset is the transaction's key."""
    frame = payload_rows(spark, sf_dir)
    return _as_kafka(frame, F.to_json(F.struct(*PAYLOAD.names)))


def dirty_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`payloads`, but six of every twenty messages are defective."""
    kind = F.col("transaction_id") % 20
    others = [c for c in PAYLOAD.names if c != "hour_of_day"]
    value = (
        F.when(kind == 0, F.concat(F.lit("not json "), F.col("transaction_id").cast("string")))
        .when(kind == 1, F.lit(None))
        .when(kind == 2, F.to_json(F.struct(F.lit("much").alias("amount"), F.col("location"))))
        .when(kind == 3, F.to_json(F.struct(*others, F.lit(2.5).alias("hour_of_day"))))
        .when(kind == 4, F.to_json(F.struct(*PAYLOAD.names, F.lit(1).alias("unknown"))))
        .when(kind == 5, F.to_json(F.struct(*[c for c in PAYLOAD.names if c != "is_fraud"])))
        .otherwise(F.to_json(F.struct(*PAYLOAD.names)))
    )
    return _as_kafka(payload_rows(spark, sf_dir), value)


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic predictions against labels that are null for some rows."""
    number = F.col("event_id")
    flagged = (F.col("event_type") == "error") & (F.col("value") > 20)
    return events(spark, sf_dir).select(
        number.alias("transaction_id"),
        F.floor(number / 500).cast("int").alias("batch_id"),
        F.col("event_type").alias("transaction_type"),
        F.when(number % 97 != 0, _noisy_label().cast("int")).alias("label"),
        flagged.cast("double").alias("prediction"),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second labelled set: documents with a toxicity label."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return documents.select("doc_id", "lang", "source", "n_chars").join(
        labels.select("doc_id", "toxic"), "doc_id"
    )
