"""Column names and schemas shared by every module."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import types as T

# Column roles of a transaction, in feature order.
NUMERIC = ("amount", "hour_of_day", "day_of_week", "is_weekend")
CATEGORICAL = ("transaction_type", "device_used", "location", "merchant_category")

# Raw columns that preparation removes.
UNINFORMATIVE = (
    "time_since_last_transaction",
    "spending_deviation_score",
    "geo_anomaly_score",
    "velocity_score",
    "receiver_account",
    "payment_channel",
    "ip_address",
    "device_hash",
    "fraud_type",
    "transaction_id",
)


def _struct(**columns: str) -> T.StructType:
    """Nullable columns by type name; needs no session."""
    struct = T.StructType()
    for name, kind in columns.items():
        struct.add(name, kind)
    return struct


# The JSON record carried by the stream.
PAYLOAD = _struct(
    timestamp="string",
    amount="double",
    transaction_type="string",
    device_used="string",
    location="string",
    merchant_category="string",
    hour_of_day="integer",
    day_of_week="integer",
    is_weekend="integer",
    is_fraud="integer",
)

# Columns of a Kafka record as Spark's connector presents them.
KAFKA_RECORD = _struct(
    key="binary",
    value="binary",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
    timestampType="integer",
)

# Types of the columns a transaction CSV may hold; other columns are read as text.
CSV_TYPES: dict[str, T.DataType] = {
    "timestamp": T.TimestampNTZType(),
    "amount": T.DoubleType(),
    "transaction_type": T.StringType(),
    "device_used": T.StringType(),
    "location": T.StringType(),
    "merchant_category": T.StringType(),
    "is_fraud": T.BooleanType(),
    "hour_of_day": T.IntegerType(),
    "day_of_week": T.IntegerType(),
    "is_weekend": T.IntegerType(),
    "time_since_last_transaction": T.DoubleType(),
    "spending_deviation_score": T.DoubleType(),
    "geo_anomaly_score": T.DoubleType(),
    "velocity_score": T.DoubleType(),
}

# Saved predictions: payload, model output, quality flags, then the partition columns.
SCORED = T.StructType(
    [
        *PAYLOAD.fields,
        T.StructField("prediction", T.DoubleType()),
        T.StructField("probability", VectorUDT()),
        T.StructField("p_fraud", T.DoubleType()),
        T.StructField("decode_ok", T.BooleanType()),
        T.StructField("features_ok", T.BooleanType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.IntegerType()),
    ]
)
