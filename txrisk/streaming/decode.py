"""Message values to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.functions import decode_record
from txrisk.functions.payload import CORRUPT
from txrisk.schema import PAYLOAD


def decode(
    df: DataFrame, schema: T.StructType = PAYLOAD, keep: Sequence[str] = ()
) -> DataFrame:
    """Expand the binary JSON in ``value`` to the fields of ``schema`` plus ``decode_ok``.

    Every message gives one row. ``decode_ok`` is false for a missing value, for text that
    is no JSON object and for a field of the wrong type. ``keep`` names message columns,
    such as the offset, to carry along in front.
    """
    decoded = df.select(*keep, decode_record(F.col("value"), schema).alias("data"))
    fine = F.col("data").isNotNull() & F.col(f"data.{CORRUPT}").isNull()
    return decoded.select(*keep, "data.*", fine.alias("decode_ok")).drop(CORRUPT)
