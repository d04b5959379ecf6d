"""JSON records as binary message values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def encode_record(*columns: str | Column) -> Column:
    """One UTF-8 JSON object per row. Null fields are written as null, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary")


def decode_record(value: Column, schema: T.StructType) -> Column:
    """Binary JSON to a struct of ``schema`` plus the text that did not fit it, if any.

    Never fails: junk gives nulls, a field of the wrong type gives null for that field,
    unknown fields are ignored.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(value.cast("string"), with_corrupt, options)
