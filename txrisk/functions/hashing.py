"""Row-wise hashes: same row, same answer, whatever the partitioning or a task retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_bucket(text: Column, buckets: int) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of the md5 of ``text``.

    md5 because every SQL engine has it, so a split can be repeated outside Spark.
    A null key counts as the empty string, so its row still gets a bucket.
    """
    digest = F.md5(F.coalesce(text.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")
