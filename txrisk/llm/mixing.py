"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key. The hash is uniform, so cutting its range into equal parts
is a range partitioning that needs no sampling and splits a hot source evenly. Word counts are summed
per source and part, prefix sums over the parts give each part its offset, and a running sum within
the part places every document. A source's budget cuts that order at an exact word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import WORD, staged

PARTS = 1024  # of the hash range, per source
MAX_EPOCHS = 3  # times a document can be taken
_KEY_DIGITS = 13  # hexadecimal digits of the key


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``weight, target`` to a table of ``source, source_size``.

    Weights 1, 2, 3 repeat in code-point order, null last. Targets share the total by weight; one
    that exceeds ``max_epochs`` times its source's size stops there and the rest is shared anew. Ordered by
    size over weight, the sources that stop are a prefix, so prefix sums give the final shares:
    a source stops if its cap is at most its share of what is left once all before it have stopped.
    There is one row per source, which is why a single ordered pass over them is enough.
    """
    ranked = sources.withColumn(
        "weight",
        (
            (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1
        ).cast("double"),
    )
    cap = F.col("source_size") * float(max_epochs)
    before = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranked.withColumns(
            {
                "__total": F.sum("source_size").over(everything).cast("double"),
                "__weights": F.sum("weight").over(everything),
                "__capped": F.coalesce(F.sum(cap).over(earlier), F.lit(0.0)),
                "__weights_before": F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)),
            }
        )
        .withColumn(
            "__level",
            (F.col("__total") - F.col("__capped")) / (F.col("__weights") - F.col("__weights_before")),
        )
        # The level of the first source that does not stop holds for all that follow.
        .withColumn("__final", F.first(F.when(cap > F.col("__level") * F.col("weight"), F.col("__level")), True).over(
            before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select(
            "source",
            "source_size",
            "weight",
            F.least(cap, F.coalesce(F.col("__final") * F.col("weight"), cap)).alias("target"),
        )
    )


def mix(docs: DataFrame, *, seed: str = "mix", parts: int = PARTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """All columns of ``docs`` with ``size, source_size, target, taken`` added (or replaced).

    ``taken`` counts words: each source is passed as often as its target asks for, and the last pass
    ends within one document, at the exact (floored) target. Null texts and texts without words have size 0 and are taken 0
    times; null sources are one source; repeated rows count each. Equal keys are ordered by id, then
    size; rows equal in all of these are alike, so that any order of them gives the same result.
    """
    key = F.conv(
        F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, _KEY_DIGITS),
        16,
        10,
    ).cast("long")
    rows = docs.drop("size", "source_size", "target", "taken").withColumns(
        {"size": n_words(F.col("text")), "__key": key}
    )
    rows = rows.withColumn("__part", F.floor(F.col("__key") / F.lit((1 << 4 * _KEY_DIGITS) // parts)).cast("int"))
    sums = staged(rows.groupBy("source", "__part").agg(F.sum("size").alias("__sum")), "mix-sums")
    targets = source_targets(sums.groupBy("source").agg(F.sum("__sum").alias("source_size")), max_epochs)
    in_order = Window.partitionBy("source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sums.withColumn("__offset", F.coalesce(F.sum("__sum").over(in_order), F.lit(0)))
        .join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
        .select(
            F.col("source").alias("__source"), F.col("__part").alias("__p"), "__offset", "source_size", "target"
        )
    )
    running = (
        Window.partitionBy("source", "__part")
        .orderBy("__key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    left = budget - epochs * F.col("source_size") - F.col("__offset") - F.col("__before")
    return (
        rows.withColumn("__before", F.coalesce(F.sum("size").over(running), F.lit(0)))
        .join(offsets, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__part") == F.col("__p")))
        .withColumn("taken", (epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))).cast("long"))
        .drop("__key", "__part", "__before", "__source", "__p", "__offset")
    )


def mix_report(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w
  FROM d GROUP BY source
), c AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, (SELECT sum(source_size) FROM s)::DOUBLE AS total, (SELECT sum(w) FROM s) AS ws,
         coalesce(sum(3.0::DOUBLE * source_size) OVER b, 0.0) AS cb, coalesce(sum(w) OVER b, 0.0) AS wb
  FROM s WINDOW b AS (ORDER BY source_size / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, (total - cb) / (ws - wb) AS level FROM c
), t AS (
  SELECT source, source_size, least(cap, coalesce(w * (
    SELECT level FROM l WHERE cap > level * w ORDER BY source_size / w, encode(source) NULLS LAST LIMIT 1), cap)) AS target
  FROM l
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         floor(t.target)::BIGINT AS budget,
         CASE WHEN t.source_size > 0 THEN (floor(t.target)::BIGINT // t.source_size) ELSE 0 END AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM r
"""
