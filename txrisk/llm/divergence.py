"""Source divergence audit: how the words of each source differ from those of its language and of its other sources.

Every document becomes an exact sparse vector by Spark's own ``CountVectorizerModel``, over all terms with a least number of documents
(minDF) and as many of them as there are (vocabSize at its largest). Terms carry their language, so that one model is a vectoriser per
language. The estimator's ``fit`` would collect the vocabulary on the driver before anyone knows its size, and
a model is held by every executor. So the kept terms are counted on the executors, and
where they are more than a bound, hashes deal them into several models, none above about that bound.

Vectors are summed by source in whole numbers (Spark's ``Summarizer`` sums by way of means, which rounds, and holds
dense arrays). Pairs of sources are compared on the terms that occur in either: of the kept terms that are in neither, all
differ by the same amount, and where a source does not have a term, only the distinct shares of the other one matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm import buffers
from txrisk.llm.common import staged
from txrisk.storage import materialize, remove, scratch_path

# Separators of terms `[^\x00-\x40\x5B-\x60\x7B-\x7F]+`, applied after folding A-Z.
NOT_LETTER = np.array([b < 0x80 and not 0x61 <= b <= 0x7A for b in range(256)])
MIN_DOCUMENTS = 30
MODEL_TERMS, MODEL_BYTES = 500_000, 32 << 20  # about which a single model's vocabulary ends
SCALE, SMOOTHING = 1_000_000_000, 5
TOP = 50
_SALTS = 16
_VECTOR = "lang string, source string, model int, vector struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of every text, only A-Z lower-cased, each followed by a line feed and the language; no term holds a line feed."""
    for batch in batches:
        for row, data, offsets in buffers.slices(batch.column("text")):
            texts = len(offsets) - 1
            data = buffers.FOLD[data]
            starts, ends, rows = buffers.word_bounds(data, offsets, NOT_LETTER)
            at = np.zeros(len(starts) + 1, np.int64)
            np.cumsum(ends - starts, out=at[1:])
            letters = np.ascontiguousarray(data[~NOT_LETTER[data]])
            terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(letters))
            lang, source = (batch.column(c).slice(row, texts) for c in ("lang", "source"))
            keyed = pc.binary_join_element_wise(terms, pc.cast(lang, pa.large_string()).take(pa.array(rows)), pa.scalar("\n", pa.large_string())).cast(pa.string())
            lists = pa.ListArray.from_arrays(pa.array(buffers.row_bounds(rows, texts), pa.int32()), keyed)
            yield pa.RecordBatch.from_arrays([lang, source, lists], ["lang", "source", "terms"])


def _named(docs: DataFrame) -> DataFrame:
    """``lang, source, text`` without nulls."""
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def document_vectors(docs: DataFrame, vocabulary_at: str, vectors_at: str, *, min_documents: int = MIN_DOCUMENTS, model_terms: int = MODEL_TERMS, model_bytes: int = MODEL_BYTES) -> tuple[DataFrame, DataFrame]:
    """Write and return the vocabulary (``model, index, lang, term``) and a sparse vector of every document and model.

    Kept are the terms that ``min_documents`` documents of the language have, or more. Null lang, source and text count
    as empty. Without a kept term both tables are empty.
    """
    spark = docs.sparkSession
    tokens_at, kept_at = scratch_path(spark, "terms"), scratch_path(spark, "kept")
    tokens = materialize(_named(docs).mapInArrow(_terms, "lang string, source string, terms array<string>"), tokens_at)
    spread = tokens.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    kept = materialize(spread.filter(F.col("n") >= min_documents).select("term"), kept_at)
    terms, size = kept.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    models = max(-(-terms // model_terms), -(-size // model_bytes))
    words = spark.createDataFrame([], "model int, index int, lang string, term string")
    words.write.parquet(vocabulary_at)
    spark.createDataFrame([], _VECTOR).write.parquet(vectors_at)
    for model in range(models):
        mine = kept.filter(F.pmod(F.xxhash64("term"), F.lit(models)) == model).toArrow().column("term")
        vocabulary = sorted(mine.to_pylist())  # about model_terms and model_bytes
        if not vocabulary:
            continue
        counter = CountVectorizerModel.from_vocabulary(vocabulary, "terms", "vector")
        counter.transform(tokens).select("lang", "source", F.lit(model).alias("model"), "vector").write.mode("append").parquet(vectors_at)
        held = spark.createDataFrame(pa.table({"key": pa.array(vocabulary, pa.string()), "index": pa.array(range(len(vocabulary)), pa.int32())}))
        named = held.selectExpr(f"{model} AS model", "index", "substring(key, instr(key, '\n') + 1) AS lang", "left(key, instr(key, '\n') - 1) AS term")
        named.write.mode("append").parquet(vocabulary_at)
    remove(spark, tokens_at)
    remove(spark, kept_at)
    # Read as the plain struct that a vector is stored as.
    return spark.read.schema(words.schema).parquet(vocabulary_at), spark.read.schema(_VECTOR).parquet(vectors_at)


def group_sums(vocabulary: DataFrame, vectors: DataFrame) -> DataFrame:
    """``lang, source, term, n`` of every term that occurs in a group: the sum of its documents' vectors."""
    entries = vectors.select("source", "model", F.inline(F.arrays_zip("vector.indices", "vector.values"))).toDF("source", "model", "index", "value")
    sums = entries.groupBy("source", "model", "index").agg(F.sum(F.col("value").cast("long")).alias("n"))
    return sums.join(vocabulary, ["model", "index"]).select("lang", "source", "term", "n")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (count + SMOOTHING) / (total + SMOOTHING terms)), exactly."""
    upper = (count + SMOOTHING).cast("decimal(27,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", upper, (total + SMOOTHING * terms).cast("decimal(20,0)")).cast("long") + 1


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value`` of every two sources of a language, a before b: the sum of |p - q| over its kept terms."""
    apart = lambda x, y: F.abs(F.col(x) - F.col(y))
    named = lambda df, s: df.select(*(F.col(c) if c in ("lang", "term", "salt") else F.col(c).alias(f"{c}_{s}") for c in df.columns))
    # Of terms in neither: all differ by what the shares of no occurrence do.
    sizes = groups.select("lang", "source", "terms", "present", "absent")
    both = named(sizes, "a").join(named(sizes, "b"), "lang").filter("source_a < source_b")
    rest = both.select("lang", F.col("source_a").alias("a"), F.col("source_b").alias("b"), F.coalesce((F.col("terms_a") - F.col("present_a") - F.col("present_b")) * apart("absent_a", "absent_b"), F.lit(0)).alias("value"))
    # As if no term were in both: each of a source's terms against the other's share of no occurrence.
    counted = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("k")).withColumn("salt", F.pmod(F.xxhash64("source", "p"), F.lit(_SALTS)).cast("int"))
    others = groups.select("lang", "source", "absent", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    alone = named(counted, "a").join(named(others, "b"), ["lang", "salt"]).filter("source_a != source_b")
    alone = alone.select("lang", F.least("source_a", "source_b").alias("a"), F.greatest("source_a", "source_b").alias("b"), (F.col("k_a") * apart("p_a", "absent_b")).alias("value"))
    # What that gets wrong where a term is in both.
    shared = named(shares.select("lang", "term", "source", "p", "absent"), "a").join(named(shares.select("lang", "term", "source", "p", "absent"), "b"), ["lang", "term"]).filter("source_a < source_b")
    shared = shared.select(
        "lang", F.col("source_a").alias("a"), F.col("source_b").alias("b"),
        (apart("p_a", "p_b") - apart("p_a", "absent_b") - apart("p_b", "absent_a") + apart("absent_a", "absent_b")).alias("value"),
    )
    return rest.unionByName(alone).unionByName(shared).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence_report(docs: DataFrame, *, min_documents: int = MIN_DOCUMENTS, top: int = TOP, **bounds: int) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every (lang, source); all shares are whole billionths.

    Part ``pair`` has every other source of the language as item, and as value the sum over the language's kept terms of
    how far the two sources' shares are apart (0 without kept terms). Part ``term`` has the ``top`` terms whose share
    exceeds the language's most, and by how much. Ranks go by falling value, then by the item's bytes.

    Null lang, source and text count as empty; repeated rows count as often as they are there. Groups without terms
    take part in pairs. ``bounds`` go to :func:`document_vectors`.
    """
    spark = docs.sparkSession
    paths = [scratch_path(spark, name) for name in ("vocabulary", "vectors")]
    vocabulary, vectors = document_vectors(docs, *paths, min_documents=min_documents, **bounds)
    sums = staged(group_sums(vocabulary, vectors), "sums")
    kept = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"))
    found = sums.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    groups = _named(docs).select("lang", "source").distinct().join(kept, "lang", "left").join(found, ["lang", "source"], "left").na.fill(0, ["terms", "total", "present"])
    groups = staged(groups.withColumn("absent", F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms")))), "groups")
    for path in paths:
        remove(spark, path)
    shares = sums.join(groups, ["lang", "source"]).select("lang", "source", "term", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "absent")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.first("terms").alias("terms"))
    whole = sums.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(langs, "lang").select("lang", "term", _share(F.col("n"), F.col("total"), F.col("terms")).alias("q"))
    pairs = staged(_pairs(shares, groups), "pairs")
    one_way = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
    pairs = one_way.unionByName(pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    terms = shares.join(whole, ["lang", "term"]).filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    parts = [
        df.withColumn("rank", rank).filter(keep).select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")
        for df, part, keep in ((pairs, "pair", F.lit(True)), (terms, "term", F.col("rank") <= top))
    ]
    return parts[0].unionByName(parts[1])


ORACLE_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counted AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(words) AS term FROM d)
  SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
dense AS (
  SELECT lang, g.source, k.term, coalesce(c.n, 0) AS n FROM groups g JOIN kept k USING (lang)
  LEFT JOIN counted c USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n,
    1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (sum(n) OVER (PARTITION BY lang, term) + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
  FROM dense JOIN v USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 50
"""
