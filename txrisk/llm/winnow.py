"""Document fingerprints by winnowing, with DataFrame functions only.

The k-grams of a text's words are hashed by a rolling polynomial. Of every window of consecutive k-grams
the least hash is chosen, the rightmost of equals, with its position. Two texts that share ``K + WINDOW - 1``
consecutive words therefore share a fingerprint, and runs shorter than K words never show.

Hashes of k words come from those of halves, and least values of a window likewise, so that a step is
one pass over an array and passes grow with the logarithm of the lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import shuffle_width

K, WINDOW = 3, 4  # dense enough for texts of a few words: six consecutive words always share a fingerprint
_PRIME = (1 << 31) - 1
_BASE = 1_000_003
_POSITION_BITS = 31
_RANGES = 4  # of ids, for each partition of a shuffle


def words_of(text: Column) -> Column:
    spaces = "\t\n\v\f\r"
    return F.array_remove(F.split(F.translate(F.lower(text), spaces, " " * len(spaces)), " "), "")


def _shifted(name: str, by: int) -> tuple[Column, Column]:
    """An array's elements and those ``by`` places on, where both exist."""
    length = F.greatest(F.size(name) - by, F.lit(0))
    return F.slice(name, 1, length), F.slice(name, by + 1, length)


def _parts(n: int) -> list[int]:
    """Lengths whose doubling and adding makes n: its halves, down to 1."""
    steps = [n]
    while steps[-1] > 1:
        steps.append((steps[-1] + 1) // 2)
    return steps[::-1]


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """Add ``out``: the chosen (hash, position) pairs of a text column, packed into longs, in order of position.

    The hash stands in the upper 32 bits, the falling position in the lower 31: the least long is the least hash at its
    rightmost position. Fewer than k words are one k-gram, fewer k-grams than a window one window; null and
    texts without words have no fingerprint.
    """
    codes = F.transform(words_of(F.coalesce(F.col(text), F.lit(""))), lambda w: F.pmod(F.xxhash64(w), F.lit(_PRIME)))
    df = df.withColumn("__g", codes)
    short = F.transform(F.slice(F.array(F.hash("__g").cast("long")), 1, F.when(F.size("__g") > 0, 1).otherwise(0)), lambda h: F.pmod(h, F.lit(_PRIME)))
    df = df.withColumn("__short", F.when(F.size("__g") < k, short))
    have = 1
    for n in _parts(k)[1:]:
        shift, factor = n - have, pow(_BASE, have, _PRIME)
        # Overlapping halves also determine the k-gram, as they do for the least value of a window.
        a, b = _shifted("__g", shift)
        df = df.withColumn("__g", F.zip_with(a, b, lambda x, y: (x * factor + y) % _PRIME))
        have = n
    top = (1 << _POSITION_BITS) - 1
    packed = F.transform(
        F.coalesce("__short", "__g"),
        lambda h, i: F.shiftleft(F.xxhash64(h).bitwiseAND(F.lit((1 << 32) - 1)), _POSITION_BITS).bitwiseOR(F.lit(top) - i),
    )
    df = df.withColumn("__m", packed)
    df = df.withColumn("__few", F.when(F.size("__m") < window, F.slice(F.array(F.array_min("__m")), 1, F.least(F.size("__m"), F.lit(1)))))
    have = 1
    for n in _parts(window)[1:]:
        a, b = _shifted("__m", n - have)
        df = df.withColumn("__m", F.zip_with(a, b, lambda x, y: F.least(x, y)))
        have = n
    return df.withColumn(out, F.array_distinct(F.coalesce("__few", "__m"))).drop("__g", "__short", "__m", "__few")


def as_text(fingerprint: Column) -> Column:
    """``hash@position`` of each pair, hash in hexadecimal, separated by blanks."""
    top = (1 << _POSITION_BITS) - 1
    return F.array_join(
        F.transform(
            fingerprint,
            lambda v: F.concat(
                F.lower(F.hex(F.shiftright(v, _POSITION_BITS))), F.lit("@"), (F.lit(top) - v.bitwiseAND(F.lit(top))).cast("string")
            ),
        ),
        " ",
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of the hashes; 1 if neither has any."""
    x, y = (F.array_distinct(F.transform(c, lambda v: F.shiftright(v, _POSITION_BITS))) for c in (a, b))
    both = F.size(F.array_intersect(x, y))
    either = F.size(x) + F.size(y) - both
    return F.when(either > 0, both / either).otherwise(F.lit(1.0))


def _ranges(docs: DataFrame, id_column: str, n: int) -> list:
    """Least and greatest ``(id, tie)`` of at most ``n`` ranges of about equally many rows, rising; null ids come first.

    Spark's range partitioner cuts by samples of the keys, so that neither a far id nor many null ids make a wide range. Only
    the keys are shuffled.
    """
    key = F.struct(F.col(id_column).alias("id"), F.col("__tie").alias("tie"))
    dealt = docs.select(id_column, "__tie").repartitionByRange(n, id_column, "__tie").withColumn("__part", F.spark_partition_id())
    found = dealt.groupBy("__part").agg(F.min(key).alias("least"), F.max(key).alias("most")).collect()
    return sorted(found, key=lambda r: r["__part"])


def _range_of(key: Column, least: Column, n: int) -> Column:
    """Which of the ``n`` ascending ranges a key is in, by their least keys: first among every ``step``-th, then between two of these."""
    step = max(1, int(n**0.5))
    coarse = F.filter(least, lambda _, i: i % step == 0)
    begin = (F.greatest(F.size(F.filter(coarse, lambda b: b <= key)), F.lit(1)) - 1) * step
    return F.greatest(begin + F.size(F.filter(F.slice(least, begin + 1, step), lambda b: b <= key)) - 1, F.lit(0))


def with_next(docs: DataFrame, id_column: str, columns: list[str], prepare) -> DataFrame:
    """Add ``next_<column>`` of the next row by falling id; the last row's next is the first. ``prepare`` adds columns to all rows.

    Rows are dealt to ranges of ids, cut at sampled quantiles, and ordered within a
    range; each range also gets a copy of the first row of the range after it. So nothing is ordered
    globally but two keys per range, which the driver receives. Rows of one id are ordered by a hash of their texts, and
    may lie in several ranges; only rows equal in id and text share one. Null ids come last.
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    docs = docs.withColumns({"__tie": F.xxhash64(*columns), "__copy": F.lit(0)})
    ranges = _ranges(docs, id_column, _RANGES * width)
    id_type = docs.schema[id_column].dataType.simpleString()

    def keys(which: str) -> Column:
        ids, ties = (F.array(*(F.lit(r[which][part]) for r in ranges)) for part in ("id", "tie"))
        return F.arrays_zip(ids.cast(f"array<{id_type}>").alias("id"), ties.cast("array<bigint>").alias("tie"))

    key = F.struct(F.col(id_column).alias("id"), F.col("__tie").alias("tie"))
    rows = docs.withColumn("__range", _range_of(key, keys("least"), len(ranges)))
    # The range that comes before in falling order is the next in rising order; the lowest is followed by the highest.
    heads = spark.range(1).select(F.posexplode(keys("most")).alias("__at", "__head"))
    heads = heads.select(F.pmod(F.col("__at") + 1, F.lit(max(len(ranges), 1))).alias("__to"), F.col("__head.id").alias("__id"), F.col("__head.tie").alias("__t"))
    copies = (
        rows.join(F.broadcast(heads), F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__tie") == F.col("__t")))
        .dropDuplicates(["__to"])
        .withColumns({"__range": F.col("__to"), "__copy": F.lit(1)})
        .select(*rows.columns)
    )
    falling = Window.partitionBy("__range").orderBy("__copy", F.col(id_column).desc_nulls_last(), F.col("__tie").desc())
    # What is prepared is made where the rows are ordered, so that only the rows themselves are shuffled.
    ready = prepare(rows.unionByName(copies).repartition(2 * width, "__range"))
    added = [c for c in ready.columns if c not in rows.columns] + columns
    return (
        ready.withColumns({f"next_{c}": F.lead(c).over(falling) for c in added})
        .filter("__copy = 0")
        .drop("__tie", "__copy", "__range")
    )


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    The edited text has its last third (rounded down) replaced by as many first characters of the next document. Null
    texts are empty.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(rows, "doc_id", ["text"], lambda df: with_fingerprint(df, "text", "marks"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")), F.substring("next_text", F.lit(1), cut))
    )
    rows = with_fingerprint(rows, "edited", "edited_marks")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("marks")).alias("fingerprint"),
        as_text(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.col("next_marks")).alias("near_next"),
    )
