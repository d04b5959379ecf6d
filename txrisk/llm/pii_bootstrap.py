r"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Fixed patterns find the seeds: e-mail addresses, IP addresses, card numbers and telephone numbers.
Seeds induce lexical patterns, the words around them. The graph of patterns and instances is
scored in rounds: a pattern counts by the share of its instances that are known, an unseen instance by the patterns
that it stands in; those above the threshold are known in the next round. Unseen instances
are identifier-shaped words (with a digit or an @) outside the seeds. All steps are grouped sums and joins of
occurrences, which are few beside the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import staged

BASE = ("email", "ip", "card", "phone")
FOUND = "id"
KINDS = (*BASE, FOUND)
ROUNDS = 3
MIN_SEEDS = 3  # distinct known instances that a pattern needs
MIN_SCORE = 0.8

_GAP = r"\x20\x09-\x0D"
_LOCAL = "[A-Za-z0-9._%+-]"
# The plain forms, written so that a long run of their characters is passed once: they begin where a run does (or where
# the match before ended) and never give characters back.
_REGEX = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # On a text whose blanks and hyphens that are not between two digits have been replaced one by one.
    "card": r"[0-9\x20-]{2,}",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    FOUND: rf"(?<![^{_GAP}])[^{_GAP}0-9@]*+[0-9@][^{_GAP}]*+",
}
_LONE_SEPARATOR = r"[\x20-](?![0-9])|(?<![0-9])[\x20-]"
_IP = r"^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])){3}$"
_CONTEXT = 64  # characters of context that are kept on each side
_GLUED = rf"(?:(?![{_GAP}])[^\p{{L}}\p{{N}}])+"


def _luhn(digits: Column) -> Column:
    padded = F.lpad(digits, 19, "0")
    total = F.lit(0)
    for i in range(19):
        d = F.ascii(F.substring(padded, 19 - i, 1)) - 48
        total = total + (d if i % 2 == 0 else d * 2 - F.when(d > 4, 9).otherwise(0))
    return total % 10 == 0


def _valid() -> Column:
    digits = F.regexp_replace("match", "[^0-9]", "")
    count = F.length(digits)
    return (
        F.when(F.col("kind") == "ip", F.col("match").rlike(_IP))
        .when(F.col("kind") == "card", count.between(12, 19) & _luhn(F.when(count <= 19, digits).otherwise("1")))
        .when(F.col("kind") == "phone", count.between(9, 15))
        .otherwise(True)
    )


def _parts(text: Column, kind: str) -> Column:
    """Of each match: kind, characters since the last one, and match. Null for the rest behind the last."""
    if kind == "card":
        text = F.regexp_replace(text, _LONE_SEPARATOR, "\u0001")
    regex = F.lit(_REGEX[kind])
    between, matches = F.split(text, _REGEX[kind], -1), F.regexp_extract_all(text, regex, 0)
    return F.when(
        F.size(matches) > 0,
        F.zip_with(
            F.transform(between, lambda b, i: F.struct(i.alias("i"), F.length(b).alias("gap"))),
            matches,
            lambda b, m: F.struct(F.lit(kind).alias("kind"), b["i"].alias("i"), b["gap"].alias("gap"), m.alias("match")),
        ),
    )


def occurrences(rows: DataFrame) -> DataFrame:
    """``rid, kind, start, stop, match`` of every raw match in ``rid, text``; characters count from 0, stop is exclusive."""
    text = F.col("text")
    parts = [F.coalesce(_parts(text, kind), F.array()) for kind in KINDS]
    raw = rows.filter(text.rlike("[0-9@]")).select("rid", F.explode(F.concat(*parts)).alias("p")).select("rid", "p.*")
    inside = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("gap") + F.coalesce(F.length("match"), F.lit(0))).over(inside), F.lit(0))
    return (
        raw.withColumn("before", before)
        .filter("match is not null")
        .withColumn("start", F.col("before") + F.col("gap"))
        .select("rid", "kind", "start", (F.col("start") + F.length("match")).alias("stop"), "match")
    )


def with_contexts(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Add ``left, right``, the characters around each match as they stand in the text, whatever else matches there.

    Punctuation at the match itself is no part of them, for seeds as for candidates.
    """
    spot = F.struct("kind", "start", "stop", "match")
    by_row = found.groupBy(F.col("rid").alias("__rid")).agg(F.collect_list(spot).alias("__spots"))
    text, p = F.col("text"), F.col("p")
    begin = F.greatest(p["start"] - _CONTEXT, F.lit(0))
    left = F.substring(text, (begin + 1).cast("int"), (p["start"] - begin).cast("int"))
    right = F.substring(text, (p["stop"] + 1).cast("int"), F.lit(_CONTEXT))
    return (
        rows.join(by_row, F.col("rid") == F.col("__rid"))
        .select("rid", "text", F.explode("__spots").alias("p"))
        .select("rid", "p.*", F.regexp_replace(left, rf"{_GLUED}$", "").alias("left"), F.regexp_replace(right, rf"^{_GLUED}", "").alias("right"))
    )


def _trimmed(found: DataFrame) -> DataFrame:
    """Identifier-shaped words without the punctuation around them; at least four characters must be left."""
    lead = F.length(F.regexp_extract("match", r"^[^\p{L}\p{N}@+]*+", 0))
    core = F.regexp_extract("match", r"^[^\p{L}\p{N}@+]*+(.*?)[^\p{L}\p{N}]*$", 1)
    return (
        found.withColumns({"start": F.col("start") + lead, "match": core})
        .withColumn("stop", F.col("start") + F.length("match"))
        .filter(F.length("match") >= 4)
    )


def _outside(candidates: DataFrame, seeds: DataFrame) -> DataFrame:
    """The candidates that overlap no seed of their text, by two ordered passes over both."""
    names = candidates.columns
    rows = candidates.withColumn("__seed", F.lit(0)).unionByName(seeds.select(*names).withColumn("__seed", F.lit(1)))
    up = Window.partitionBy("rid").orderBy("start", F.col("__seed").desc()).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("rid").orderBy(F.col("start").desc(), "__seed").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumns(
            {
                "__reach": F.max(F.when(F.col("__seed") == 1, F.col("stop"))).over(up),
                "__next": F.min(F.when(F.col("__seed") == 1, F.col("start"))).over(down),
            }
        )
        .filter("__seed = 0 and (__reach is null or __reach <= start) and (__next is null or __next >= stop)")
        .select(*names)
    )


def _edges(found: DataFrame) -> DataFrame:
    """``pattern, instance``: the two words before, and the word before with the one after."""
    words = F.filter(F.split(F.lower("left"), rf"[{_GAP}]+"), lambda w: w != "")
    after = F.filter(F.split(F.lower("right"), rf"[{_GAP}]+"), lambda w: w != "")
    one, two = F.try_element_at(words, F.lit(-1)), F.try_element_at(words, F.lit(-2))
    patterns = F.array(F.concat(two, F.lit(" "), one, F.lit(" _")), F.concat(one, F.lit(" _ "), F.try_element_at(after, F.lit(1))))
    return found.select(F.explode(patterns).alias("pattern"), F.lower("match").alias("instance")).filter("pattern is not null").distinct()


def discover(seeds: DataFrame, candidates: DataFrame, *, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE) -> DataFrame:
    """``instance, score`` of the unseen instances that patterns bring up, lower case."""
    edges = staged(_edges(seeds).unionByName(_edges(candidates)).distinct(), "pii-edges")
    known = seeds.select(F.lower("match").alias("instance")).distinct().withColumn("score", F.lit(1.0))
    seeded = known
    for _ in range(rounds):
        scored = edges.join(known, "instance", "left")
        patterns = (
            scored.groupBy("pattern")
            .agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("sum"), F.count("*").alias("n"), F.count("score").alias("n_known"))
            .filter(F.col("n_known") >= min_seeds)
            .select("pattern", (F.col("sum") / F.col("n")).alias("confidence"))
            .filter(F.col("confidence") >= min_score)
        )
        fresh = (
            edges.join(patterns, "pattern")
            .join(seeded.select("instance"), "instance", "left_anti")
            .groupBy("instance")
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("score"))
            .filter(F.col("score") >= min_score)
        )
        known = staged(seeded.unionByName(fresh), "pii-known")
    return known.join(seeded.select("instance"), "instance", "left_anti")


def spans(rows: DataFrame, **settings) -> DataFrame:
    """``rid, kind, start, stop`` of all spans in ``rid, text``, both the fixed patterns' and the discovered ones."""
    found = staged(occurrences(rows).filter(_valid()), "pii-found")
    seeds = found.filter(F.col("kind") != FOUND)
    candidates = staged(_outside(_trimmed(found.filter(F.col("kind") == FOUND)), seeds), "pii-candidates")
    spots = staged(with_contexts(seeds.unionByName(candidates), rows), "pii-contexts")
    fresh = discover(spots.filter(F.col("kind") != FOUND), spots.filter(F.col("kind") == FOUND), **settings).select(F.col("instance").alias("__instance"))
    added = candidates.join(fresh, F.lower("match") == F.col("__instance"), "left_semi")
    columns = ["rid", "kind", "start", "stop"]
    return seeds.select(*columns).unionByName(added.select(*columns))


def _rank(kind: Column) -> Column:
    return reduce(lambda a, k: a.when(kind == k, KINDS.index(k)), KINDS[1:], F.when(kind == KINDS[0], 0))


def _joined(items: Column, keep) -> Column:
    return F.array_join(
        F.transform(F.filter(items, keep), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def pii_report(docs: DataFrame, **settings) -> DataFrame:
    """Counts of the fixed kinds, a hash of their spans, and all spans, of every row.

    Null texts are empty; repeated rows are reported each. Spans are ordered by start, then kind as in ``KINDS``.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marked = staged(rows.withColumn("text", F.when(F.col("text").rlike("[0-9@]"), F.col("text")).otherwise("")), "pii-rows")
    item = F.struct("start", _rank(F.col("kind")).alias("rank"), "kind", "stop")
    by_row = spans(marked.select("rid", "text"), **settings).groupBy("rid").agg(F.array_sort(F.collect_list(item)).alias("items"))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,stop:bigint>>")
    joined = marked.select("rid", "doc_id").join(by_row, "rid", "left").withColumn("items", F.coalesce("items", none))

    def count(kind: str) -> Column:
        return F.size(F.filter("items", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return joined.select(
        "doc_id",
        *map(count, BASE),
        F.sha2(_joined(F.col("items"), lambda s: s["kind"] != FOUND), 256).alias("base_sha256"),
        _joined(F.col("items"), lambda s: F.lit(True)).alias("spans"),
        count(FOUND),
    )


def redact(docs: DataFrame, **settings) -> DataFrame:
    """The documents with each span, or run of overlapping spans, replaced by its (first) kind in brackets; same columns."""
    rows = staged(docs.withColumn("__rid", F.monotonically_increasing_id()), "pii-docs")
    found = spans(rows.select(F.col("__rid").alias("rid"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), **settings)
    in_order = Window.partitionBy("rid").orderBy("start", _rank(F.col("kind")), "stop")
    reach = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        found.withColumn("new", F.when(reach > F.col("start"), 0).otherwise(1))
        .withColumn("run", F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("rid", "run")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min_by("kind", F.struct("start", _rank(F.col("kind")))).alias("kind"))
        .groupBy("rid")
        .agg(F.array_sort(F.collect_list(F.struct("start", "stop", "kind"))).alias("__runs"))
    )
    joined = rows.join(runs.withColumnRenamed("rid", "__r"), F.col("__rid") == F.col("__r"), "left")
    text = F.col("text")

    def piece(i: Column) -> Column:
        at = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get("__runs", i - 1)["stop"])
        until = F.coalesce(F.get("__runs", i)["start"], F.length(text).cast("long"))
        mark = F.coalesce(F.concat(F.lit("["), F.upper(F.get("__runs", i)["kind"]), F.lit("]")), F.lit(""))
        return F.concat(F.substring(text, (at + 1).cast("int"), (until - at).cast("int")), mark)

    cleaned = F.array_join(F.transform(F.sequence(F.lit(0), F.size("__runs")), piece), "")
    changed = joined.withColumn("text", F.when(F.col("__runs").isNotNull(), cleaned).otherwise(text))
    if "n_chars" in docs.columns:
        changed = changed.withColumn(
            "n_chars", F.when(F.col("__runs").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
        )
    return changed.select(*docs.columns)
