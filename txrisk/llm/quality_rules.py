"""Quality rules and robust multivariate outliers, with DataFrame functions only.

Plain rules reject texts that are too short or repeat themselves. What passes becomes a vector of transformed statistics, and
for every language and source a minimum-covariance-determinant estimate of its centre and scatter is found: from three
starts (scaled by medians, the correlation of tanh values, spatial signs) the nearest three quarters of the vectors are taken,
their mean and covariance give new distances, and so on until determinants stop falling; the start with the least determinant wins, and a last
step takes all vectors that its distances do not call outliers. A text is kept if its squared Mahalanobis distance is within
a quantile of the chi-squared distribution.

One pass over the vectors makes a step, for all groups and starts: moments are summed by bins of distance before they are
shuffled, and bins are taken up to three quarters of the count. Vectors are whole numbers, so that sums are exact and the
same in any order. Medians come from counts of values. Equal vectors of a source count once, so that many copies of a text are not
taken for the source's usual text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import WORD, staged
from txrisk.storage import materialize, remove, scratch_path

MIN_WORDS, MAX_REPEATED = 20, 30  # per cent of the words
WINDOW = 8  # words
DIMENSIONS = 5
UNIT = 256  # statistics are counted in this part of one, products then stay whole in 64 bits for 10**11 rows
# Least spread of each statistic: most texts have no symbols or repeats at all, which must not make any of them an outlier.
FLOORS = (0.3, 0.05, 0.25, 0.2, 0.2)
NEAREST = 0.75  # share of the vectors that a step takes
LEAST_ROWS = 50  # different vectors of a group that is estimated by itself
MAX_STEPS = 20
# Quantiles of the chi-squared distribution with 5 degrees of freedom: 0.975, and one in a thousand million beyond, since the
# statistics of plain texts have longer tails than normal ones; and the factors that make the covariance of the nearest 0.75 and 0.975 of
# normal vectors that of all of them.
WITHIN, CUTOFF = 12.833, 50.69
FACTOR_NEAREST, FACTOR_WITHIN = 1.416, 1.055
_BINS = 8  # of squared distance, in a doubling
_SALTS = 16
_LOWER = [(i, j) for i in range(DIMENSIONS) for j in range(i + 1)]
X = [f"x{i}" for i in range(DIMENSIONS)]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _neighbours(array: Column, by: int = 1) -> tuple[Column, Column]:
    """An array's elements and those ``by`` places on, where both exist."""
    length = F.greatest(F.size(array) - by, F.lit(0))
    return F.slice(array, 1, length), F.slice(array, by + 1, length)


def with_counts(docs: DataFrame) -> DataFrame:
    """Add the counts of a text and ``n_lines`` (lines with a word); the column ``text`` must not be null.

    ``n_repeat_words`` compares windows of eight words by 64-bit hashes.
    """
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    out = docs.withColumns({"__w": words, "__l": lines})
    out = out.withColumns(
        {
            "n_words": F.size("__w").cast("long"),
            "word_chars": F.length(F.array_join("__w", "")).cast("long"),
            "n_symbols": F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_lines": F.size("__l").cast("long"),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
            "__h": F.transform("__w", lambda w: F.xxhash64(w)),
        }
    ).drop("__w", "__l")
    have = 1
    while have < WINDOW:
        out = out.withColumn("__h", F.zip_with(*_neighbours(F.col("__h"), have), lambda x, y: F.xxhash64(x, y)))
        have *= 2
    # Only texts that have a window twice are looked at more closely.
    twice = F.size(F.array_distinct("__h")) < F.size("__h")
    out = out.withColumn("__h", F.when(twice, F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = F.zip_with(*_neighbours(F.col("__h")), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>")))
    out = out.withColumn("__h", F.sort_array(F.array_distinct(F.flatten(same))))
    new = F.zip_with(*_neighbours(F.col("__h")), lambda x, y: F.least(y - x, F.lit(WINDOW)))
    covered = F.aggregate(new, F.lit(WINDOW), lambda total, n: total + n)
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__h")


def _vector() -> list[Column]:
    """Length, length of words, density of symbols, share of repeated lines and of repeated words, on scales of logarithms."""
    words, chars, symbols, lines, dup, repeat = (F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"))
    values = (
        F.log1p(words),
        F.log((chars + 1) / (words + 1)),
        F.log1p(100 * symbols / (chars + 1)),
        F.log1p(10 * dup / (lines + 1)),
        F.log1p(10 * repeat / (words + 1)),
    )
    return [F.round(v * UNIT).cast("long").alias(x) for v, x in zip(values, X)]


def _look_up(rows: DataFrame, small: DataFrame, on: str, deal_by: list[str]) -> DataFrame:
    """Rows with what ``small`` has for their ``on``. A value that very many rows share is dealt out."""
    salted = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return rows.withColumn("__salt", F.pmod(F.xxhash64(*deal_by), F.lit(_SALTS)).cast("int")).join(salted, [on, "__salt"], "left").drop("__salt")


def _moments(x: str = "x", suffix: str = "") -> list[Column]:
    """Sums of the columns x0 to x4 and of their products."""
    sums = [f"sum({x}{i}) AS s{suffix}{i}" for i in range(DIMENSIONS)]
    return [F.expr(e) for e in (*sums, *(f"sum({x}{i} * {x}{j}) AS s{suffix}{i}{j}" for i, j in _LOWER))]


SUMS = ["n", *(f"s{i}" for i in range(DIMENSIONS)), *(f"s{i}{j}" for i, j in _LOWER)]


def _whitened(df: DataFrame, scatter: dict[tuple[int, int], str], scale: str = "") -> DataFrame:
    """Add ``m``, the rows of the inverse Cholesky factor of a scatter matrix (its columns divided by the array ``scale``), and ``logdet``.

    One projection, whose later columns use the earlier ones.
    """
    steps = [f"{value} AS a{i}{j}" for (i, j), value in scatter.items()]
    total = lambda terms: " + ".join(["0D", *terms])
    for k in range(DIMENSIONS):
        for j in range(k):
            steps.append(f"(a{k}{j} - ({total(f'l{k}{m} * l{j}{m}' for m in range(j))})) / l{j}{j} AS l{k}{j}")
        steps.append(f"sqrt(greatest(a{k}{k} - ({total(f'l{k}{m} * l{k}{m}' for m in range(k))}), 1e-9D)) AS l{k}{k}")
        for j in range(k):
            steps.append(f"-({total(f'l{k}{m} * m{m}{j}' for m in range(j, k))}) / l{k}{k} AS m{k}{j}")
        steps.append(f"1 / l{k}{k} AS m{k}{k}")
    rows = ", ".join(f"m{i}{j}" + (f" / {scale}[{j}]" if scale else "") for i, j in _LOWER)
    steps.append(f"array({rows}) AS m")
    steps.append(f"2 * ({total(f'ln(l{k}{k})' for k in range(DIMENSIONS))}) AS logdet")
    return df.selectExpr("*", *steps).select(*df.columns, "m", "logdet")


def _estimates(moments: DataFrame, factor: float) -> DataFrame:
    """Centre ``mu``, ``m`` and ``logdet`` from the moments of chosen vectors; the covariance grows by ``factor`` and the floors."""
    scatter = {}
    for i, j in _LOWER:
        value = f"{factor}D * (s{i}{j} / n - s{i} / n * (s{j} / n))"
        scatter[i, j] = f"greatest({value}, 0D) + {(FLOORS[i] * UNIT) ** 2}D" if i == j else value
    centre = ", ".join(f"s{i} / n" for i in range(DIMENSIONS))
    return _whitened(moments.selectExpr("*", f"array({centre}) AS mu"), scatter)


def distance() -> Column:
    """Squared Mahalanobis distance of a vector (``x0`` to ``x4``) from an estimate (``mu``, ``m``)."""
    at = iter(range(len(_LOWER)))
    rows = (" + ".join(f"m[{next(at)}] * (x{j} - mu[{j}])" for j in range(k + 1)) for k in range(DIMENSIONS))
    return F.expr(" + ".join(f"power({row}, 2)" for row in rows))


def _nearest(rows: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """``key, start`` and the moments of the nearest vectors: whole bins of distance, up to ``share`` of the count or just above."""
    near = _look_up(rows, estimates.select("key", "start", "mu", "m"), "key", X)
    bins = near.withColumn("bin", F.floor(_BINS * F.log2(distance() + 1e-6)).cast("int")).groupBy("key", "start", "bin")
    bins = bins.agg(F.count("*").alias("n"), *_moments())
    group = Window.partitionBy("key", "start")
    before = F.coalesce(F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = F.ceil(share * F.sum("n").over(group))
    return bins.withColumns({"before": before, "wanted": wanted}).filter("before < wanted").groupBy("key", "start").agg(*(F.sum(s).alias(s) for s in SUMS))


def _centres(rows: DataFrame) -> DataFrame:
    """``key, med, scale``: medians, and median distances from them as standard deviations, from counts of values."""
    counted = staged(
        rows.select("key", F.posexplode(F.array(*X)).alias("dim", "value")).groupBy("key", "dim", "value").agg(F.count("*").alias("n")), "values"
    )

    def median(values: DataFrame) -> DataFrame:
        by = Window.partitionBy("key", "dim")
        upto = F.sum("n").over(by.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
        return values.withColumns({"upto": upto, "all": F.sum("n").over(by)}).filter(2 * F.col("upto") >= F.col("all")).groupBy("key", "dim").agg(F.min("value").alias("median"))

    middle = median(counted)
    off = counted.join(middle, ["key", "dim"]).select("key", "dim", F.abs(F.col("value") - F.col("median")).alias("value"), "n")
    both = middle.join(median(off.groupBy("key", "dim", "value").agg(F.sum("n").alias("n"))).withColumnRenamed("median", "mad"), ["key", "dim"])
    at = lambda c, i: F.max(F.when(F.col("dim") == i, F.col(c))).cast("double")
    return both.groupBy("key").agg(
        F.array(*(at("median", i) for i in range(DIMENSIONS))).alias("med"),
        F.array(*(F.greatest(1.4826 * at("mad", i), F.lit(FLOORS[i] * UNIT)) for i in range(DIMENSIONS))).alias("scale"),
    )


def _starts(rows: DataFrame) -> DataFrame:
    """``key, start, mu, m`` of three first estimates for every key."""
    centres = staged(_centres(rows), "centres")
    z = [f"(x{i} - med[{i}]) / scale[{i}] AS z{i}" for i in range(DIMENSIONS)]
    norm = "greatest(sqrt(" + " + ".join(f"z{i} * z{i}" for i in range(DIMENSIONS)) + "), 1e-9D) AS norm"
    bent = [f"cast(round({UNIT} * tanh(z{i})) AS long) AS t{i}" for i in range(DIMENSIONS)]
    signs = [f"cast(round({UNIT} * z{i} / norm) AS long) AS u{i}" for i in range(DIMENSIONS)]
    scored = _look_up(rows, centres, "key", X).selectExpr("key", *z, norm, *bent, *signs)
    sums = scored.groupBy("key").agg(F.count("*").alias("n"), *_moments("t", "t"), *_moments("u", "u"))
    sums = staged(sums, "moments").join(centres, "key")
    per = f"n / {UNIT * UNIT}D"
    spread = lambda i, j: f"(st{i}{j} / ({per}) - st{i} / n * (st{j} / ({per})))"
    own = lambda i: f"greatest({spread(i, i)}, 1e-6D)"
    # A twentieth of the unit matrix keeps them regular.
    matrices = [
        {(i, j): f"{float(i == j)}D" for i, j in _LOWER},
        {(i, j): "1D" if i == j else f"0.95D * {spread(i, j)} / sqrt({own(i)} * {own(j)})" for i, j in _LOWER},
        {(i, j): f"{0.95 * DIMENSIONS}D * su{i}{j} / ({per}) + {0.05 * (i == j)}D" for i, j in _LOWER},
    ]
    parts = [_whitened(sums, matrix, "scale").select("key", F.lit(k).alias("start"), F.col("med").alias("mu"), "m") for k, matrix in enumerate(matrices)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def estimate(rows: DataFrame, max_steps: int = MAX_STEPS) -> DataFrame:
    """``key, mu, m`` of every key of the vectors ``key, x0, .., x4``: the minimum-covariance-determinant estimate, reweighted.

    Steps end when the determinants no longer fall (their logarithms, to a hundredth, added up over keys and starts), or after ``max_steps``.
    """
    spark = rows.sparkSession
    at = scratch_path(spark, "estimates")
    now = materialize(_estimates(_nearest(rows, staged(_starts(rows), "starts"), 0.5), FACTOR_NEAREST), at)
    mark = None
    for _ in range(max_steps):
        path = scratch_path(spark, "estimates")
        now = materialize(_estimates(_nearest(rows, now, NEAREST), FACTOR_NEAREST), path)
        remove(spark, at)
        at = path
        found = now.agg(F.sum(F.round(100 * F.col("logdet")).cast("long"))).first()[0] or 0
        if mark is not None and found >= mark:
            break
        mark = found
    best = now.groupBy("key").agg(F.min_by(F.struct("mu", "m"), F.struct("logdet", "start")).alias("best")).select("key", "best.mu", "best.m")
    inside = _look_up(rows, staged(best, "best"), "key", X).filter(distance() <= WITHIN)
    remove(spark, at)
    return _estimates(inside.groupBy("key").agg(F.count("*").alias("n"), *_moments()), FACTOR_WITHIN).select("key", "mu", "m")


def judge(docs: DataFrame, *, least_rows: int = LEAST_ROWS, cutoff: float = CUTOFF) -> DataFrame:
    """``doc_id``, the five counts, ``base_failed``, ``distance`` (squared) and ``kept`` of every row.

    Words are `[^\\x20\\x09-\\x0D]+`. ``base_failed``: fewer than 20 words, or more than 30 % of them in repeated windows. Of the
    rest those within ``cutoff`` of their group's estimate are kept. Groups are language and source, null being a value
    like others; sources with fewer than ``least_rows`` different vectors are estimated together, by language, and where that is
    too few as well there is no estimate: ``distance`` is null and the row is kept. Null text is empty. Repeated rows get
    equal answers and count once in an estimate; other columns are left out.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *(F.col(c).cast("string").alias(c) for c in ("lang", "source")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    name = lambda *c: F.to_json(F.struct(*c))
    counted = with_counts(rows).withColumns({"base_failed": failed, "group": name("lang", "source"), "pool": name("lang")})
    stats = staged(counted.select("doc_id", *COUNTS, "base_failed", "group", "pool", *_vector()), "statistics")
    vectors = staged(stats.filter("not base_failed").select("group", "pool", *X).distinct(), "vectors")
    sizes = staged(vectors.groupBy("group", "pool").agg(F.count("*").alias("n")), "sizes")
    pooled = sizes.filter(F.col("n") < least_rows).groupBy("pool").agg(F.sum("n").alias("pooled"))
    key = F.when(F.col("n") >= least_rows, F.col("group")).when(F.col("pooled") >= least_rows, F.concat(F.lit("all "), "pool"))
    keys = staged(sizes.join(pooled, "pool", "left").select("group", key.alias("key")), "keys")
    keyed = staged(_look_up(vectors, keys, "group", X).filter("key is not null").select("key", *X), "keyed")
    estimates = staged(estimate(keyed), "estimates").join(keys, "key").select("group", "mu", "m")
    judged = _look_up(stats, staged(estimates, "estimates"), "group", ["doc_id", *X]).withColumn("distance", distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select("doc_id", *COUNTS, "base_failed", "distance", kept.alias("kept"))


def quality_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, the five counts, ``base_failed`` and ``kept`` of every row."""
    return judge(docs).select("doc_id", *COUNTS, "base_failed", "kept")
