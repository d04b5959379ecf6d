"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    y(x) = w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

The pairwise sum is taken in time linear in the features, as half of
``sum_f (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2``. Rows are scored where they are read, so a
document costs no shuffle. The model is a fixed number of floats, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import buffers
from txrisk.llm.common import id_bucket, labelled_sample, set_aside

WORD_BUCKETS = 1 << 14
FACTORS = 8
SAMPLE_ROWS = 8_000  # labelled documents that a fit sees at most
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0

# Kinds of bytes whose shares describe a text.
_KINDS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\r\n", ".,;:", "!?", "#$%&*", "|<>{}[]()/\\=_~^@+-", "'\""]
_KIND = np.full(256, len(_KINDS), np.int64)
for _i, _chars in enumerate(_KINDS):
    _KIND[list(_chars.encode())] = _i
_KIND[128:] = 0  # letters of other scripts
N_STATS = len(_KINDS) + 1 + 9


def structure(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> np.ndarray:
    """Structure statistics of every row, all roughly within 0..1; ``n_chars`` is the metadata column."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    kind = _KIND[data]
    shares = np.bincount(row * (len(_KINDS) + 1) + kind, minlength=n * (len(_KINDS) + 1)).reshape(n, -1)
    out = np.zeros((n, N_STATS), np.float32)
    out[:, : len(_KINDS) + 1] = shares / np.maximum(size, 1)[:, None]
    starts, ends, rows = buffers.word_bounds(data, offsets, buffers.WHITE)
    count = np.bincount(rows, minlength=n)
    most = np.maximum(count, 1)

    def share(flags):
        return np.bincount(rows, flags, n) / most

    if len(starts):
        first, last = kind[starts], kind[ends - 1]
        letters = np.concatenate([[0], np.cumsum(kind <= 1)])
        upper = np.concatenate([[0], np.cumsum(kind == 1)])
        n_letters = letters[ends] - letters[starts]
        out[:, -9] = share(last >= 6)  # words that end in a symbol
        out[:, -8] = share(n_letters == 0)
        out[:, -7] = share((upper[ends] - upper[starts] == n_letters) & (n_letters > 1))
        out[:, -6] = share(first == 1)
        out[:, -5] = np.minimum(np.bincount(rows, ends - starts, n) / most / 20, 3)
    line_break = buffers._table("\n")
    s, e, r = buffers.word_bounds(data, offsets, line_break)
    lines = np.bincount(r, minlength=n)
    hashes = buffers.span_hashes(data, s, e)
    order = np.lexsort((hashes, r))
    again = np.zeros(len(s), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (r[order][1:] == r[order][:-1])
    out[:, -4] = np.bincount(r[order], again, n) / np.maximum(lines, 1)  # repeated lines
    out[:, -3] = np.minimum(lines / most * 5, 3)
    out[:, -2] = np.log2(1 + count) / 16
    out[:, -1] = np.log2(1 + np.maximum(n_chars, 0)) / 20
    return out


def word_features(data: np.ndarray, offsets: np.ndarray):
    """Row offsets, buckets and values of the distinct hashed words of every row; values have length one per row."""
    n = len(offsets) - 1
    hashes, rows = buffers.words(data, offsets)
    keys = np.unique((rows.astype(np.int64) << 32) | (hashes & np.uint64(WORD_BUCKETS - 1)).astype(np.int64))
    bounds = buffers.row_bounds(keys >> 32, n)
    values = 1 / np.sqrt(np.maximum(np.diff(bounds), 1))
    return bounds, (keys & 0xFFFFFFFF).astype(np.int32), values.astype(np.float32)


def _row_sums(rows_of: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros((len(bounds) - 1, *rows_of.shape[1:]), np.float64)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        sums[full] = np.add.reduceat(rows_of, bounds[:-1][full], axis=0)
    return sums


@dataclass
class FactorisationMachine:
    """Words come first in ``w`` and ``v``, the structure statistics after them."""

    bias: float = 0.0
    w: np.ndarray = field(default_factory=lambda: np.zeros(WORD_BUCKETS + N_STATS, np.float32))
    v: np.ndarray = field(default_factory=lambda: np.zeros((WORD_BUCKETS + N_STATS, FACTORS), np.float32))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(N_STATS, np.float32))
    scale: np.ndarray = field(default_factory=lambda: np.ones(N_STATS, np.float32))

    def standard(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.scale, -5, 5)

    def margins(self, bounds, buckets, values, stats):
        """Raw scores, and the factor sums that a gradient needs."""
        linear = _row_sums(self.w[buckets], bounds) * values + stats @ self.w[WORD_BUCKETS:]
        picked = self.v[buckets]
        sums = _row_sums(picked, bounds) * values[:, None] + stats @ self.v[WORD_BUCKETS:]
        squares = _row_sums(picked**2, bounds) * values[:, None] ** 2 + stats**2 @ self.v[WORD_BUCKETS:] ** 2
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1), sums

    def scores(self, data, offsets, n_chars) -> np.ndarray:
        bounds, buckets, values = word_features(data, offsets)
        stats = self.standard(structure(data, offsets, n_chars))
        return 1 / (1 + np.exp(-np.clip(self.margins(bounds, buckets, values, stats)[0], -30, 30)))


def fit(features: list[tuple[np.ndarray, float, np.ndarray]], y: np.ndarray, *, epochs: int = 8, batch: int = 64, rate: float = 0.05, decay: float = 1e-4, seed: int = 1) -> FactorisationMachine:
    """Adagrad on the logistic loss. ``features`` holds (buckets, value, statistics) of each row.

    Without rows the model scores 0.5; with one class it scores that class's smoothed share.
    """
    model = FactorisationMachine()
    if not len(y):
        return model
    random = np.random.default_rng(seed)
    stats = np.stack([f[2] for f in features])
    model.mean, model.scale = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)
    stats = model.standard(stats)
    share = (y.sum() + 1) / (len(y) + 2)
    model.bias = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return model
    model.v[:] = random.normal(0, 0.02, model.v.shape)
    seen = {"w": np.full(model.w.shape, 1e-4, np.float32), "v": np.full(model.v.shape, 1e-4, np.float32)}
    seen_bias = 1e-4
    own = np.arange(WORD_BUCKETS, WORD_BUCKETS + N_STATS)
    for _ in range(epochs):
        order = random.permutation(len(y))
        for at in range(0, len(y), batch):
            rows = order[at : at + batch]
            buckets = np.concatenate([features[i][0] for i in rows])
            lengths = np.array([len(features[i][0]) for i in rows])
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            values = np.array([features[i][1] for i in rows], np.float32)
            x = stats[rows]
            margin, sums = model.margins(bounds, buckets, values, x)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[rows]) / len(rows)
            e, val = np.repeat(error, lengths), np.repeat(values, lengths)
            distinct, place = np.unique(buckets, return_inverse=True)
            gw = np.bincount(place, e * val, len(distinct))
            v = model.v[buckets]
            each = (e * val)[:, None] * (np.repeat(sums, lengths, axis=0) - v * val[:, None])
            gv = np.stack([np.bincount(place, each[:, f], len(distinct)) for f in range(FACTORS)], axis=1)
            at_all = np.concatenate([distinct, own])
            gw = np.concatenate([gw, x.T @ error]) + decay * model.w[at_all]
            gv = np.concatenate([gv, x.T @ (error[:, None] * sums) - ((x**2).T @ error)[:, None] * model.v[own]]) + decay * model.v[at_all]
            for name, gradient in (("w", gw), ("v", gv)):
                seen[name][at_all] += gradient**2
                getattr(model, name)[at_all] -= rate * gradient / np.sqrt(seen[name][at_all])
            seen_bias += error.sum() ** 2
            model.bias -= rate * error.sum() / np.sqrt(seen_bias)
    return model


def _n_chars(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("n_chars").to_pandas().to_numpy(dtype=float)
    return np.nan_to_num(column, nan=0.0)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y, n_chars = batch.column("y").to_numpy(zero_copy_only=False), _n_chars(batch)
        for row, data, offsets in buffers.slices(batch.column("text")):
            n = len(offsets) - 1
            bounds, buckets, values = word_features(data, offsets)
            stats = structure(data, offsets, n_chars[row : row + n])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").slice(row, n),
                    "y": pa.array(y[row : row + n], pa.int32()),
                    "buckets": pa.array([buckets[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                    "stats": pa.array([s.tobytes() for s in stats], pa.binary()),
                }
            )


def train(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """Fit on at most ``sample_rows`` labelled documents whose id is not held out.

    Features are computed on the executors; the driver receives about 3 KB for each sampled row.
    """
    sample = labelled_sample(
        _inputs(docs), labels, "quality", id_bucket(F.col("doc_id"), FOLDS) != HELD_OUT, sample_rows
    )
    rows = sample.mapInArrow(_featurise, "doc_id long, y int, buckets binary, stats binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.y, r.buckets))
    features = []
    for r in rows:
        buckets = np.frombuffer(r.buckets, np.int32)
        features.append((buckets, 1 / np.sqrt(max(len(buckets), 1)), np.frombuffer(r.stats, np.float32)))
    return fit(features, np.array([r.y for r in rows], np.float64))


def _inputs(docs: DataFrame) -> DataFrame:
    n_chars = F.col("n_chars") if "n_chars" in docs.columns else F.length("text")
    return docs.select(F.col("doc_id").cast("long"), F.col("text"), n_chars.cast("double").alias("n_chars"))


def score(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """Add ``score, predicted`` to every row; columns of these names are replaced.

    Texts of any length are scored whole. Null counts as the empty text, which has the score of a
    text without words; a missing ``n_chars`` counts as 0. Repeated rows are scored each.
    """
    docs = docs.drop("score", "predicted")
    given = docs if "n_chars" in docs.columns else docs.withColumn("n_chars", F.length("text"))
    held, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_chars, out = _n_chars(batch), np.zeros(batch.num_rows)
            for row, data, offsets in buffers.slices(batch.column("text")):
                n = len(offsets) - 1
                out[row : row + n] = held.value.scores(data, offsets, n_chars[row : row + n])
            columns = dict(zip(batch.schema.names, batch.columns))
            yield pa.RecordBatch.from_pydict({c: columns[c] for c in names} | {"score": pa.array(out)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return given.mapInArrow(run, f"{schema}, score double").withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; a null id is not held out."""
    scored = score(docs.select(*[c for c in ("doc_id", "text", "n_chars") if c in docs.columns]), train(docs, labels))
    held_out = F.coalesce(id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the classifier does not reject, with their own columns."""
    rows, own = set_aside(docs, "score", "predicted")
    return score(rows, train(docs, labels)).filter("predicted = 1").select(*own)
