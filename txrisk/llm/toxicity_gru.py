"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

Each word enters as a hashed word vector and the mean of its hashed character-gram vectors. A text is cut
into overlapping windows of words; both directions of the network read a window, attention pools their
states, and a text scores as its worst window. All windows of a slice of rows advance together, step by step,
so that a step is a few matrix operations whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import buffers
from txrisk.llm.common import id_bucket, labelled_sample, staged

WINDOW, STRIDE = 32, 16
WORD_BUCKETS, GRAM_BUCKETS = 1 << 13, 1 << 13
DIM, HIDDEN, ATTENTION = 8, 8, 8
GRAM_BYTES = (3, 5)
SAMPLE_ROWS = 2_500  # labelled documents of each class that a fit sees at most
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
_CHUNK = 8192  # windows that advance together


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _shapes() -> dict[str, tuple[int, ...]]:
    both = {f"{d}_{n}": s for d in "fb" for n, s in (("w", (2 * DIM, 3 * HIDDEN)), ("u", (HIDDEN, 3 * HIDDEN)), ("c", (3 * HIDDEN,)))}
    return both | {
        "words": (WORD_BUCKETS, DIM),
        "grams": (GRAM_BUCKETS, DIM),
        "att_w": (2 * HIDDEN, ATTENTION),
        "att_c": (ATTENTION,),
        "att_v": (ATTENTION,),
        "out_w": (2 * HIDDEN,),
        "out_c": (1,),
    }


@dataclass
class Vocabulary:
    """Distinct words of a slice: bucket of each, and its character grams."""

    bucket: np.ndarray
    grams: np.ndarray
    bounds: np.ndarray


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """Distinct words, the number of each word among them, and the row of each word."""
    data = buffers.FOLD[data]
    starts, ends, rows = buffers.word_bounds(data, offsets, buffers.WHITE)
    hashes = buffers.span_hashes(data, starts, ends)
    distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    s, e = starts[first], ends[first]
    size = e - s
    bounds = np.concatenate([[0], np.cumsum(size)])
    word = np.repeat(np.arange(len(s)), size)
    at = np.arange(bounds[-1]) - bounds[word] + s[word]
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    stop = e[word]
    grams = []
    for n in GRAM_BYTES:  # the gram that begins at each byte, zero beyond the word's end
        g = np.full(len(at), n, np.uint64)
        for k in range(n):
            g = g * np.uint64(257) + np.where(at + k < stop, padded[at + k] + np.uint64(1), np.uint64(0))
        first_byte = (at == s[word]).astype(np.uint64)
        grams.append((buffers.mix(g * np.uint64(2) + first_byte) % np.uint64(GRAM_BUCKETS)).astype(np.int32))
    return Vocabulary((distinct % np.uint64(WORD_BUCKETS)).astype(np.int32), np.stack(grams, axis=1), bounds), place, rows


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and length of all overlapping windows of rows with the given word offsets."""
    n = np.diff(bounds)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = bounds[row] + k * STRIDE
    return row, start, np.minimum(WINDOW, bounds[row + 1] - start)


@dataclass
class Network:
    p: dict[str, np.ndarray] = field(default_factory=lambda: {k: np.zeros(s, np.float32) for k, s in _shapes().items()})
    prior: float = 0.0  # margin of a text without words
    shift: float = 0.0  # from the odds of the sample to those of the labels

    @staticmethod
    def random(seed: int = 1) -> Network:
        draw = np.random.default_rng(seed)
        p = {}
        for k, s in _shapes().items():
            scale = 0.1 if k in ("words", "grams") else 0 if k.endswith("_c") else 1 / np.sqrt(s[0])
            p[k] = (draw.normal(0, 1, s) * scale).astype(np.float32)
        return Network(p)

    def inputs(self, v: Vocabulary) -> np.ndarray:
        """Word vector and mean gram vector of each distinct word."""
        x = np.zeros((len(v.bucket), 2 * DIM), np.float32)
        x[:, :DIM] = self.p["words"][v.bucket]
        if len(v.bucket):
            sums = np.zeros((len(v.grams), DIM), np.float32)
            for k in range(len(GRAM_BYTES)):
                sums += self.p["grams"][v.grams[:, k]]
            x[:, DIM:] = np.add.reduceat(sums, v.bounds[:-1], axis=0) / np.diff(v.bounds)[:, None]
        return x

    def run(self, x: np.ndarray, index: np.ndarray, length: np.ndarray):
        """Margins of windows sorted by falling length; ``index`` points into ``x``. Also what the gradient needs."""
        p, (n, steps) = self.p, index.shape
        active = np.searchsorted(-length, -np.arange(steps), "left")  # windows longer than each step
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        kept = {}
        for d, at in (("f", 0), ("b", HIDDEN)):
            projected = x @ p[d + "_w"] + p[d + "_c"]
            h = np.zeros((n, HIDDEN), np.float32)
            trace = kept[d] = [None] * steps
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                a = active[t]
                before = h[:a]
                given, held = projected[index[:a, t]], before @ p[d + "_u"]
                gates = 1 / (1 + np.exp(-(given[:, : 2 * HIDDEN] + held[:, : 2 * HIDDEN])))
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(given[:, 2 * HIDDEN :] + r * held[:, 2 * HIDDEN :])
                after = new + z * (before - new)
                trace[t] = (before, z, r, new, held[:, 2 * HIDDEN :])
                states[t, :a, at : at + HIDDEN] = after
                h = np.concatenate([after, h[a:]]) if a < n else after
        u = np.tanh(states @ p["att_w"] + p["att_c"])
        score = u @ p["att_v"]
        score[np.arange(steps)[:, None] >= length[None, :]] = -np.inf
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        return pooled @ p["out_w"] + p["out_c"][0], (active, states, kept, u, weight, pooled)

    def gradient(self, x, index, length, error, cache) -> tuple[dict[str, np.ndarray], np.ndarray]:
        p, (n, steps) = self.p, index.shape
        active, states, kept, u, weight, pooled = cache
        g = {"out_w": pooled.T @ error, "out_c": error.sum(keepdims=True)}
        dpooled = error[:, None] * p["out_w"]
        dweight = (states * dpooled).sum(axis=2)
        dscore = weight * (dweight - (weight * dweight).sum(axis=0))
        du = dscore[:, :, None] * p["att_v"] * (1 - u**2)
        g["att_v"] = (dscore[:, :, None] * u).sum(axis=(0, 1))
        g["att_c"] = du.sum(axis=(0, 1))
        g["att_w"] = np.tensordot(states, du, ((0, 1), (0, 1)))
        dstates = weight[:, :, None] * dpooled + du @ p["att_w"].T
        dx = np.zeros_like(x)
        for d, at in (("f", 0), ("b", HIDDEN)):
            gu = np.zeros_like(p[d + "_u"])
            dprojected = np.zeros((len(x), 3 * HIDDEN), np.float32)
            dh = np.zeros((n, HIDDEN), np.float32)
            for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
                a = active[t]
                before, z, r, new, held = kept[d][t]
                now = dh[:a] + dstates[t, :a, at : at + HIDDEN]
                dnew = now * (1 - z) * (1 - new**2)
                dz = now * (before - new) * z * (1 - z)
                dr = dnew * held * r * (1 - r)
                np.add.at(dprojected, index[:a, t], np.concatenate([dz, dr, dnew], axis=1))
                dheld = np.concatenate([dz, dr, dnew * r], axis=1)
                gu += before.T @ dheld
                dh[:a] = now * z + dheld @ p[d + "_u"].T
            g[d + "_u"], g[d + "_c"], g[d + "_w"] = gu, dprojected.sum(axis=0), x.T @ dprojected
            dx += dprojected @ p[d + "_w"].T
        return g, dx

    def window_margins(self, v: Vocabulary, place: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        x, out = self.inputs(v), np.zeros(len(start), np.float32)
        order = np.argsort(-length, kind="stable")
        for at in range(0, len(order), _CHUNK):
            o = order[at : at + _CHUNK]
            steps = np.arange(int(length[o[0]]))
            index = place[np.minimum(start[o][:, None] + steps, len(place) - 1)]
            out[o] = self.run(x, index, length[o])[0]
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score of each row: that of its worst window."""
        n = len(offsets) - 1
        v, place, rows = tokens(data, offsets)
        row, start, length = windows(buffers.row_bounds(rows, n))
        margin = np.full(n, self.prior, np.float64)
        if len(row):
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            margin[row[first]] = np.maximum.reduceat(self.window_margins(v, place, start, length), first) + self.shift
        return _sigmoid(margin)


def fit(y: np.ndarray, choose: Callable[[Network | None], list[bytes | None]], *, epochs: int = 3, batch: int = 64, rate: float = 0.01, word_drop: float = 0.3, seed: int = 1) -> Network:
    """Adam on the logistic loss of each document's worst window, by back-propagation through time.

    ``choose`` gives one window of each document, none for one without words: any for no network, else the worst of all
    its windows by that network. Without rows the network scores 0.5, with one class that class's smoothed share.
    """
    net = Network.random(seed)
    share = (y.sum() + 1) / (len(y) + 2)
    net.prior = float(np.log(share / (1 - share)))
    parts = choose(None) if len(y) and y.min() < y.max() else []
    kept = [i for i, part in enumerate(parts) if part is not None]
    if not kept:
        net.p["out_w"][:] = 0
        net.p["out_c"][:] = net.prior
        return net
    y = y[kept].astype(np.float32)
    draw = np.random.default_rng(seed)
    moment = {k: np.zeros_like(a) for k, a in net.p.items()}
    square = {k: np.zeros_like(a) for k, a in net.p.items()}
    net.p["out_c"][:] = net.prior
    step = 0
    for epoch in range(epochs):
        if epoch:
            parts = choose(net)
        data, offsets = buffers.text_bytes(pa.array([parts[i] for i in kept], pa.binary()).cast(pa.string()))
        v, place, rows = tokens(data, offsets)
        starts = buffers.row_bounds(rows, len(offsets) - 1)
        lengths = np.diff(starts)
        order = draw.permutation(len(kept))
        for at in range(0, len(order), batch):
            w = order[at : at + batch]
            w = w[np.argsort(-lengths[w], kind="stable")]
            index = place[np.minimum(starts[w][:, None] + np.arange(int(lengths[w[0]])), len(place) - 1)]
            used, index = np.unique(index, return_inverse=True)
            own = Vocabulary(v.bucket[used], *_grams_of(v, used))
            x = net.inputs(own)
            heard = (draw.random((len(x), 1)) >= word_drop).astype(np.float32)  # else the grams alone must do
            x[:, :DIM] *= heard
            margin, cache = net.run(x, index.reshape(len(w), -1), lengths[w])
            error = ((_sigmoid(margin) - y[w]) / len(w)).astype(np.float32)
            g, dx = net.gradient(x, index.reshape(len(w), -1), lengths[w], error, cache)
            g["words"], g["grams"] = np.zeros_like(net.p["words"]), np.zeros_like(net.p["grams"])
            np.add.at(g["words"], own.bucket, dx[:, :DIM] * heard)
            size = np.diff(own.bounds)
            each = np.repeat(dx[:, DIM:] / size[:, None], size, axis=0)
            for k in range(len(GRAM_BYTES)):
                np.add.at(g["grams"], own.grams[:, k], each)
            step += 1
            for k, gradient in g.items():
                moment[k] += 0.1 * (gradient - moment[k])
                square[k] += 0.01 * (gradient**2 - square[k])
                net.p[k] -= rate * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
    return net


def _grams_of(v: Vocabulary, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(v.bounds)[used]
    bounds = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size) + np.repeat(v.bounds[used], size)
    return v.grams[at], bounds


def _chosen_windows(net: Network | None):
    """One window of every row, of all it has: the worst by ``net``, else one by a hash of the id; null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy().astype(np.uint64)
            for row, data, offsets in buffers.slices(batch.column("text")):
                n = len(offsets) - 1
                starts, ends, rows = buffers.word_bounds(data, offsets, buffers.WHITE)
                of, first, length = windows(buffers.row_bounds(rows, n))
                bounds = buffers.row_bounds(of, n)
                if net is None:
                    picked = bounds[:-1] + (buffers.mix(ids[row : row + n]) % np.maximum(np.diff(bounds), 1).astype(np.uint64)).astype(np.int64)
                else:
                    v, place, _ = tokens(data, offsets)
                    margins = net.window_margins(v, place, first, length)
                    picked = [a + int(np.argmax(margins[a:b])) if b > a else 0 for a, b in zip(bounds, bounds[1:])]
                parts = [data[starts[first[k]] : ends[first[k] + length[k] - 1]].tobytes() if b > a else None for k, a, b in zip(picked, bounds, bounds[1:])]
                yield pa.RecordBatch.from_pydict({"number": batch.column("number").slice(row, n), "part": pa.array(parts, pa.binary())})

    return run


def train(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Network:
    """Fit on at most ``sample_rows`` labelled documents of each class whose id is not held out.

    All windows of a sampled document count: before each pass the executors choose its worst, and the driver
    receives that one. As the classes are sampled apart, margins are shifted back to the odds that the labels have.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    usable = id_bucket(F.col("doc_id"), FOLDS) != HELD_OUT
    both = [labelled_sample(texts, labels.filter(F.col("toxic") == y), "toxic", usable, sample_rows) for y in (0, 1)]
    sample = staged(both[0].unionByName(both[1]).select("doc_id", "y", "text", F.monotonically_increasing_id().alias("number")), "toxicity-sample")
    keys = sample.select("number", "doc_id", "y", F.xxhash64("text").alias("h")).collect()
    keys.sort(key=lambda r: (r.doc_id, r.y, r.h))
    place = {r.number: i for i, r in enumerate(keys)}
    y = np.array([r.y for r in keys], np.float64)

    def choose(net: Network | None) -> list[bytes | None]:
        parts: list[bytes | None] = [None] * len(keys)
        for r in sample.mapInArrow(_chosen_windows(net), "number long, part binary").collect():
            parts[place[r.number]] = None if r.part is None else bytes(r.part)
        return parts

    net = fit(y, choose)
    if len(y) and y.min() < y.max():
        counts = labels.filter(usable).agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
        net.shift = float(np.log(counts[0] / counts[1]) - np.log(y.sum() / (len(y) - y.sum())))
        net.prior += net.shift
    return net


def score(docs: DataFrame, net: Network) -> DataFrame:
    """Add ``score, predicted`` to every row; columns of these names are replaced.

    Texts are read whole, all windows of them. Null counts as empty; a text without words has the prior's score.
    Repeated rows are scored each.
    """
    docs = docs.drop("score", "predicted")
    held, names = docs.sparkSession.sparkContext.broadcast(net), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for row, data, offsets in buffers.slices(batch.column("text")):
                out[row : row + len(offsets) - 1] = held.value.scores(data, offsets)
            columns = dict(zip(batch.schema.names, batch.columns))
            yield pa.RecordBatch.from_pydict({c: columns[c] for c in names} | {"score": pa.array(out)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, score double").withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; a null id is not held out."""
    held_out = F.coalesce(id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")
