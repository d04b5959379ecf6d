"""LM scoring by context-tree weighting over bytes.

A byte is eight binary decisions, each in the tree of the bytes that came before it; byte 255, which UTF-8 never has, ends a
text. Every node of a tree has a Krichevsky-Trofimov estimate from its counts; the probability of the training data at a node is half
that estimate and half the product over its children, one byte deeper. Given the counts, the mixture over all depths of the next bit
follows from the nodes along the context: with weight w the node's own estimate, else what the deeper node says. Where the tree
ends, or training saw no more of a context, the deepest node's own estimate holds.

No node is dropped and no table of the corpus is sent to the workers. Texts are packed into blocks of bounded size, written once. A block
asks the regions of contexts for the costs of its distinct grams, and counts those of training texts. A region (contexts with the
same nearest three bytes belong to one) adds up the counts of all blocks, grows its part of the tree and hands the sums on to
the levels above; those have contexts of two bytes at most, so their size is bounded by the alphabet, and they are
weighted on the driver. Then each region prices each distinct gram once and answers every block in the order asked. The
unigram base asks for its words in the same way.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import buffers
from txrisk.llm.common import id_bucket, staged

DEPTH = 5  # bytes of context at most
FOLDS, HELD_OUT = 5, 1
BLOCK_BYTES = 8 << 20  # of text, or one longer text
REGION_BYTES = 16 << 20  # of text to a region
END = 255
_NEAR = 3  # bytes that decide the region of a context
_GRAMS, _WORDS = 0, 1
_HELD = 4_000_000  # counts of a region that wait to be added up
_PRICED = 1 << 18  # grams priced at once
_LOG2 = float(np.log(2))
_BLOCK = "block long, ids array<long>, held array<boolean>, lengths binary, text binary, n_bytes long, n_train long"
_GROWN = (
    "kind int, region int, block long, answer binary, n long, v long, keys binary, counts binary, "
    "blocks array<long>, asks array<binary>, node long, ones double, zeros double, below double"
)


def gram_keys(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Each byte, and an end for each row, below the ``depth`` bytes before it, the nearest highest; and the rows' offsets among them.

    Zero bytes stand before a row. Keys of contexts that end in the same bytes are neighbours in order.
    """
    rows, lengths = len(offsets) - 1, np.diff(offsets)
    start = offsets[:-1] + np.arange(rows) * (depth + 1) + depth
    padded = np.zeros(len(data) + rows * (depth + 1), np.uint8)
    used = np.ones(len(padded), bool)
    for back in range(1, depth + 1):
        used[start - back] = False
    ends = np.zeros(len(padded), bool)
    ends[start + lengths] = True
    padded[used & ~ends] = data
    padded[ends] = END
    keys = padded.astype(np.int64)
    for back in range(1, depth + 1):
        keys[back:] |= padded[:-back].astype(np.int64) << (8 * (depth - back + 1))
    return keys[used], offsets + np.arange(rows + 1)


def _log_kt(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma(ones + 0.5) + _log_gamma(zeros + 0.5) - np.log(np.pi) - _log_gamma(ones + zeros + 1)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, moved up by the recurrence to where it is exact to 1e-12."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed differences, byte by byte; small where they are sorted and dense."""
    steps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    return zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _summed(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    distinct, place = np.unique(key, return_inverse=True)
    return [distinct, *(np.bincount(place, v, len(distinct)) for v in values)]


# A node's number is its context, nearest byte highest, above nine bits: a one and the bits of the byte so far.


def _parent(node: np.ndarray) -> np.ndarray:
    return (node >> 17 << 9) | (node & 511)


def grow(node, ones, zeros, below, deepest: int, least: int):
    """``(node, estimate of a one, weight)`` of the levels from ``deepest`` up to ``least``, rising, and sums for the level above."""
    levels = []
    for d in range(deepest, least - 1, -1):
        own = _log_kt(ones, zeros)
        total = own if below is None else np.logaddexp(own, below) - _LOG2
        weight = np.ones(len(own)) if below is None else np.exp(np.minimum(own - _LOG2 - total, 0))
        levels.append((node, (ones + 0.5) / (ones + zeros + 1), weight))
        if d:
            node, ones, zeros, below = _summed(_parent(node), ones, zeros, total)
    return levels[::-1], (node, ones, zeros, below)


def leaves(keys: np.ndarray, n: np.ndarray):
    """The nodes of full depth, with counts of ones and zeros, of grams that occur ``n`` times."""
    context, byte = keys >> 8, keys & 255
    node = np.concatenate([(context << 9) | ((byte | 256) >> (8 - bit)) for bit in range(8)])
    is_one = np.concatenate([(byte >> (7 - bit)) & 1 for bit in range(8)])
    n = np.tile(n.astype(np.float64), 8)
    return _summed(node, n * is_one, n * (1 - is_one))


def mixed(levels, above=None):
    """For each level ``(node, one, a, b)``: the probability of a one if the level is the deepest known, else a + b times the next level's."""
    out = []
    for node, estimate, weight in levels:
        if above is None:
            a, b = np.zeros(len(node)), np.ones(len(node))
        else:
            at = np.searchsorted(above[0], _parent(node))
            a, b = above[2][at], above[3][at]
        above = node, a + b * estimate, a + b * weight * estimate, b * (1 - weight)
        out.append(above)
    return out


def evaluate(keys: np.ndarray, levels, depth: int) -> np.ndarray:
    """Log10 probability of the last byte of each gram, from all levels' ``mixed`` nodes."""
    byte, context, total = keys & 255, keys >> 8, np.zeros(len(keys))
    for bit in range(8):
        bits = (byte | 256) >> (8 - bit)
        one = np.full(len(keys), 0.5)
        for d, (node, known, *_) in enumerate(levels):
            if len(node):
                wanted = (context >> 8 * (depth - d) << 9) | bits
                at = np.minimum(np.searchsorted(node, wanted), len(node) - 1)
                one = np.where(node[at] == wanted, known[at], one)
        total += np.log10(np.where((byte >> (7 - bit)) & 1 == 1, one, 1 - one))
    return total


def _pack_blocks(block_bytes: int):
    """Rows of a task in blocks of at most this much text, or of one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, k = TaskContext.get().partitionId() << 32, 0
        ids, held, lengths, texts, size = [], [], [], [], 0

        def block():
            train = len(held) - sum(held)
            columns = (first + k, ids, held, np.concatenate(lengths).tobytes(), zlib.compress(b"".join(texts), 1), size, train)
            names = ("block", "ids", "held", "lengths", "text", "n_bytes", "n_train")
            types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(columns, types)], names)

        for batch in batches:
            keys, flags = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            for row, data, offsets in buffers.slices(batch.column("text"), min(buffers.SLICE_BYTES, block_bytes)):
                if ids and size + len(data) > block_bytes:
                    yield block()
                    ids, held, lengths, texts, size, k = [], [], [], [], 0, k + 1
                m = len(offsets) - 1
                ids += keys[row : row + m]
                held += flags[row : row + m]
                lengths.append(np.diff(offsets))
                texts.append(buffers.FOLD[data].tobytes())
                size += len(data)
        if ids:
            yield block()

    return run


def _slices(text: bytes, lengths: bytes):
    """``(first row, bytes, offsets)`` of runs of whole rows of a block."""
    data = np.frombuffer(zlib.decompress(text), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(lengths, np.int64))])
    row = 0
    while row < len(offsets) - 1:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + buffers.SLICE_BYTES, "right")) - 1)
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def _tokens(kind: int, data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams or word hashes of a slice, with their rows."""
    if kind == _WORDS:
        return buffers.words(data, offsets)
    keys, bounds = gram_keys(data, offsets, depth)
    return keys.astype(np.uint64), np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))


def _distinct(kind: int, text: bytes, lengths: bytes, depth: int):
    """The ascending distinct keys of a block, and for each slice: first row, rows, its own distinct keys, the place of each token among them, and its row."""
    parts = []
    for row, data, offsets in _slices(text, lengths):
        keys, rows = _tokens(kind, data, offsets, depth)
        own, place = np.unique(keys, return_inverse=True)
        parts.append((row, len(offsets) - 1, own, place.astype(np.int32), rows.astype(np.int32)))
    return np.unique(np.concatenate([p[2] for p in parts])), parts


def _region(kind: int, keys: np.ndarray, depth: int, regions: int) -> np.ndarray:
    near = keys if kind == _WORDS else buffers.mix(keys >> np.uint64(8 * (1 + depth - min(depth, _NEAR))))
    return (near % np.uint64(regions)).astype(np.int64)


def _dealt(kind: int, keys: np.ndarray, depth: int, regions: int):
    """``(region, places)`` of the ascending distinct keys of a block: what is asked, and in which order."""
    region = _region(kind, keys, depth, regions)
    order = np.argsort(region, kind="stable")
    present, start = np.unique(region[order], return_index=True)
    return [(int(r), order[i:j]) for r, i, j in zip(present, start, [*start[1:], len(order)])]


def _ask(depth: int, regions: int):
    """By region: the distinct grams and words of a block, with their number in its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, held, lengths, text in zip(*(batch.column(c).to_pylist() for c in ("block", "held", "lengths", "text"))):
                train = ~np.array(held, bool)
                for kind in (_GRAMS, _WORDS):
                    keys, parts = _distinct(kind, text, lengths, depth)
                    counts = np.zeros(len(keys))
                    for row, _, own, place, rows in parts:
                        counts[np.searchsorted(keys, own)] += np.bincount(place, train[row + rows], len(own))
                    del parts
                    dealt = _dealt(kind, keys, depth, regions)
                    m = len(dealt)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "kind": pa.array([kind] * m, pa.int32()),
                            "region": pa.array([r for r, _ in dealt], pa.int32()),
                            "block": pa.array([block] * m, pa.int64()),
                            "keys": pa.array([pack(keys[at]) for _, at in dealt], pa.binary()),
                            "counts": pa.array([pack(counts[at]) for _, at in dealt], pa.binary()),
                        }
                    )

    return run


def _rows(m: int, /, **columns) -> pa.Table:
    """Rows of ``_GROWN`` with these columns; the others are null."""
    types = {"kind": pa.int32(), "region": pa.int32(), "block": pa.int64(), "answer": pa.binary(), "n": pa.int64(), "v": pa.int64()}
    types |= {"keys": pa.binary(), "counts": pa.binary(), "blocks": pa.list_(pa.int64()), "asks": pa.list_(pa.binary())}
    types |= {"node": pa.int64(), "ones": pa.float64(), "zeros": pa.float64(), "below": pa.float64()}
    return pa.table({c: pa.array(columns[c], t) if c in columns else pa.nulls(m, t) for c, t in types.items()})


def _gather(depth: int):
    """Add up a region. Words are answered at once; of grams, the region's own row is kept, and sums for the levels above."""

    def run(table: pa.Table) -> pa.Table:
        kind, region = table.column("kind")[0].as_py(), table.column("region")[0].as_py()
        blocks, asks = table.column("block").to_pylist(), table.column("keys").to_pylist()
        keys, counts, held, size = np.zeros(0, np.uint64), np.zeros(0), [], 0
        for ask, n in zip(asks, table.column("counts").to_pylist()):
            held.append((unpack(ask), unpack(n).astype(np.int64).astype(np.float64)))
            size += len(held[-1][0])
            if size > _HELD:
                keys, counts = _summed(*(np.concatenate([a, *b]) for a, b in zip((keys, counts), zip(*held))))
                held, size = [], 0
        if held:
            keys, counts = _summed(*(np.concatenate([a, *b]) for a, b in zip((keys, counts), zip(*held))))
        if kind == _WORDS:
            answers = [zlib.compress(counts[np.searchsorted(keys, unpack(ask))].astype(np.int64).tobytes(), 1) for ask in asks]
            m = len(blocks)
            totals = {"n": [0] * m + [int(counts.sum())], "v": [0] * m + [int((counts > 0).sum())]}
            return _rows(m + 1, kind=[kind] * (m + 1), region=[region] * (m + 1), block=[*blocks, None], answer=[*answers, None], **totals)
        own = _rows(1, kind=[kind], region=[region], keys=[pack(keys)], counts=[pack(counts)], blocks=[blocks], asks=[asks])
        seen = counts > 0
        node, ones, zeros = leaves(keys[seen].astype(np.int64), counts[seen])
        _, (node, ones, zeros, below) = grow(node, ones, zeros, None, depth, min(depth, _NEAR))
        return pa.concat_tables([own, _rows(len(node), node=node, ones=ones, zeros=zeros, below=below)])

    return run


def _price(top, depth: int):
    """Answer every block that asked a region, from the region's part of the tree and the levels above it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = min(depth, _NEAR)
        for batch in batches:
            for region, keys, counts, blocks, asks in zip(*(batch.column(c).to_pylist() for c in ("region", "keys", "counts", "blocks", "asks"))):
                keys, seen = unpack(keys), unpack(counts).astype(np.int64)
                node, ones, zeros = leaves(keys[seen > 0].astype(np.int64), seen[seen > 0])
                levels = top.value + mixed(grow(node, ones, zeros, None, depth, near)[0], top.value[-1])
                cost = np.concatenate([evaluate(keys[i : i + _PRICED].astype(np.int64), levels, depth) for i in range(0, len(keys), _PRICED)])
                cost = cost.astype(np.float32)
                for block, ask in zip(blocks, asks):
                    answer = cost[np.searchsorted(keys, unpack(ask))].tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([_GRAMS], pa.int32()), pa.array([region], pa.int32()), pa.array([block], pa.int64()), pa.array([answer], pa.binary())],
                        ["kind", "region", "block", "answer"],
                    )

    return run


def top_levels(sums: DataFrame, depth: int):
    """The levels with contexts of fewer than three bytes: at most 255 nodes for each context, whatever the input."""
    table = sums.groupBy("node").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"), F.sum("below").alias("below")).toArrow().sort_by("node")
    numbers = (table.column(c).to_numpy() for c in ("node", "ones", "zeros", "below"))
    return mixed(grow(*numbers, min(depth, _NEAR) - 1, 0)[0])


def _report(depth: int, regions: int, n_train: int, vocabulary: int, ends: int):
    def run(key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        """One block, and what all regions answered it."""
        ids, held, lengths, text = (blocks.column(c)[0].as_py() for c in ("ids", "held", "lengths", "text"))
        parts = {r[:2]: r[2] for r in zip(*(answers.column(c).to_pylist() for c in ("kind", "region", "answer")))}
        m = len(ids)
        tokens, known, score = np.ones(m, np.int64), np.full(m, int(ends > 0)), np.zeros(m)
        denominator = np.log10(n_train + 0.5 * (vocabulary + 1))
        base = np.full(m, np.log10(ends + 0.5) - denominator)
        for kind in (_GRAMS, _WORDS):
            keys, slices = _distinct(kind, text, lengths, depth)
            values = np.zeros(len(keys))
            for region, at in _dealt(kind, keys, depth, regions):
                part = parts[kind, region]
                values[at] = np.frombuffer(part, np.float32) if kind == _GRAMS else np.frombuffer(zlib.decompress(part), np.int64)
            for row, k, own, place, rows in slices:
                value = values[np.searchsorted(keys, own)][place]
                if kind == _GRAMS:
                    score[row : row + k] += np.bincount(rows, value, k)
                else:
                    tokens[row : row + k] += np.bincount(rows, minlength=k)
                    known[row : row + k] += np.bincount(rows, value > 0, k).astype(np.int64)
                    base[row : row + k] += np.bincount(rows, np.log10(value + 0.5) - denominator, k)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "held_out": pa.array(held, pa.bool_()),
                "n_tokens": pa.array(tokens),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(m, n_train, np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(score),
            }
        )

    return run


def lm_report(docs: DataFrame, depth: int = DEPTH, *, block_bytes: int = BLOCK_BYTES, region_bytes: int = REGION_BYTES) -> DataFrame:
    """Base and model score of every row; texts of held-out ids are not learned from. ``depth`` is at least 1.

    Null texts are empty, and consist of one end, which both scores pay for. Rows without id are trained on.
    Repeated rows count each. Letters A-Z are folded for the base and for the model.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    blocks = staged(rows.mapInArrow(_pack_blocks(block_bytes), _BLOCK), "ctw-blocks")
    size, ends = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.coalesce(F.sum("n_train"), F.lit(0))).first()
    regions = size // region_bytes + 1
    asked = blocks.select("block", "held", "lengths", "text").mapInArrow(_ask(depth, regions), "kind int, region int, block long, keys binary, counts binary")
    gathered = staged(asked.groupBy("kind", "region").applyInArrow(_gather(depth), _GROWN), "ctw-regions")
    top = spark.sparkContext.broadcast(top_levels(gathered.filter("node is not null").select("node", "ones", "zeros", "below"), depth))
    n, vocabulary = gathered.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    answer = "kind int, region int, block long, answer binary"
    grams = gathered.filter(F.col("keys").isNotNull()).select("region", "keys", "counts", "blocks", "asks").mapInArrow(_price(top, depth), answer)
    answers = grams.unionByName(gathered.filter(F.col("answer").isNotNull()).select("kind", "region", "block", "answer"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return (
        blocks.select("block", "ids", "held", "lengths", "text")
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_report(depth, regions, n + ends, vocabulary + (ends > 0), ends), schema)
    )
