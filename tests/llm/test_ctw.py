import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from txrisk.llm import buffers, ctw, queries


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", fold(text))


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


class Tree:
    """Context-tree weighting by its definition, with explicit nodes; where the tree ends the deepest node decides."""

    def __init__(self, depth):
        self.depth, self.counts = depth, collections.Counter()

    def bits(self, data):
        padded = bytes(self.depth) + data
        for i, byte in enumerate(data):
            context = padded[i : i + self.depth]
            for b in range(8):
                yield context, (byte | 256) >> (8 - b), (byte >> (7 - b)) & 1

    def learn(self, data):
        for context, node, bit in self.bits(data):
            for d in range(self.depth + 1):
                self.counts[context[self.depth - d :], node, bit] += 1

    def log_kt(self, suffix, node):
        a, b = (self.counts[suffix, node, bit] for bit in (0, 1))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def log_below(self, suffix, node):
        children = {k[0] for k in list(self.counts) if k[1] == node and len(k[0]) == len(suffix) + 1 and k[0].endswith(suffix) and self.counts[k]}
        return sum(self.log_weighted(child, node) for child in children)

    def log_weighted(self, suffix, node):
        own = self.log_kt(suffix, node)
        return own if len(suffix) == self.depth else math.log(0.5) + np.logaddexp(own, self.log_below(suffix, node))

    def one(self, context, node, d=0):
        """Probability of a one at the node of the last d bytes, None if the node has no counts."""
        suffix = context[self.depth - d :]
        a, b = (self.counts[suffix, node, bit] for bit in (1, 0))
        if a + b == 0:
            return None
        own = (a + 0.5) / (a + b + 1)
        deeper = self.one(context, node, d + 1) if d < self.depth else None
        if deeper is None:
            return own
        w = math.exp(math.log(0.5) + self.log_kt(suffix, node) - self.log_weighted(suffix, node))
        return w * own + (1 - w) * deeper

    def log10(self, data):
        total = 0.0
        for context, node, bit in self.bits(data):
            one = self.one(context, node)
            one = 0.5 if one is None else one
            total += math.log10(one if bit else 1 - one)
        return total


def small_score(spark, train, asked, depth):
    """Model scores by ``lm_report`` of the texts asked, none of which is learned from."""
    ids = iter(range(10**6))
    rows = [(next(i for i in ids if not is_held_out(i)), t) for t in train] + [(next(i for i in ids if is_held_out(i)), t) for t in asked]
    got = {r.doc_id: r.score for r in ctw.lm_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), depth, block_bytes=16, region_bytes=8).collect()}
    return [got[i] for i, _ in rows[len(train) :]]


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_costs_are_those_of_the_definition(spark, depth):
    train = ["abracadabra", "abracé", "banana", "", "a", "the cat sat on the mat"]
    asked = ["abra", "é", "zz", "banana", "\0a", "", "the mat sat"]
    tree = Tree(depth)
    for t in train:
        tree.learn(t.encode() + b"\xff")
    for found, text in zip(small_score(spark, train, asked, depth), asked):
        assert found == pytest.approx(tree.log10(text.encode() + b"\xff"), rel=1e-5, abs=1e-6), text


def model(data, depth):
    """All levels, from the grams of texts, without Spark."""
    column = pa.array(data)
    keys, n = np.unique(ctw.gram_keys(*buffers.text_bytes(column), depth)[0], return_counts=True)
    return keys, ctw.mixed(ctw.grow(*ctw.leaves(keys, n), None, depth, 0)[0])


def test_probabilities_of_a_byte_or_the_end_sum_to_one():
    _, levels = model(["the cat sat on the mat", "", "a hat"], 3)
    for context in (b"the", b"at ", b"mat", b"zzz", b"\0\0\0"):
        grams = np.array([(int.from_bytes(context[::-1], "big") << 8) | b for b in range(256)], np.int64)
        assert (10.0 ** ctw.evaluate(grams, levels, 3)).sum() == pytest.approx(1)


def test_no_node_is_dropped():
    texts = [f"{i * i} of {i}" for i in range(500)]
    keys, levels = model(texts, 5)
    for d, (node, *_) in enumerate(levels):
        want = {(int(k) >> 8 >> 8 * (5 - d), (int(k) & 255 | 256) >> (8 - bit)) for k in keys for bit in range(8)}
        assert len(node) == len(want) and {(int(v) >> 9, int(v) & 511) for v in node} == want


def test_packed_numbers():
    for values in ([], [0], [5, 5, 7, 2**40], [2**64 - 1], [9, 3, 1]):
        assert ctw.unpack(ctw.pack(np.array(values, np.uint64))).tolist() == values


def test_any_cut_into_blocks_and_regions_gives_the_same(spark):
    rows = [(i if i % 9 else None, f"row {i} " * (i % 7)) for i in range(60)] + [(3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)

    def report(**sizes):
        return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 3)) for r in ctw.lm_report(df, **sizes).collect())

    assert report() == report(block_bytes=50, region_bytes=100) and len(report()) == len(rows)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 7.9, 8, 100.5, 1e9])
    assert ctw._log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-11)


def check_base(rows, got):
    train = collections.Counter()
    for i, t in rows:
        if not is_held_out(i):
            train.update([*words(t), None])
    n, v = sum(train.values()), len(train)

    def row(i, t):
        tokens = [*words(t), None]
        base = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        return str(i), is_held_out(i), len(tokens), sum(train[w] > 0 for w in tokens), n, round(base, 6)

    assert sorted(row(*r) for r in rows) == sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)


def test_edge_cases(spark):
    rows = [(1, "A b a"), (2, None), (3, ""), (4, " \n"), (None, "x y"), (5, "unseen é"), (5, "unseen é"), (9, "b " * 3000)]
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], "doc_id long, text string, block int, score int").repartition(3)
    got = ctw.lm_report(df).collect()
    check_base(rows, got)
    assert all(r.score < 0 for r in got)  # every text pays for its end
    assert ctw.lm_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_whole_table(spark, tiny):
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op6_ctw"](spark, tiny).collect()
    check_base(rows, got)
    held = [r for r in got if r.held_out]
    # A table this small knows few contexts; the bits per byte must still beat those of single bytes.
    size = {i: len((t or "").encode()) for i, t in rows}
    assert -sum(r.score for r in held) / math.log10(2) < 3.0 * sum(size[r.doc_id] for r in held)
