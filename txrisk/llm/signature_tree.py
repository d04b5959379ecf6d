"""N-gram Jaccard join by signature trees.

A tree's nodes hold the OR of their members' token bitmaps, their size range, and how many tokens share a bit at most.
Two trees, or one with itself, are traversed together. A pair of nodes is left as soon as no two of
their members can overlap enough; pairs of leaves compare bitmaps, then the sets themselves. All links are found,
whether or not other links connect their ends already, and counted by member where they are found.

Trees are built over routed groups, since one tree over everything would be one task. The routing loses nothing: if
two sets differ in at most d tokens, and tokens are dealt into more than d parts by a hash, the
two agree in at least one part. So each set sends the hash of every part, for its class of sizes and those in reach, and
sets that agree in any part belong to one group. Tokens that many sets have, those of lines and passages that many documents
share, are not dealt out: what is left of two sets differs no more than the sets do, and agrees by chance far less. Only
sets that are left with too few tokens also send parts of all. How common a token is comes from a bounded sample of the
texts; a poor sample costs comparisons, never a link. The larger the table, the poorer the sample, and what it misses draws unlike
texts into one group: groups too large for a tree are routed again, by a sample of their own texts.

Hashes that only one set sends, which is nearly all, end where they meet. Parts meet by 40 bits of hash and their bucket (meeting
by chance costs a comparison), shingles are compared by 64 bits, whole sets by 128 bits and their size.

Texts are shuffled where a step needs them together, and no others: of equal sets one text sends parts, only texts of
groups are joined, and only documents that may have to go are looked up. A table of marks, of a bounded size, tells which; where
marks fall together, a text too many is sent. Shuffled texts and parts go as soon as the step is written.
"""

from __future__ import annotations

import gc
import itertools
import math
from collections.abc import Callable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from txrisk.llm import buffers
from txrisk.llm.common import shuffle_width, staged
from txrisk.llm.components import components, stars

WORDS = 3
NUMERATOR, DENOMINATOR = 90, 100  # sets link at this Jaccard likeness or more
BITMAP = 4096  # bits
LEAF, FANOUT = 16, 8
_HELD_KEYS = 400_000  # part hashes that a task holds before it sends them on
_HELD_LINKS = 100_000  # links likewise
_WHOLE = ["n_shingles", "f1", "f2"]  # what tells whether sets are equal
# A row of part hashes has 40 bits of each, less those that its bucket tells, and the steps from id to id, as wide as its kind.
_STEPS = {2: np.dtype("u1"), 3: np.dtype("<u2"), 4: np.dtype("<u4"), 5: np.dtype("<u8")}
MARK_WORDS = 1 << 20  # in a table of marks at most, 64 marks each
GROUP_SHINGLES = 2_000_000  # in one tree; a larger group is dealt into several, and each pair of these is joined
RARE = 0.7  # share of a set's tokens that is expected to be rare
SAMPLE_SHINGLES = 20_000_000  # about as many, of different texts, tell how common shingles are
LOT_SHINGLES = 100_000_000  # texts that groups join at a time, or as many as the whole table's if that has more
_SIGNATURES = "kind int, doc_id long, bucket long, other long, keys binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, sorted, and the rows' offsets; fewer words than that are one shingle."""
    n = len(offsets) - 1
    hashes, rows = buffers.words(data, offsets)
    bounds = buffers.row_bounds(rows, n)
    count = np.diff(bounds)
    shingles = np.zeros(len(hashes), np.uint64)
    for k in range(words):
        shifted = np.zeros(len(hashes), np.uint64)
        shifted[: len(hashes) - k] = hashes[k:]
        inside = np.arange(len(hashes)) + k < bounds[rows + 1]
        shingles = buffers.mix(shingles * np.uint64(3) + np.where(inside, shifted, np.uint64(k)))
    position = np.arange(len(hashes)) - bounds[rows]
    keep = (position == 0) | (position <= count[rows] - words)
    shingles, rows = shingles[keep], rows[keep]
    order = np.lexsort((shingles, rows))
    shingles, rows = shingles[order], rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (shingles[1:] != shingles[:-1])
    return shingles[new], buffers.row_bounds(rows[new], n)


_NONE = np.zeros(0, np.uint64)


@cache
def _classes(numerator: int, denominator: int) -> tuple[np.ndarray, ...]:
    """Least size of each size class; the parts that its sets are dealt into and how many of them may be empty; the same for rare tokens.

    Pairs of a class differ in at most d tokens. Dealt into d + 1 + s parts, two sets agree in at least s + 1: unless
    both have more than s empty parts, they agree in one that is not empty, so empty parts, which
    agree by chance, need not be sent. Each s makes more than s empty parts unlikely for the class's smallest sets.
    """
    least, parts, spare, rare_parts, rare_spare = [1], [], [], [], []
    while least[-1] < 1 << 40:
        least.append(max(least[-1] + 1, least[-1] * 6 // 5))
        # |A| + |B| - 2 o, with o >= (|A| + |B|) j / (1 + j)
        d = 2 * (least[-1] - 1) * (denominator - numerator) // (denominator + numerator)
        smallest = least[-2] * numerator / denominator
        for tokens, n_parts, n_spare in ((smallest, parts, spare), (RARE * smallest, rare_parts, rare_spare)):
            s = 0
            for _ in range(60):
                mean = (d + 1 + s) * math.exp(-tokens / (d + 1 + s))
                more = min(d, int(mean + 4 * math.sqrt(mean)))
                if more <= s:
                    break
                s = more
            n_parts.append(d + 1 + s)
            n_spare.append(s)
    return tuple(map(np.array, (least[:-1], parts, spare, rare_parts, rare_spare)))


def _parts_of(token: np.ndarray, deal: np.ndarray, row: np.ndarray, n_parts: np.ndarray):
    """Row, number, sum of tokens and fullness of every part of every row, and how many parts of each row are empty."""
    base = np.cumsum(n_parts) - n_parts
    slot = base[row] + (deal % n_parts[row].astype(np.uint64)).astype(np.int64)
    sums = np.zeros(n_parts.sum(), np.uint64)
    np.add.at(sums, slot, token)
    owner = np.repeat(np.arange(len(n_parts)), n_parts)
    full = np.zeros(len(sums), bool)
    full[slot] = True
    return owner, np.arange(len(sums)) - base[owner], sums, full, n_parts - np.bincount(owner[full], minlength=len(n_parts))


def part_keys(shingles: np.ndarray, bounds: np.ndarray, numerator: int, denominator: int, common: np.ndarray = _NONE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every part of every set, and its row; ``common`` are the sorted shingles that many sets have.

    A set also sends the parts of every class above its own whose least size it can link with, so that it meets a
    larger set in that set's class. At 0.9 this is the next class at most, at 0.8 the one after it too. Parts of rare tokens
    are sent where they are not empty; sets with more empty ones than they may have send parts of all their tokens as well.
    """
    least, parts, spare, rare_parts, rare_spare = _classes(numerator, denominator)
    size = np.diff(bounds)
    own = np.searchsorted(least, size, "right") - 1
    keys, owners = [], []
    token, deal = buffers.mix(shingles), buffers.mix(shingles + np.uint64(0x5851F42D4C957F2D))
    row = np.repeat(np.arange(len(size)), size)
    rare = np.ones(len(token), bool)
    if len(common):
        rare = common[np.minimum(np.searchsorted(common, shingles), len(common) - 1)] != shingles

    def send(owner, part, sums, kind, tag):
        keys.append(buffers.mix(sums + buffers.mix(((kind[owner] << 40) | part).astype(np.uint64) ^ np.uint64(tag << 62))))
        owners.append(owner)

    for extra in itertools.count():
        kind = own + extra
        sent = size > 0
        if extra:
            sent &= size * denominator >= numerator * least[kind]
        if not sent.any():
            break
        kind = np.maximum(kind, 0)
        if len(common):
            mine = sent[row] & rare
            owner, part, sums, full, empty = _parts_of(token[mine], deal[mine], row[mine], np.where(sent, rare_parts[kind], 0))
            send(owner[full], part[full], sums[full], kind, 1)
            sent &= empty > rare_spare[kind]
        mine = sent[row]
        owner, part, sums, full, empty = _parts_of(token[mine], deal[mine], row[mine], np.where(sent, parts[kind], 0))
        full |= (empty > spare[kind])[owner]
        send(owner[full], part[full], sums[full], kind, 0)
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def _links(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their least id, and distinct pairs (id, least id) of keys that several ids share."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    head = ids[first][np.cumsum(first) - 1]
    other = ids != head
    pairs = np.unique(np.stack([ids[other], head[other]], axis=1), axis=0) if other.any() else np.zeros((0, 2), np.int64)
    return keys[first], ids[first], pairs


def _rows(kind: int | np.ndarray, count: int, **columns) -> pa.RecordBatch:
    out = {}
    for f in _SIGNATURES.split(", "):
        name, t = f.split()
        t = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[t]
        out[name] = pa.array(np.broadcast_to(kind, count).astype(np.int32)) if name == "kind" else pa.array(columns[name], t) if name in columns else pa.nulls(count, t)
    return pa.RecordBatch.from_pydict(out)


def _set_keys(words: int):
    """Size and hash of every set, and its text's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in buffers.slices(batch.column("text")):
                shingles, bounds = shingle_sets(data, offsets, words)
                n = len(bounds) - 1
                full = np.diff(bounds) > 0
                f1, f2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                if full.any():
                    f1[full] = np.add.reduceat(buffers.mix(shingles), bounds[:-1][full])
                    f2[full] = np.add.reduceat(buffers.mix(shingles ^ np.uint64(0xD6E8FEB86659FD93)), bounds[:-1][full])
                columns = (np.diff(bounds), f1.view(np.int64), f2.view(np.int64))
                given = [batch.column(c).slice(row, n) for c in ("doc_id", "text_hash")]
                yield pa.RecordBatch.from_arrays([*given, *map(pa.array, columns)], ["doc_id", "text_hash", "n_shingles", "f1", "f2"])

    return run


def _shingle_rows(words: int):
    """The distinct shingles of every text, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in buffers.slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(data, offsets, words)[0].view(np.int64))], ["shingle"])

    return run


def _share(total: int) -> int:
    """One of so many texts is in the sample, of texts that have ``total`` shingles."""
    return 1 + total // SAMPLE_SHINGLES


def _common(docs: DataFrame, total: int, words: int) -> np.ndarray:
    """Shingles that two texts or more of a sample have, sorted. The sample is bounded, and so is what is collected here.

    ``total`` are the shingles of all different sets.
    """
    # Equal texts are in the sample together, and count once.
    sample = docs.filter(F.pmod("text_hash", F.lit(_share(total))) == 0).dropDuplicates(["text_hash"]).select("text")
    counted = sample.mapInArrow(_shingle_rows(words), "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1").select("shingle").toArrow()
    return np.sort(counted.column("shingle").to_numpy().view(np.uint64))


def _signatures(buckets: int, words: int, numerator: int, denominator: int, common):
    """Kind 1: candidate pairs within a run of rows. Other kinds (see ``_STEPS``): part hashes by bucket. ``common`` is a broadcast variable."""

    def part_rows(keys: list[np.ndarray], owners: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, owner, pairs = _links(np.concatenate(keys), np.concatenate(owners))
        yield _rows(1, len(pairs), bucket=pairs[:, 0] % buckets, doc_id=pairs[:, 0], other=pairs[:, 1])
        bucket, rest = (key % np.uint64(buckets)).astype(np.int64), key // np.uint64(buckets)
        order = np.lexsort((owner, bucket))
        bucket, rest, owner = bucket[order], rest[order], owner[order]
        present, start = np.unique(bucket, return_index=True)
        stop = np.append(start[1:], len(order))
        step = np.zeros(len(order), np.uint64)
        step[1:] = owner.view(np.uint64)[1:] - owner.view(np.uint64)[:-1]
        step[start] = 0
        most = np.maximum.reduceat(step, start)
        kind = 2 + sum((most > np.iinfo(t).max).astype(int) for t in list(_STEPS.values())[:-1])
        low, high = (rest & np.uint64(0xFFFFFFFF)).astype("<u4"), ((rest >> np.uint64(32)) & np.uint64(0xFF)).astype("u1")
        steps = {k: step.astype(t) for k, t in _STEPS.items() if (kind == k).any()}
        packed = [b"".join(x[a:b].tobytes() for x in (low, high, steps[k])) for k, a, b in zip(kind.tolist(), start, stop)]
        yield _rows(kind, len(present), bucket=present, doc_id=owner[start], keys=packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, held = [], [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            known = ~batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            for row, data, offsets in buffers.slices(batch.column("text")):
                shingles, bounds = shingle_sets(data, offsets, words)
                key, owner = part_keys(shingles, bounds, numerator, denominator, common.value)
                mine = known[row + owner]
                keys.append(key[mine])
                owners.append(ids[row + owner[mine]].astype(np.int64))
                held += len(keys[-1])
                if held > _HELD_KEYS:
                    yield from part_rows(keys, owners)
                    keys, owners, held = [], [], 0
        if held:
            yield from part_rows(keys, owners)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of the part hashes that met in a bucket; buckets come one after another."""
    held, current = [], None

    def pairs_of(held):
        keys, ids = (np.concatenate(x) for x in zip(*held))
        _, _, pairs = _links(keys, ids)
        return pa.RecordBatch.from_pydict({"u": pa.array(pairs[:, 0]), "v": pa.array(pairs[:, 1])})

    for batch in batches:
        kinds, buckets, base = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "bucket", "doc_id"))
        found = pa.array(kinds == 1)
        if (kinds == 1).any():
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").filter(found), batch.column("other").filter(found)], ["u", "v"])
        packed = batch.column("keys")
        for i in np.flatnonzero(kinds > 1).tolist():
            if buckets[i] != current and held:
                yield pairs_of(held)
                held = []
            current = buckets[i]
            part, t = packed[i].as_buffer(), _STEPS[int(kinds[i])]
            n = len(part) // (5 + t.itemsize)
            low, high, step = np.frombuffer(part, "<u4", n), np.frombuffer(part, "u1", n, 4 * n), np.frombuffer(part, t, n, 5 * n)
            ids = np.cumsum(step, dtype=np.uint64).view(np.int64) + np.int64(base[i])
            held.append((low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32)), ids))
    if held:
        yield pairs_of(held)


class SignatureTree:
    """Sets in an order that keeps like ones near, with levels of nodes over runs of them."""

    def __init__(self, sets: list[np.ndarray], numerator: int = NUMERATOR, denominator: int = DENOMINATOR):
        self.numerator, self.denominator = numerator, denominator
        self.order = np.array(sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), len(sets[i]))))
        self.sets = [sets[i] for i in self.order]
        size = np.array([len(s) for s in self.sets])
        words = np.zeros((len(sets), BITMAP // 64), np.uint64)
        for i, s in enumerate(self.sets):
            bit = s & np.uint64(BITMAP - 1)
            np.bitwise_or.at(words[i], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        slack = size - np.bitwise_count(words).sum(axis=1).astype(int)
        # Of each level: bitmap, least and largest size, largest slack, first and last-but-one member.
        self.levels = [(words, size, size, slack, np.arange(len(sets)), np.arange(1, len(sets) + 1))]
        width = LEAF
        while len(self.levels[-1][1]) > 1:
            w, low, high, most, start, stop = self.levels[-1]
            at = np.arange(0, len(low), width)
            last = np.append(at[1:], len(low)) - 1
            self.levels.append(
                (
                    np.bitwise_or.reduceat(w, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(most, at),
                    start[at],
                    stop[last],
                )
            )
            width = FANOUT

    def children(self, level: int, node: int) -> np.ndarray:
        width = LEAF if level == 1 else FANOUT
        return np.arange(node * width, min((node + 1) * width, len(self.levels[level - 1][1])))

    def possible(self, other: SignatureTree, level: int, a: np.ndarray, other_level: int, b: np.ndarray) -> np.ndarray:
        """Which pairs of nodes may hold a pair of members that overlaps enough."""
        words, low, high, slack, *_ = self.levels[level]
        words2, low2, high2, slack2, *_ = other.levels[other_level]
        j, d = self.numerator, self.denominator
        fits = (high[a][:, None] * d >= j * low2[b][None, :]) & (high2[b][None, :] * d >= j * low[a][:, None])
        shared = np.zeros((len(a), len(b)), np.int64)
        for i in range(len(a)):
            shared[i] = np.bitwise_count(words[a[i]] & words2[b]).sum(axis=1)
        most = shared + np.minimum(slack[a][:, None], slack2[b][None, :])
        most = np.minimum(most, np.minimum(high[a][:, None], high2[b][None, :]))
        return fits & (most * (j + d) >= j * (low[a][:, None] + low2[b][None, :]))

    def linked(self, a: np.ndarray, other: SignatureTree, b: np.ndarray, fits: np.ndarray) -> np.ndarray:
        """Pairs of members of ``a`` and ``b`` that link, of those that ``fits``; each side's shingles are gone through once."""
        i, k = fits.any(axis=1), fits.any(axis=0)
        a, b, fits = a[i], b[k], fits[np.ix_(i, k)]
        size_a, size_b = (np.array([len(t.sets[m]) for m in x]) for t, x in ((self, a), (other, b)))
        tokens, place = np.unique(np.concatenate([other.sets[m] for m in b]), return_inverse=True)
        has = np.zeros((len(tokens), len(b)), np.int32)
        has[place, np.repeat(np.arange(len(b)), size_b)] = 1
        common = np.zeros((len(a), len(b)), np.int64)
        for row, m in enumerate(a):
            at = np.minimum(np.searchsorted(tokens, self.sets[m]), len(tokens) - 1)
            common[row] = has[at[tokens[at] == self.sets[m]]].sum(axis=0)
        union = size_a[:, None] + size_b[None, :] - common
        found = np.argwhere(fits & (self.denominator * common >= self.numerator * union))
        return np.stack([a[found[:, 0]], b[found[:, 1]]], axis=1)


def tree_join(left: SignatureTree, right: SignatureTree | None = None) -> Iterator[np.ndarray]:
    """All links as rows of ``(left member, right member)``, each once; of the tree with itself without ``right``.

    Leaves are compared a run of members with another at a time; a run's links are yielded together.
    """
    own = right is None
    right = left if own else right
    top = len(left.levels) - 1, len(right.levels) - 1
    stack = [(top[0], 0, top[1], 0)] if left.sets and right.sets else []
    while stack:
        la, a, lb, b = stack.pop()
        na, nla = (left.children(la, a), la - 1) if la and la >= lb else (np.array([a]), la)
        nb, nlb = (right.children(lb, b), lb - 1) if lb and lb >= la else (np.array([b]), lb)
        fits = left.possible(right, nla, na, nlb, nb)
        diagonal = own and nla == nlb
        if diagonal:
            # A node with itself is taken apart further, a member is not linked with itself.
            fits &= na[:, None] < nb[None, :] if nla == 0 else na[:, None] <= nb[None, :]
        if not fits.any():
            continue
        if nla == 0 and nlb == 0:
            found = left.linked(na, right, nb, fits)
            if len(found):
                yield np.stack([left.order[found[:, 0]], right.order[found[:, 1]]], axis=1)
        else:
            stack += [(nla, int(na[i]), nlb, int(nb[k])) for i, k in np.argwhere(fits)]


def _sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    out = []
    for _, data, offsets in buffers.slices(texts):
        shingles, bounds = shingle_sets(data, offsets, words)
        out += [shingles[a:b] for a, b in zip(bounds, bounds[1:])]
    return out


def _links_of_group(table: pa.Table, words: int, numerator: int, denominator: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All links between the rows of a pair of trees, or of one, as row numbers, some 100,000 at a time.

    Links of like texts grow with the square of their number, so they are handed on while they are found.
    """
    chunk = table.column("chunk").to_numpy()
    sets = _sets(table.column("text"), words)
    low, high = int(table.column("a")[0].as_py()), int(table.column("b")[0].as_py())
    left = np.flatnonzero(chunk == low)
    tree = SignatureTree([sets[i] for i in left], numerator, denominator)
    right, second = left, None
    if low != high:
        right = np.flatnonzero(chunk == high)
        second = SignatureTree([sets[i] for i in right], numerator, denominator)
    held, n = [], 0
    for found in tree_join(tree, second):
        held.append(found)
        n += len(found)
        if n >= _HELD_LINKS:
            found = np.concatenate(held)
            yield left[found[:, 0]], right[found[:, 1]]
            held, n = [], 0
    if held:
        found = np.concatenate(held)
        yield left[found[:, 0]], right[found[:, 1]]


def _classes_of(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    """The rows of a group, one for each class: equal rows of the input bring its text more than once."""
    table = pa.Table.from_batches(batches)
    _, first = np.unique(np.stack([table.column(c).to_numpy() for c in _WHOLE]), axis=1, return_index=True)
    kept = np.zeros(table.num_rows, bool)
    kept[first] = True
    return table.filter(pa.array(kept))


def _join_group(words: int, numerator: int, denominator: int):
    """Every link of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _classes_of(batches)
        ids = table.column("doc_id").to_numpy()
        for a, b in _links_of_group(table, words, numerator, denominator):
            yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["u", "v"])

    return run


def _count_group(words: int, numerator: int, denominator: int):
    """Every class of a group that has links there: with how many rows, and the least id that the group's links lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _classes_of(batches)
        ids, n_rows = table.column("doc_id").to_numpy(), table.column("n_rows").to_numpy()
        count = np.zeros(len(ids), np.int64)
        u = v = np.zeros(0, np.int64)
        for a, b in _links_of_group(table, words, numerator, denominator):
            np.add.at(count, a, n_rows[b])
            np.add.at(count, b, n_rows[a])
            u, v = stars(np.concatenate([u, ids[a]]), np.concatenate([v, ids[b]]))
        linked = np.flatnonzero(count)
        if not len(linked):
            return
        least = ids.copy()
        if len(u):
            at = np.minimum(np.searchsorted(u, ids), len(u) - 1)
            least = np.where(u[at] == ids, v[at], ids)
        columns = {"u": ids[linked], "v": least[linked], "n": count[linked]}
        columns |= {c: table.column(c).to_numpy()[linked] for c in _WHOLE}
        yield pa.RecordBatch.from_pydict({c: pa.array(x, pa.int64()) for c, x in columns.items()})

    return run


def _forget(spark: SparkSession) -> None:
    """Shuffle files of frames that nobody holds any more go now, not when the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _with_mark(rows: DataFrame, words: int, key: list) -> DataFrame:
    mark = F.pmod(F.xxhash64(*key), F.lit(64 * words))
    return rows.withColumn("__mark", mark).withColumn("__word", F.expr("shiftright(__mark, 6)"))


def marked(keys: DataFrame, *columns: str) -> Callable[..., DataFrame]:
    """A filter ``pick(rows, *key, hit=True)``: rows whose key may be among ``keys``, or, not ``hit``, the others, which certainly are not.

    A key is one mark of a table that is broadcast: up to half a million keys have 128 marks each, more share ``MARK_WORDS`` words.
    """
    words = max(1, min(MARK_WORDS, 2 * keys.count()))
    table = _with_mark(keys, words, list(columns)).groupBy("__word").agg(F.expr("bit_or(shiftleft(1L, cast(__mark & 63 as int)))").alias("__marks"))

    def pick(rows: DataFrame, *key, hit: bool = True) -> DataFrame:
        found = _with_mark(rows, words, list(key)).join(F.broadcast(table), "__word", "left")
        return found.filter(F.expr("coalesce(bit_get(__marks, cast(__mark & 63 as int)), 0)") == int(hit)).drop("__mark", "__word", "__marks")

    return pick


def _route(docs: DataFrame, total: int, words: int, numerator: int, denominator: int, linked: DataFrame | None = None) -> DataFrame:
    """``node, component`` of the ids whose sets agree in a part, or that ``linked`` connects; others have none."""
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(_common(docs, total, words))
    near = (
        docs.mapInArrow(_signatures(4 * shuffle_width(spark), words, numerator, denominator, common), _SIGNATURES)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_meet, "u long, v long")
        .distinct()
    )
    routed = components(near.unionByName(linked) if linked else near)
    common.unpersist()
    return routed


def _groups(docs: DataFrame, words: int, numerator: int, denominator: int, group_shingles: int) -> tuple[DataFrame, DataFrame, DataFrame, list[GroupedData]]:
    """Every row with its set; every class of equal sets with its least id and its rows; edges from copies to that id; texts to join.

    Null ids, and sets without shingles, are in no class. The texts come in several lots if a large group's, which each of its
    trees meets again, are more than all texts of the table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    spark = docs.sparkSession
    sizes = staged(docs.mapInArrow(_set_keys(words), "doc_id long, text_hash long, n_shingles long, f1 long, f2 long"), "sets")
    full = sizes.filter("n_shingles > 0 and doc_id is not null")
    # Of equal sets one row stands for all: a text of the least id.
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    reps = staged(full.groupBy(*_WHOLE).agg(first, F.count("*").alias("n_rows")).select("first.doc_id", "first.text_hash", *_WHOLE, "n_rows"), "classes")
    same = full.join(reps.select(*_WHOLE, F.col("doc_id").alias("rep")), _WHOLE)
    copies = staged(same.filter("doc_id != rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v")).distinct(), "copies")
    row = ["doc_id", "text_hash"]
    weighed = F.sum("n_shingles")
    total, shingles = reps.agg(weighed).first()[0] or 0, full.agg(weighed).first()[0] or 0
    # Copies send no parts: they have those of the row that stands for them.
    own = marked(reps, *row)(docs.filter("doc_id is not null"), *row)
    routed = _route(own, total, words, numerator, denominator, copies)
    kept = [*row, *_WHOLE, "n_rows", "component"]
    members = staged(reps.join(routed, reps["doc_id"] == routed["node"]).select(*kept), "members")
    _forget(spark)

    # A set's bitmap weighs as much as some hundred shingles.
    chunks = F.ceil((F.col("total") + F.col("k") * (BITMAP // 64)) / F.lit(group_shingles)).cast("int")

    def sized(members: DataFrame) -> DataFrame:
        groups = members.groupBy("component").agg(F.count("*").alias("k"), weighed.alias("total")).filter("k > 1")
        return members.join(groups.withColumn("chunks", chunks).select("component", "chunks"), "component")

    # What the sample misses makes groups too large. Their own texts are fewer, so that a sample of these misses less.
    share = _share(total)
    while share > 1:
        large = sized(members).filter("chunks > 1").select(*kept)
        total = large.agg(weighed).first()[0] or 0
        if not total or 2 * _share(total) > share:
            break
        share, large = _share(total), staged(large, "large-groups")
        texts = staged(marked(large, *row)(docs, *row).join(large.select(*row).distinct(), row, "left_semi"), "texts")
        _forget(spark)
        again = _route(texts, total, words, numerator, denominator).withColumnRenamed("component", "new")
        split = large.join(again, large["doc_id"] == again["node"], "left").withColumn("component", F.coalesce("new", "doc_id")).select(*kept)
        rest = members.join(large.select("component").distinct(), "component", "left_anti").select(*kept)
        members = staged(rest.unionByName(split), "members")
        _forget(spark)

    dealt = sized(members)
    sent = int(dealt.agg(F.sum(F.col("n_shingles") * F.col("chunks"))).first()[0] or 0)
    lots = max(1, math.ceil(sent / max(shingles, LOT_SHINGLES)))
    grouped = marked(dealt, *row)(docs, *row)
    dealt = (
        dealt.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(*row, *_WHOLE, "n_rows", "component", "chunk", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"))
        .withColumn("lot", F.pmod(F.xxhash64("component", "a", "b"), F.lit(lots)))
    )
    return sizes, reps, copies, [grouped.join(dealt.filter(F.col("lot") == lot).drop("lot"), row).groupBy("component", "a", "b") for lot in range(lots)]


def _joined(groups: list[GroupedData], join, schema: str) -> DataFrame:
    """What ``join`` finds in the groups, lot by lot, so that the texts of one are shuffled at a time."""
    found = []
    for texts in groups:
        found.append(staged(texts.applyInArrow(join, schema), "links"))
        _forget(found[-1].sparkSession)
    return reduce(DataFrame.unionByName, found)


def similar(docs: DataFrame, *, words: int = WORDS, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, group_shingles: int = GROUP_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, n_shingles)`` of every row, and links ``(u, v)`` between ids.

    Equal sets are a class, which its least id stands for. There is a link for every pair of classes that are alike enough, between the
    ids that stand for them, and one from every other member of a class to that id; pairs of equal sets are not
    expanded. Rows of one id are one node. Null ids, and sets without shingles, link with nothing. A group of near copies has a
    link for every pair of them; :func:`connected` counts these links where they are found.
    """
    sizes, _, copies, groups = _groups(docs, words, numerator, denominator, group_shingles)
    found = _joined(groups, _join_group(words, numerator, denominator), "u long, v long")
    return sizes.select("doc_id", "n_shingles"), found.unionByName(copies)


def connected(docs: DataFrame, *, words: int = WORDS, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, group_shingles: int = GROUP_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, n_shingles, n_links)`` of every row, and edges ``(u, v)`` that connect the ids that links connect.

    All links that :func:`similar` gives are found, but counted and contracted where they are found: what leaves
    a group is a row for each class. ``n_links`` are the other rows whose sets are alike enough or equal; null ids, and
    sets without shingles, have none and count for none.
    """
    sizes, reps, copies, groups = _groups(docs, words, numerator, denominator, group_shingles)
    found = _joined(groups, _count_group(words, numerator, denominator), "u long, v long, n long, n_shingles long, f1 long, f2 long")
    near = found.groupBy(*_WHOLE).agg(F.sum("n").alias("n"))
    classes = reps.join(near, _WHOLE, "left").select(*_WHOLE, (F.coalesce("n", F.lit(0)) + F.col("n_rows") - 1).alias("n_class"))
    n_links = F.when(F.col("doc_id").isNotNull(), F.coalesce("n_class", F.lit(0))).otherwise(0).cast("long")
    counted = sizes.join(classes.filter("n_class > 0"), _WHOLE, "left").select("doc_id", "n_shingles", n_links.alias("n_links"))
    return counted, found.filter("u != v").select("u", "v").unionByName(copies)


def join_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row.

    The component is the least id that links lead to, the row's own if it has none, null for a null id.
    """
    counted, edges = connected(docs)
    found = components(edges)
    return counted.join(found, counted["doc_id"] == found["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), "n_links"
    )


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The documents without those that a smaller id is connected to; same columns. Null ids stay.

    Rows that repeat an id stay or go together.
    """
    found = staged(components(connected(docs, **settings)[1]).filter("node != component").select(F.col("node").alias("__node")), "removed")
    _forget(docs.sparkSession)
    gone = F.col("doc_id") == F.col("__node")
    if found.count() <= MARK_WORDS:  # no more than a table of marks
        return docs.join(F.broadcast(found), gone, "left_anti")
    pick, key = marked(found, "__node"), F.col("doc_id").cast("long")
    return pick(docs, key, hit=False).unionByName(pick(docs, key).join(found, gone, "left_anti"))
