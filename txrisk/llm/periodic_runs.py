"""Periodic runs of words (maximal repetitions) by recompression, and texts with their repeats collapsed.

The words of a text are compressed in rounds into a run-length grammar: a round of blocks replaces every
maximal run of one symbol, a round of pairs replaces every pair of a left and a right symbol (a coin
per symbol and round says which it is). What is replaced depends on the symbols alone, so equal stretches are compressed
alike but for their ends, and the longest common extension of two positions is found by climbing through the rounds while the
symbols agree and descending where they first differ, a constant number of steps a round.

A run of period q and at least 2 q words holds two neighbours of the grid 0, q, 2 q, ... whose words agree, so
the neighbours of all grids (n log n of them) are the candidates; their exact extensions to the right and the left make
the runs. A stretch that several periods find keeps the least.

All texts of a slice of some megabytes are compressed together, with a symbol of their own between them, so every step is an
array operation. Symbols are numbered by the words themselves, no hashes are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm import buffers

MIN_LENGTH = 12  # words of a run, and at least twice its period
SLICE_BYTES = 4 << 20  # of text that is compressed together, one text at least
_CANDIDATES = 1 << 20  # grid neighbours that are held at once
_FOUND = "doc_id {id}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


@dataclass
class Level:
    """Symbols after some rounds; ``up`` is the place of each in the next level, ``first`` the first place of each of the next."""

    symbols: np.ndarray
    up: np.ndarray | None = None
    first: np.ndarray | None = None
    blocks: bool = False

    def close(self, new: np.ndarray, blocks: bool) -> None:
        self.up = np.cumsum(new) - 1
        self.first = np.append(np.flatnonzero(new), len(new))
        self.blocks = blocks

    def turned(self) -> Level:
        """The same level of the sequence read backwards."""
        if self.up is None:
            return Level(self.symbols[::-1])
        top = len(self.first) - 2
        return Level(self.symbols[::-1], (top - self.up)[::-1], (len(self.symbols) - self.first)[::-1], self.blocks)


def compress(symbols: np.ndarray) -> list[Level]:
    """Levels of the grammar of a sequence. Negative symbols separate texts, are all different and are never replaced."""
    levels = [Level(symbols)]
    unused = int(symbols.max(initial=0)) + 1
    idle = 0
    for turn in range(1 << 20):
        now = levels[-1].symbols
        inner = now >= 0
        if idle >= 2 and not (inner[1:] & inner[:-1]).any():
            break
        new = np.ones(len(now), bool)
        blocks = turn % 2 == 0
        if blocks:
            new[1:] = (now[1:] != now[:-1]) | ~inner[1:]
        else:
            coin = (buffers.mix((now + np.int64(1)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn)) & np.uint64(1)).astype(bool)
            new[1:] = ~(inner[:-1] & inner[1:] & ~coin[:-1] & coin[1:])
        if new.all():
            idle += 1
            continue
        idle = 0
        levels[-1].close(new, blocks)
        first = levels[-1].first
        size = np.diff(first)
        above = now[first[:-1]].copy()
        many = np.flatnonzero(size > 1)
        other = size[many] if blocks else now[first[many] + 1]
        # Names of (symbol, length) or (left, right): both are below 2**31.
        _, name = np.unique((above[many] << 31) | other, return_inverse=True)
        above[many] = unused + name
        unused += int(name.max()) + 1
        levels.append(Level(above))
    return levels


def extension(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many symbols from ``i`` and from ``j`` on agree, for arrays of different places of the lowest level."""
    stopped: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    query, x, y = np.arange(len(i)), i, j
    for level in levels:
        symbols = level.symbols
        if level.up is None:
            going = symbols[x] == symbols[y]
            while going.any():
                x, y = x + going, y + going
                going &= symbols[x] == symbols[y]
            stopped.append((query, x, y))
            break
        aligned = np.zeros(len(x), bool)
        apart = np.zeros(len(x), bool)
        while True:
            # Both at the start of what the next level replaces: nothing has to be read here.
            aligned |= ~apart & (level.first[level.up[x]] == x) & (level.first[level.up[y]] == y)
            walk = ~(aligned | apart)
            apart |= walk & (symbols[x] != symbols[y])
            walk &= ~apart
            if not walk.any():
                break
            step = walk.astype(np.int64)
            if level.blocks:
                step *= np.minimum(level.first[level.up[x] + 1] - x, level.first[level.up[y] + 1] - y)
            x, y = x + step, y + step
        stopped.append((query[apart], x[apart], y[apart]))
        query, x, y = query[aligned], level.up[x[aligned]], level.up[y[aligned]]
        if not len(query):
            break
    query, x, y = stopped[-1]
    for at in range(len(stopped) - 1, 0, -1):
        below = levels[at - 1]
        x, y = below.first[x], below.first[y]
        same = (below.symbols[x] == below.symbols[y]).astype(np.int64)
        if below.blocks:
            same *= np.minimum(below.first[below.up[x] + 1] - x, below.first[below.up[y] + 1] - y)
        x, y = x + same, y + same
        more, mx, my = stopped[at - 1]
        query, x, y = np.concatenate([query, more]), np.concatenate([x, mx]), np.concatenate([y, my])
    out = np.empty(len(i), np.int64)
    out[query] = x - i[query]
    return out


def _grids(bounds: np.ndarray, first: np.ndarray, symbols: np.ndarray, shortest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods of grid neighbours that agree and have a neighbour that agrees too."""
    n = np.diff(bounds)
    half = np.where(n >= shortest, n // 2, 0)
    text = np.repeat(np.arange(len(n)), half)
    period = np.arange(len(text)) - np.repeat(np.cumsum(half) - half, half) + 1
    count = (n[text] - 1) // period
    total = np.cumsum(count)
    low = 0
    while low < len(text):
        before = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, before + _CANDIDATES, "right")))
        c, q = count[low:high], np.repeat(period[low:high], count[low:high])
        k = np.arange(len(q)) - np.repeat(np.cumsum(c) - c, c)
        i = np.repeat(first[text[low:high]], c) + k * q
        keep = symbols[i] == symbols[i + q]
        i, q = i[keep], q[keep]
        # A run of at least 2 q and more than q + 1 words has a second equal pair beside this one.
        keep = (symbols[i + 1] == symbols[i + q + 1]) | (symbols[i - 1] == symbols[i + q - 1])
        yield i[keep], q[keep]
        low = high


def runs(codes: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``text, start, length, period`` of every run, ordered by text, start and period.

    ``codes`` are the words of all texts as numbers from 0, ``bounds`` the texts' first words. A run has at least
    ``min_length`` words (4 or more) and twice its least period.
    """
    texts = len(bounds) - 1
    first = bounds[:-1] + 1 + np.arange(texts)  # a separator stands before each text and after the last
    symbols = np.empty(len(codes) + texts + 1, np.int64)
    symbols[np.append(first - 1, len(symbols) - 1)] = -1 - np.arange(texts + 1)
    inner = np.repeat(first - bounds[:-1], np.diff(bounds)) + np.arange(len(codes))
    symbols[inner] = codes
    levels = back = None
    found = []
    for i, q in _grids(bounds, first, symbols, min_length):
        if not len(i):
            continue
        if levels is None:
            levels = compress(symbols)
            back = [level.turned() for level in levels]
        right = extension(levels, i, i + q)
        left = extension(back, len(symbols) - i, len(symbols) - i - q)
        long = right + left + q >= np.maximum(min_length, 2 * q)
        found.append(np.unique(np.stack([i - left, right + left + q, q])[:, long], axis=1))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    least = np.ones(len(start), bool)
    least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[least], length[least], period[least]
    text = np.searchsorted(first, start, "right") - 1
    start = start - first[text]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of a slice and the texts' first words."""
    starts, ends, rows = buffers.word_bounds(data, offsets, buffers.WHITE)
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    held = np.ascontiguousarray(data[~buffers.WHITE[data]]) if len(data) else data
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(held))
    return words, buffers.row_bounds(rows, len(offsets) - 1)


def _with_tails(bounds: np.ndarray, edits: np.ndarray, edited: np.ndarray) -> np.ndarray:
    """Which word of the slice stands at each place, once the tails of the edited texts are made periodic."""
    n = np.diff(bounds)
    edited = edited & (n > 0)
    a = np.where(edited, edits % np.maximum(n, 1), n)
    p = np.where(edited, 1 + (n - a) // (3 + edits % 8), 1)
    first, a, p = (np.repeat(v, n) for v in (bounds[:-1], a, p))
    i = np.arange(bounds[-1]) - first
    return first + np.where(i >= a, a + (i - a) % p, i)


def _search(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = batch.column("edit")
            for row, data, offsets in buffers.slices(batch.column("text"), SLICE_BYTES):
                texts = len(offsets) - 1
                words, bounds = _words(data, offsets)
                edit = edits.slice(row, texts)
                place = _with_tails(bounds, pc.fill_null(edit, 0).to_numpy(), edit.is_valid().to_numpy(zero_copy_only=False))
                codes = words.dictionary_encode().indices.to_numpy()[place] if len(words) else np.zeros(0, np.int64)
                text, start, length, period = runs(codes, bounds, min_length)
                gone = np.zeros(len(codes) + 1, np.int64)
                np.add.at(gone, bounds[text] + start + period, 1)
                np.add.at(gone, bounds[text] + start + length, -1)
                kept = np.cumsum(gone)[:-1] == 0
                upto = np.append(0, np.cumsum(kept))[bounds]
                lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), words.take(pa.array(place[kept])).cast(pa.string()))
                entries = pa.StructArray.from_arrays([pa.array(v) for v in (start, length, period)], fields=list(_RUNS.value_type))
                per_text = pa.ListArray.from_arrays(pa.array(buffers.row_bounds(text, texts), pa.int32()), entries)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, texts), pa.array(np.diff(bounds)), per_text, pc.binary_join(lists, " ")],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def find_runs(docs: DataFrame, *, min_length: int = MIN_LENGTH, edit: Column | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row; words are `[^\\x20\\x09-\\x0D]+`, numbered from 0.

    ``runs`` holds (start, length, period) of every stretch of words with least period q, of ``min_length`` (4 at least) and 2 q words
    or more, that no neighbouring word extends, by start and period. ``collapsed`` is the text without
    the words that any run holds after its first period, joined by blanks. Null text is empty: no words, no runs, an empty
    collapsed text. Repeated rows are each answered, other columns are left out.

    ``edit``, a number g for each row, makes the n words from a = g % n on periodic before the search, with period
    1 + (n - a) / (3 + g % 8); null leaves the text as it is.

    Nothing is shuffled; a task holds a slice of a few megabytes, or its longest text.
    """
    if min_length < 4:
        raise ValueError("runs have four words at least")
    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    edit = F.lit(None) if edit is None else edit
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), edit.cast("long").alias("edit"))
    return rows.mapInArrow(_search(min_length), _FOUND.format(id=kind))


def run_report(docs: DataFrame) -> DataFrame:
    """Runs of every document as counts, the longest run and digests; a tenth of the documents have a periodic tail made first.

    Rows whose doc_id is null are taken as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = find_runs(docs, edit=F.when(h % 10 == 0, F.floor(h / 10)))
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.floor(F.col("longest.length") * 1000 / -F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
