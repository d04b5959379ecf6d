"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The automaton recognises every run of consecutive words of any item. Training tokens are streamed
through it, and the length of the longest match that ends at each token is tracked: where it reaches the
window length, the last words are a window of some item. Items shorter than a window count whole.

Words are compared by 64-bit hashes. Tokens that cannot belong to a match of the shortest window
(a word, or a pair of neighbouring words, that no item has) are skipped in bulk before the automaton runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import buffers
from txrisk.llm.common import set_aside

WINDOW = 10
BLOCK_WORDS = 500_000  # of benchmark text held in one automaton; more text makes more passes
HIT = "struct<first:int,last:int,start:bigint,stop:bigint>"


class SuffixAutomaton:
    """Over the token sequences of several items."""

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, tokens in items:
            last = 0
            for token in tokens:
                last = self._extend(last, token)
        self.full: dict[int, set[str]] = {}  # state of a window -> items that have it
        self.short: dict[int, tuple[int, set[str]]] = {}  # state of a short item -> its length, its items
        for name, tokens in items:
            state = length = 0
            short = len(tokens) < window
            for i, token in enumerate(tokens):
                state, length = self.next[state][token], length + 1
                if (i + 1 == len(tokens)) if short else length >= window:
                    at = self.ancestor(state, len(tokens) if short else window)
                    found = self.short.setdefault(at, (len(tokens), set()))[1] if short else self.full.setdefault(at, set())
                    if name is not None:
                        found.add(name)
        # The nearest state at or above each one at which a short item ends.
        self.nearest = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.nearest[state] = state if state in self.short else self.nearest[self.link[state]]

    def _extend(self, last: int, token: int) -> int:
        known = self.next[last].get(token)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, known, token)
        new = self._state({}, -1, self.length[last] + 1)
        at = last
        while at >= 0 and token not in self.next[at]:
            self.next[at][token] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            known = self.next[at][token]
            exact = self.length[known] == self.length[at] + 1
            self.link[new] = known if exact else self._split(at, known, token)
        return new

    def _state(self, edges: dict[int, int], link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, at: int, known: int, token: int) -> int:
        copy = self._state(dict(self.next[known]), self.link[known], self.length[at] + 1)
        while at >= 0 and self.next[at].get(token) == known:
            self.next[at][token] = copy
            at = self.link[at]
        self.link[known] = copy
        return copy

    def ancestor(self, state: int, length: int) -> int:
        """The state of the last ``length`` tokens of a match that ends in ``state``."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def matches(self, tokens: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """``(first, last, items)`` of every window occurrence, last token included."""
        state = length = 0
        for i, token in enumerate(tokens):
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state, length = self.next[state][token], length + 1
            else:
                length = 0
            if length >= self.window:
                yield i - self.window + 1, i, self.full[self.ancestor(state, self.window)]
            at = self.nearest[state] if length else -1
            while at > 0:
                n, items = self.short[at]
                if n <= length:
                    yield i - n + 1, i, items
                at = self.nearest[self.link[at]]


class BenchmarkIndex:
    """An automaton with the tables that find the tokens worth streaming."""

    def __init__(self, rows: list[tuple[str | None, str | None]], window: int = WINDOW):
        texts = pa.array([text for _, text in rows], pa.string())
        data, offsets = buffers.text_bytes(texts)
        hashes, of = buffers.words(data, offsets, buffers.NOT_ALNUM)
        self.vocabulary = np.unique(hashes)
        ids = np.searchsorted(self.vocabulary, hashes)
        bounds = buffers.row_bounds(of, len(rows))
        items = [(rows[i][0], ids[bounds[i] : bounds[i + 1]].tolist()) for i in range(len(rows))]
        items = [(name, tokens) for name, tokens in items if tokens]
        self.automaton = SuffixAutomaton(items, window)
        self.shortest = min([window, *(len(tokens) for _, tokens in items)])
        self.bits = np.uint64((1 << max(16, int(len(self.vocabulary)).bit_length() + 4)) - 1)
        self.maybe = np.zeros(int(self.bits) + 1, bool)
        self.maybe[self.vocabulary & self.bits] = True
        self.pairs = np.unique(np.array([a * len(self.vocabulary) + b for _, t in items for a, b in zip(t, t[1:])], np.int64))

    def token_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary ids, -1 for words that no item has."""
        ids = np.full(len(hashes), -1, np.int64)
        at = np.flatnonzero(self.maybe[hashes & self.bits])
        if len(at):
            place = np.minimum(np.searchsorted(self.vocabulary, hashes[at]), len(self.vocabulary) - 1)
            known = self.vocabulary[place] == hashes[at]
            ids[at[known]] = place[known]
        return ids

    def runs(self, ids: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of tokens whose neighbours are pairs of some item, long enough to hold a window."""
        known = ids >= 0
        joined = np.zeros(len(ids), bool)  # to the token before
        at = np.flatnonzero(known[1:] & known[:-1] & (rows[1:] == rows[:-1])) + 1
        if len(at) and len(self.pairs):
            keys = ids[at - 1] * len(self.vocabulary) + ids[at]
            place = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            joined[at[self.pairs[place] == keys]] = True
        starts = np.flatnonzero(known & ~joined)
        breaks = np.append(np.flatnonzero(~joined), len(ids))
        ends = breaks[np.searchsorted(breaks, starts, "right")]
        keep = ends - starts >= self.shortest
        return zip(starts[keep].tolist(), ends[keep].tolist())


def _merged(hits: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Overlapping or touching hits as one."""
    out: list[tuple[int, int, int, int]] = []
    for first, last, start, stop in sorted(hits):
        if out and first <= out[-1][1] + 1:
            before = out[-1]
            if last > before[1]:
                out[-1] = (before[0], last, before[2], stop)
        else:
            out.append((first, last, start, stop))
    return out


def _pass(docs: DataFrame, index: BenchmarkIndex) -> DataFrame:
    """Add the hits and items of one automaton to those that the rows carry already."""
    held, names = docs.sparkSession.sparkContext.broadcast(index), docs.columns
    hit_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            hits: dict[int, list] = {}
            items: dict[int, set] = {}
            n_words = np.zeros(batch.num_rows, np.int64)
            for row, data, offsets in buffers.slices(batch.column("__text")):
                starts, ends, rows = buffers.word_bounds(buffers.FOLD[data], offsets, buffers.NOT_ALNUM)
                n_words[row : row + len(offsets) - 1] = np.bincount(rows, minlength=len(offsets) - 1)
                if not len(index.vocabulary) or not len(starts):
                    continue
                ids = index.token_ids(buffers.span_hashes(data, starts, ends, buffers.FOLD))
                words_before = buffers.row_bounds(rows, len(offsets) - 1)
                for a, b in index.runs(ids, rows):
                    doc = int(rows[a])
                    for first, last, found in index.automaton.matches(ids[a:b].tolist()):
                        x, y = a + first, a + last
                        hits.setdefault(row + doc, []).append(
                            (x - int(words_before[doc]), y - int(words_before[doc]), int(starts[x] - offsets[doc]), int(ends[y] - offsets[doc]))
                        )
                        items.setdefault(row + doc, set()).update(found)
            old_hits, old_items = batch.column("hits"), batch.column("items")
            out_hits, out_items = [], []
            for i in range(batch.num_rows):
                carried = old_hits[i].as_py() or []
                out_hits.append(_merged([tuple(h.values()) for h in carried] + hits.get(i, [])) if carried or i in hits else [])
                out_items.append(sorted(items.get(i, set()) | set(old_items[i].as_py() or [])))
            columns = dict(zip(batch.schema.names, batch.columns)) | {
                "n_words": pa.array(n_words),
                "hits": pa.array([[dict(zip(("first", "last", "start", "stop"), h)) for h in row] for row in out_hits], hit_type),
                "items": pa.array(out_items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_pydict({c: columns[c] for c in names})

    return docs.mapInArrow(run, docs.schema)


def find(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Add ``n_words, hits, items`` to every row; columns of these names are replaced.

    ``hits`` are the maximal runs of hit words: first and last word, and the bytes of the text they span.
    ``items`` are the ids, as text, of items with an occurring window; an item without id causes hits only. Null and
    empty texts have no words; repeated documents are reported each, repeated items once.

    Only the benchmark reaches the driver, in blocks of about ``block_words`` words, each of which is one
    automaton and one narrow pass over the documents.
    """
    counted = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = counted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (block_words * 6)))
    found = docs.drop("n_words", "hits", "items").withColumns(
        {
            "__text": F.coalesce(F.col("text"), F.lit("")),
            "n_words": F.lit(0).cast("long"),
            "hits": F.array().cast(f"array<{HIT}>"),
            "items": F.array().cast("array<string>"),
        }
    )
    for block in range(blocks):
        part = counted.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        found = _pass(found, BenchmarkIndex(sorted(map(tuple, part.collect()), key=str), window))
    return found.drop("__text")


def n_hit():
    return F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"] + 1)


def remove(docs: DataFrame, benchmark: DataFrame, *, min_words: int = 1, max_coverage: float = 0.5, window: int = WINDOW) -> DataFrame:
    """The documents without what they share with the benchmark, same columns.

    Runs of at least ``min_words`` hit words are cut out of the text (with nothing put in their place); documents of which more than
    ``max_coverage`` of the words are hit go altogether. Others keep every byte. ``n_chars`` follows the text.
    """
    rows, own = set_aside(docs, "n_words", "hits", "items")
    found = find(rows, benchmark, window=window)
    kept = found.filter(n_hit() <= F.lit(max_coverage) * F.col("n_words")).withColumn(
        "hits", F.filter("hits", lambda h: h["last"] - h["first"] + 1 >= min_words)
    )
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("hits")),
        lambda i: F.substring(
            raw,
            (F.when(i == 0, 0).otherwise(F.get("hits", i - 1)["stop"]) + 1).cast("int"),
            (
                F.coalesce(F.get("hits", i)["start"], F.length(raw).cast("long"))
                - F.when(i == 0, 0).otherwise(F.get("hits", i - 1)["stop"])
            ).cast("int"),
        ),
    )
    text = F.decode(F.aggregate(pieces, F.lit("").cast("binary"), lambda a, b: F.concat(a, b)), "UTF-8")
    changed = kept.withColumn("text", F.when(F.size("hits") > 0, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn(
            "n_chars", F.when(F.size("hits") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        )
    return changed.select(*own)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


_FOLDED = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = rf"""
WITH i AS (
  SELECT item_id::VARCHAR AS item_id, {_FOLDED} AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS p FROM i WHERE len(w) > 0)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, {_FOLDED} AS w FROM documents
), dw AS (
  SELECT r, n, p, array_to_string(w[p : p + n - 1], ' ') AS k
  FROM (SELECT d.r, d.w, s.n, unnest(range(1, len(w) - s.n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) s WHERE len(w) >= s.n)
), m AS (
  SELECT dw.r, dw.n, dw.p, iw.item_id FROM dw JOIN iw USING (n, k)
), h AS (
  SELECT r, count(DISTINCT x)::BIGINT AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS x FROM (SELECT DISTINCT r, n, p FROM m)) GROUP BY r
), t AS (
  SELECT r, count(DISTINCT item_id)::BIGINT AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
