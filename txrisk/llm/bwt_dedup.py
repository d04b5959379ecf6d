"""Suffix-array dedup by column-wise multi-document construction.

Many strings are sorted together by adding one symbol to each of them per round, from the last column to the
first: the stable order of the new symbols over the order of the round before is the order of the longer suffixes, and
the common prefix of neighbours grows by one where their symbols agree and is else the least one between them, or none. This is the
Burrows-Wheeler transform of the collection, column by column; a string starts a repeat where a neighbour shares ``length`` symbols.

Rounds over whole documents would be as many as the longest has bytes, each with a pass over everything. So the strings are
segments around anchors. The anchor of a window of ``length`` bytes is the place of its least gram hash; equal
windows have it at the same place within, so that their segments, cut around the anchor, are aligned and need
``2 * length - GRAM`` columns. Anchors whose hash occurs once are left out. Segments are dealt by their anchor's hash and wait in files in the
shared folder; each task sorts the columns of its own. Equal segments count once per block of documents, so that copies
and shared passages do not pile up.

Hashes of 64 bits decide which segments meet; whether windows are equal is decided on their bytes. (Equal segments of one
block, and whole copies of a document, are recognised by 64 and 128 bits of hash.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import buffers
from txrisk.llm.common import shuffle_width, staged

LENGTH = 200  # bytes of a repeat
GRAM = 32  # bytes that decide on an anchor
_POSITION_BITS = 31
_PIECE = 1 << 18  # bytes that are searched for anchors at once
_STEP = 4_000  # anchors whose segments are held at once
BLOCK_BYTES = 8 << 20  # of text, about, in a block of documents that a task takes at a time


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes of the anchors of all windows of ``length`` bytes within rows."""
    span = length - GRAM + 1
    stop = np.repeat(offsets[1:], np.diff(offsets))
    found, hashes = [], []
    low_bits = np.uint64((1 << _POSITION_BITS) - 1)
    for at in range(0, max(len(data) - length + 1, 0), _PIECE):
        part = data[at : at + _PIECE + length - 1]
        n = len(part) - GRAM + 1
        up, down = buffers.powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(buffers._byte_values()[part] * up[:-1], out=sums[1:])
        gram = buffers.mix((sums[GRAM:] - sums[:-GRAM]) * down[:n])
        packed = (gram & ~low_bits) | np.arange(n, dtype=np.uint64)
        # Least of every run of ``span``: of the end of one block of that many, and the start of the next.
        blocks = -(-n // span)
        padded = np.full(blocks * span, ~np.uint64(0))
        padded[:n] = packed
        padded = padded.reshape(blocks, span)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = np.flatnonzero(np.arange(at, at + n - span + 1) + length <= stop[at : at + n - span + 1])
        least = np.minimum(behind[starts], ahead[starts + span - 1])
        place = np.unique((least & low_bits).astype(np.int64))
        found.append(place + at)
        hashes.append(gram[place])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, first = np.unique(np.concatenate(found), return_index=True)
    return place, np.concatenate(hashes)[first]


def segments(data: np.ndarray, offsets: np.ndarray, place: np.ndarray, length: int):
    """Bytes around each anchor, zero outside its row, and how many of them are the row's to the left and right."""
    before, after = length - GRAM, length
    row = np.searchsorted(offsets, place, "right") - 1
    left = np.minimum(place - offsets[row], before)
    right = np.minimum(offsets[row + 1] - place, after)
    padded = np.concatenate([np.zeros(before, np.uint8), data, np.zeros(after, np.uint8)])
    content = np.lib.stride_tricks.sliding_window_view(padded, before + after)[place]
    column = np.arange(-before, after)
    content = np.where((column >= -left[:, None]) & (column < right[:, None]), content, np.uint8(0))
    return content, left, right, row


def segment_hashes(content: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    width = -(-content.shape[1] // 8) * 8
    wide = np.zeros((len(content), width), np.uint8)
    wide[:, : content.shape[1]] = content
    words = wide.view(np.uint64)
    odd = buffers.mix(np.arange(1, words.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
    total = buffers.mix((left * 1024 + right).astype(np.uint64))
    for k in range(words.shape[1]):
        total += buffers.mix(words[:, k] + odd[k]) * odd[k]
    return buffers.mix(total)


def repeated_starts(content: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """Which windows of aligned segments start a string that starts in another segment at the same column too.

    One round per column, from the last: ``order`` are the segments by their suffixes from this column, ``common[i]`` is
    the common prefix of the suffixes of ranks i - 1 and i.
    """
    n, columns = content.shape
    symbols = content.astype(np.int16) + 1
    column = np.arange(columns)
    before = length - GRAM
    symbols[(column < before - left[:, None]) | (column >= before + right[:, None])] = 0
    symbols = np.ascontiguousarray(symbols.T)
    order, common = np.arange(n), np.zeros(n + 1, np.int32)
    starts = np.zeros((n, before + 1), bool)
    for c in range(columns - 1, -1, -1):
        drawn = symbols[c][order]
        rank = np.argsort(drawn, kind="stable")
        same = drawn[rank[1:]] == drawn[rank[:-1]]
        grown = np.zeros(n + 1, np.int32)
        if n > 1:
            between = np.stack([rank[:-1] + 1, rank[1:] + 1], axis=1).ravel()
            least = np.minimum.reduceat(common, between)[::2]
            grown[1:n] = np.where(same, least + 1, 0)
        order, common = order[rank], grown
        if c <= before:
            starts[order, c] = (common[:-1] >= length) | (common[1:] >= length)
    own = (column[: before + 1] >= before - left[:, None]) & (column[: before + 1] + length <= before + right[:, None])
    return starts & own


def _entry(length: int) -> np.dtype:
    return np.dtype([("anchor", "<u8"), ("hash", "<u8"), ("left", "<u2"), ("right", "<u2"), ("twice", "u1"), ("bytes", "u1", (2 * length - GRAM,))])


def _result(length: int) -> np.dtype:
    return np.dtype([("hash", "<u8"), ("starts", "u1", (-(-(length - GRAM + 1) // 8),))])


def _whole(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A key for each whole row, apart from those of grams."""
    return np.array([int.from_bytes(hashlib.sha256(data[a:b]).digest()[:8], "little") for a, b in zip(offsets, offsets[1:])], np.uint64)


_ASKED = np.dtype([("key", "<u8"), ("n", "u1"), ("block", "<i4")])


def _parts(group: np.ndarray, packed: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Records by group number."""
    order = np.argsort(group, kind="stable")
    present, start = np.unique(group[order], return_index=True)
    packed = packed[order]
    return present.tolist(), [packed[i:j].tobytes() for i, j in zip(start, [*start[1:], len(order)])]


def _ask(buckets: int, length: int):
    """By bucket: anchor hashes and whole-text keys of each block of documents in a batch, with whether they occur once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            held: list[np.ndarray] = []
            for row, data, offsets in buffers.slices(batch.column("text")):
                place, gram = anchors(data, offsets, length)
                of = np.searchsorted(offsets, place, "right") - 1
                long = np.flatnonzero(np.diff(offsets) >= length)
                part = np.zeros(len(gram) + len(long), _ASKED)
                part["key"] = np.concatenate([gram, _whole(data, offsets)[long]])
                part["block"] = blocks[row + np.concatenate([of, long])]
                held.append(part)
            if not sum(map(len, held)):
                continue
            asked = np.concatenate(held)
            asked = asked[np.lexsort((asked["block"], asked["key"]))]
            first = np.ones(len(asked), bool)
            first[1:] = (asked["key"][1:] != asked["key"][:-1]) | (asked["block"][1:] != asked["block"][:-1])
            at = np.flatnonzero(first)
            count = np.diff(np.append(at, len(asked)))
            asked = asked[at]
            asked["n"] = np.minimum(count, 2)
            bucket, parts = _parts((asked["key"] % np.uint64(buckets)).astype(np.int64), asked)
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket, pa.int32()), "keys": pa.array(parts, pa.binary())})

    return run


def _answer(table: pa.Table) -> pa.Table:
    """To each block that asked, the keys that occur more than once in all."""
    asked = np.concatenate([np.frombuffer(k, _ASKED) for k in table.column("keys").to_pylist()])
    distinct, place = np.unique(asked["key"], return_inverse=True)
    more = np.bincount(place, asked["n"].astype(np.float64), len(distinct)) > 1
    asked = asked[more[place]]
    block, parts = _parts(asked["block"], np.ascontiguousarray(asked["key"]))
    return pa.table({"block": pa.array(block, pa.int32()), "keys": pa.array(parts, pa.binary())})


def _uint64s(column: pa.ChunkedArray) -> np.ndarray:
    parts = [np.frombuffer(k, np.uint64) for k in column.to_pylist()]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _cut(buckets: int, length: int):
    """The distinct segments of a block around anchors that occur more than once; also its copied whole texts."""

    def run(key, docs: pa.Table, answers: pa.Table) -> pa.Table:
        known = _uint64s(answers.column("keys"))
        kept: list[np.ndarray] = []
        block = (docs if docs.num_rows else answers).column("block")[0].as_py()
        out: dict[str, list] = {"bucket": [], "segments": []}
        for _, data, offsets in buffers.slices(docs.combine_chunks().column("text")):
            place, gram = anchors(data, offsets, length)
            pick = _among(gram, known)
            place, gram = place[pick], gram[pick]
            for i in range(0, len(place), _STEP):
                content, left, right, _ = segments(data, offsets, place[i : i + _STEP], length)
                part = np.zeros(len(content), _entry(length))
                part["anchor"], part["left"], part["right"] = gram[i : i + _STEP], left, right
                part["hash"], part["bytes"] = segment_hashes(content, left, right), content
                kept.append(_distinct(part))
            if sum(map(len, kept)) > 30_000:
                kept = [_distinct(np.concatenate(kept))]
        if kept:
            entries = _distinct(np.concatenate(kept))
            out["bucket"], parts = _parts((entries["anchor"] % np.uint64(buckets)).astype(np.int64), entries)
            # Segments overlap, so they are several times the text that they come from; they wait and travel compressed.
            out["segments"] = [zstandard.compress(part) for part in parts]
        n = len(out["bucket"])
        return pa.table({"block": pa.array([block] * n, pa.int32()), "bucket": pa.array(out["bucket"], pa.int32()), "segments": pa.array(out["segments"], pa.binary())})

    return run


def _distinct(entries: np.ndarray) -> np.ndarray:
    hashes, first, count = np.unique(entries["hash"], return_index=True, return_counts=True)
    twice = np.zeros(len(hashes), bool)
    np.logical_or.at(twice, np.searchsorted(hashes, entries["hash"]), entries["twice"] > 0)
    out = entries[first]
    out["twice"] = twice | (count > 1)
    return out


def _sort(length: int):
    """The repeated windows of the segments of a bucket, back to the blocks they come from."""

    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(zstandard.decompress(s), _entry(length)) for s in table.column("segments").to_pylist()]
        entries = np.concatenate(parts)
        left, right = entries["left"].astype(np.int64), entries["right"].astype(np.int64)
        starts = repeated_starts(entries["bytes"], left, right, length)
        column, before = np.arange(length - GRAM + 1), length - GRAM
        own = (column >= before - left[:, None]) & (column + length <= before + right[:, None])
        starts |= own & (entries["twice"] > 0)[:, None]
        packed = np.zeros(len(entries), _result(length))
        packed["hash"], packed["starts"] = entries["hash"], np.packbits(starts, axis=1)
        some, out, at = starts.any(axis=1), [], 0
        for p in parts:
            out.append(packed[at : at + len(p)][some[at : at + len(p)]].tobytes())
            at += len(p)
        return pa.table({"block": table.column("block"), "found": pa.array(out, pa.binary())})

    return run


def _remove(length: int):
    """Spans that repeats cover, and the bytes that are left, of each document of a block."""

    def run(key, docs: pa.Table, found: pa.Table) -> pa.Table:
        parts = [np.frombuffer(f, _result(length)) for f in found.column("found").to_pylist() if f]
        results = np.concatenate(parts) if parts else np.zeros(0, _result(length))
        results = results[np.argsort(results["hash"], kind="stable")]
        copied = _uint64s(found.column("keys").drop_null())
        docs = docs.combine_chunks()
        n_bytes, spans, left_over = [], [], []
        for _, data, offsets in buffers.slices(docs.column("text")):
            edge = np.zeros(len(data) + 1, np.int64)
            place, _ = anchors(data, offsets, length)
            for i in range(0, len(place), _STEP):
                content, left, right, _ = segments(data, offsets, place[i : i + _STEP], length)
                hashes = segment_hashes(content, left, right)
                hit = np.flatnonzero(_among(hashes, results["hash"]))
                starts = np.unpackbits(results["starts"][np.searchsorted(results["hash"], hashes[hit])], axis=1)[:, : length - GRAM + 1]
                which, column = np.nonzero(starts)
                at = place[i + hit[which]] + column - (length - GRAM)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            whole = _among(_whole(data, offsets), copied) & (np.diff(offsets) >= length)
            for a, b, all_gone in zip(offsets.tolist(), offsets[1:].tolist(), whole.tolist()):
                mask = gone[a:b]
                if all_gone:
                    mask = np.ones(b - a, bool)
                change = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                n_bytes.append(b - a)
                spans.append([{"start": int(s), "stop": int(e)} for s, e in change.reshape(-1, 2)])
                left_over.append(data[a:b][~mask].tobytes() if len(change) else data[a:b].tobytes())
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.table({"doc_id": docs.column("doc_id"), "n_bytes": pa.array(n_bytes, pa.int64()), "spans": pa.array(spans, span), "kept": pa.array(left_over, pa.binary())})

    return run


def remove_repeats(docs: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row: maximal spans of removed bytes, and the bytes that are left.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in the same
    text or another; strings never cross texts and are judged on the input. Null texts are empty. Rows that repeat
    an id, or id and text, count each, so that the latter are copies of each other. Null ids are kept.
    """
    width = shuffle_width(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n_blocks = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int"))
    answers = staged(
        rows.select("block", "text")
        .mapInArrow(_ask(width, length), "bucket int, keys binary")
        .groupBy("bucket")
        .applyInArrow(_answer, "block int, keys binary"),
        "repeat-keys",
    )
    blocks = rows.groupBy("block")
    cut = staged(
        blocks.cogroup(answers.groupBy("block")).applyInArrow(_cut(width, length), "block int, bucket int, segments binary"),
        "segments",
    )
    found = cut.groupBy("bucket").applyInArrow(_sort(length), "block int, found binary")
    known = found.withColumn("keys", F.lit(None).cast("binary")).unionByName(
        answers.select("block", F.lit(None).cast("binary").alias("found"), "keys")
    )
    return blocks.cogroup(known.groupBy("block")).applyInArrow(
        _remove(length), "doc_id long, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept binary"
    )


def dedup_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""
    return remove_repeats(docs, length=length).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
