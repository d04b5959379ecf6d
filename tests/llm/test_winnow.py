import hashlib
import re

import pytest

from txrisk.llm import queries, winnow
from pyspark.sql import functions as F


def grams(text, k=winnow.K):
    words = [w for w in re.split(r"[ \t\n\v\f\r]+", text.lower()) if w]
    return [tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))] if words else []


def chosen(hashes, window=winnow.WINDOW):
    """Positions by the definition: least hash of each window, rightmost of equals."""
    out = []
    for i in range(max(len(hashes) - window + 1, 1) if hashes else 0):
        part = range(i, min(i + window, len(hashes)))
        best = min(part, key=lambda p: (hashes[p], -p))
        if best not in out:
            out.append(best)
    return out


def parsed(text):
    return [(h, int(p)) for h, p in (x.split("@") for x in text.split())]


def check(rows, got):
    """Rows must have distinct ids. One hash per k-gram is learned from windows as wide as one k-gram."""
    order = sorted(rows, key=lambda r: -r[0])
    by_id = {r.doc_id: r for r in got}
    assert len(by_id) == len(rows) == len(got)
    for i, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        row = by_id[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        sets = [{h for h, _ in parsed(t)} for t in (row.fingerprint, row.edited_fingerprint, by_id[order[(i + 1) % len(order)][0]].fingerprint)]
        for found, other in ((row.near_edited, sets[1]), (row.near_next, sets[2])):
            either = sets[0] | other
            assert found == pytest.approx(len(sets[0] & other) / len(either) if either else 1.0)
    return by_id


def test_chosen_positions(spark):
    texts = ["", "one", "a b c", "a b c d", " ".join("abcab"[i % 5] for i in range(60)), " ".join(str(i * i % 97) for i in range(300)), "x " * 100]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    every = {r.i: r for r in winnow.with_fingerprint(df, "text", "m", window=1).select("i", winnow.as_text(F.col("m")).alias("m")).collect()}
    some = {r.i: r for r in winnow.with_fingerprint(df, "text", "m").select("i", winnow.as_text(F.col("m")).alias("m")).collect()}
    for i, text in enumerate(texts):
        hashes = {}
        for h, p in parsed(every[i].m):
            hashes[p] = int(h, 16)
        g = grams(text)
        assert len(hashes) == len(g)
        assert len({(a, hashes[p]) for p, a in enumerate(g)}) == len(set(g)) == len(set(hashes.values()))
        assert [p for _, p in parsed(some[i].m)] == chosen([hashes[p] for p in range(len(g))])


def test_match_guarantee(spark):
    shared = " ".join(f"s{i}" for i in range(winnow.K + winnow.WINDOW - 1))
    rows = [(1, f"{'a ' * 7}{shared} b b"), (2, f"c d {shared}{' e f g' * 9}")]
    a, b = (set(h for h, _ in parsed(r.m)) for r in winnow.with_fingerprint(spark.createDataFrame(rows, "i long, text string"), "text", "m").select(winnow.as_text(F.col("m")).alias("m")).collect())
    assert a & b


def test_short_texts(spark):
    """Texts of 9 to 18 words: the first six words or more are not edited, so that the edited text shares a fingerprint."""
    rows = [(i, " ".join(f"t{i:02}w{j:02}" for j in range(9 + i % 10))) for i in range(60)]
    got = check(rows, winnow.fingerprint_report(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert all(r.near_edited > r.near_next == 0 for r in got.values())


def test_short_texts_of_the_table(spark, small):
    """Whoever keeps six words or more of a text keeps a fingerprint of it."""
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op9_winnow"](spark, small).collect()}
    kept = [i for i, t in rows if len(t or "") and len((t[: len(t) - len(t) // 3] + "x").split()) > 6]
    assert kept and all(got[i].near_edited > 0 for i in kept)


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    by_id = check(rows, queries.QUERIES["op9_winnow"](spark, small).collect())
    near = sum(r.near_edited > r.near_next for r in by_id.values())
    assert near >= 0.95 * len(by_id)
    same = {}
    for doc_id, text in rows:
        assert same.setdefault(text, by_id[doc_id].fingerprint) == by_id[doc_id].fingerprint


def test_edge_cases(spark):
    schema = "doc_id long, text string, next_text string, edited string, __range int"
    assert winnow.fingerprint_report(spark.createDataFrame([], schema)).collect() == []
    rows = [(5, None, "", "", 1), (-3, "", "", "", 1), (2**60, "é b c d e f", "", "", 1), (7, "word", "", "", 1), (9, " \n\t", "", "", 1)]
    check(rows, winnow.fingerprint_report(spark.createDataFrame(rows, schema)).collect())
    check(rows[:1], winnow.fingerprint_report(spark.createDataFrame(rows[:1], schema)).collect())
    again = [(None, "a b c d e"), (4, "f g h i"), (4, "f g h i"), (4, "other words"), (None, "z")]
    found = winnow.fingerprint_report(spark.createDataFrame(again, "doc_id long, text string")).collect()
    assert sorted(r.n_chars for r in found) == sorted(len(t) for _, t in again)


def test_ranges_hold_about_equally_many_rows(spark):
    """One far id, or many null ids, make no range with most rows; and the next row is right across ranges."""
    far = [(i, f"text {i}") for i in range(2000)] + [(2**60, "far away")]
    none = [(None, f"text {i}") for i in range(1500)] + [(i, f"text {i}") for i in range(500)]
    for rows in (far, none):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("__tie", F.xxhash64("text"))
        ranges = winnow._ranges(df, "doc_id", 16)
        bounds = [(r["least"]["id"], r["least"]["tie"]) for r in ranges]
        low = F.arrays_zip(F.lit([b[0] for b in bounds]).cast("array<bigint>").alias("id"), F.lit([b[1] for b in bounds]).cast("array<bigint>").alias("tie"))
        key = F.struct(F.col("doc_id").alias("id"), F.col("__tie").alias("tie"))
        sizes = [r["count"] for r in df.groupBy(winnow._range_of(key, low, len(ranges))).count().collect()]
        assert len(sizes) == len(ranges) and sum(sizes) == len(rows) and max(sizes) <= 3 * len(rows) / 16
    check(far, winnow.fingerprint_report(spark.createDataFrame(far, "doc_id long, text string")).collect())
    nexts = winnow.with_next(spark.createDataFrame(none, "doc_id long, text string"), "doc_id", ["text"], lambda df: df).collect()
    assert sorted(r.text for r in nexts) == sorted(r.next_text for r in nexts) == sorted(t for _, t in none)
    assert {r.doc_id: r.next_text for r in nexts if r.doc_id} == {i: f"text {i - 1}" for i in range(1, 500)}
