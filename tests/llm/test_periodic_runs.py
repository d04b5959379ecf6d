"""Periodic runs against all runs found by definition."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from txrisk.llm import periodic_runs


def runs_by_definition(words, min_length=12):
    """Every run (start, length, period): for each period the maximal stretches of equal words that far apart."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k > i and k + q - i >= max(min_length, 2 * q):
                found.setdefault((i, k + q - i), q)  # the least period comes first
            i = max(k, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def edited(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text, find=runs_by_definition):
    words = edited(doc_id, text)
    found = find(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(found),
        *(best or (None, None, None)),
        best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def key(row):
    return tuple((v is None, v) for v in row)


def fast(words):
    """The runs by numpy, a period at a time: for longer texts."""
    codes = np.unique(words, return_inverse=True)[1] if words else np.zeros(0, int)
    n, found = len(codes), {}
    for q in range(1, n // 2 + 1):
        same = np.flatnonzero(np.diff(np.concatenate([[0], (codes[q:] == codes[:-q]).view(np.int8), [0]])))
        for a, b in zip(same[::2].tolist(), same[1::2].tolist()):
            if b - a + q >= max(12, 2 * q):
                found.setdefault((a, b - a + q), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [tuple(r) for r in periodic_runs.run_report(docs).collect()]
    want = [expected(r.doc_id, r.text, fast) for r in docs.collect()]
    assert sum(r[1] for r in want) > 200
    assert sorted(rows, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_runs_of_random_words(letters):
    draw = np.random.default_rng(letters)
    texts = [draw.integers(0, letters, n) for n in (0, 1, 11, 12, 13, 40, 90, 200)]
    texts += [np.resize(draw.integers(0, letters + 3, p), n) for p, n in ((1, 50), (3, 100), (7, 21), (7, 14), (50, 120), (5, 11))]
    bounds = np.cumsum([0, *map(len, texts)])
    text, *found = periodic_runs.runs(np.concatenate(texts), bounds)
    got = [(int(t), *map(int, r)) for t, *r in zip(text, *found)]
    assert got == [(i, *r) for i, t in enumerate(texts) for r in runs_by_definition(t.tolist())]


def test_extensions_of_all_pairs():
    draw = np.random.default_rng(5)
    for trial in range(30):
        body = np.concatenate([np.resize(draw.integers(0, 4, draw.integers(1, 9)), draw.integers(1, 40)) for _ in range(3)])
        symbols = np.concatenate([[-1], body, [-2], body[::-1], [-3]]).astype(np.int64)
        levels = periodic_runs.compress(symbols)
        i, j = (v.ravel() for v in np.meshgrid(np.arange(len(symbols)), np.arange(len(symbols))))
        i, j = i[i != j], j[i != j]
        want = []
        for a, b in zip(i.tolist(), j.tolist()):
            k = 0
            while max(a, b) + k < len(symbols) and symbols[a + k] == symbols[b + k]:
                k += 1
            want.append(k)
        assert periodic_runs.extension(levels, i, j).tolist() == want
        turned = [level.turned() for level in levels]
        assert periodic_runs.compress(symbols[::-1].copy())[0].symbols.tolist() == turned[0].symbols.tolist()
        last = len(symbols) - 1
        back = dict(zip(zip(i.tolist(), j.tolist()), periodic_runs.extension(turned, last - i, last - j).tolist()))
        for (a, b), k in list(back.items())[::7]:
            assert (symbols[a - k + 1 : a + 1] == symbols[b - k + 1 : b + 1]).all()
            assert min(a, b) - k < 0 or symbols[a - k] != symbols[b - k]


AWKWARD = [
    (1, None), (None, "a b " * 20), (2, ""), (3, " \t\n"), (4, "x " * 5000), (4, "x " * 5000), (5, "é ñ\tü " * 9 + "é ñ"),
    (6, "A a " * 10), (7, "w" * 300_000), (8, "p q r s t u " * 2), (9, "p q r s t " * 2), (10, "one two three " * 40 + "end"),
    (11, " ".join(str(i * i % 17) for i in range(3000))), *((i, "a b c d e f g h i j k l m n o p q r") for i in range(20, 60)),
]


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(*r, 9, "own") for r in AWKWARD], "doc_id long, text string, period int, runs string")
    rows = [tuple(r) for r in periodic_runs.run_report(docs).collect()]
    assert sorted(rows, key=key) == sorted((expected(*r) for r in AWKWARD), key=key)
    found = {r.doc_id: r for r in periodic_runs.find_runs(docs).collect()}
    assert found[4].collapsed == "x" and found[6].n_words == 20
    assert [tuple(r) for r in found[5].runs] == [(0, 29, 3)] and found[5].collapsed == "é ñ ü"
    assert periodic_runs.run_report(docs.limit(0)).collect() == []
    short = {r.doc_id: r.runs for r in periodic_runs.find_runs(docs, min_length=4).collect()}
    assert [tuple(r) for r in short[9]] == [(0, 10, 5)]
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs, min_length=3)
