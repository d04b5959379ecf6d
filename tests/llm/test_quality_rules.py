"""Rules by definition, and the robust estimate against one by many random starts."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txrisk.llm import quality_rules
from txrisk.llm.common import table

WHITE = " \t\n\v\f\r"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    found = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))
    return (*found, found[0] < 20 or 100 * found[4] > 30 * found[0])


def test_rules_of_the_whole_table(spark, small):
    docs = table(spark, small, "documents")
    rows = quality_rules.quality_report(docs)
    assert rows.dtypes == [("doc_id", "bigint"), *((c, "bigint") for c in quality_rules.COUNTS), ("base_failed", "boolean"), ("kept", "boolean")]
    rows = {r.doc_id: tuple(r)[1:] for r in rows.collect()}
    want = {r.doc_id: counts(r.text) for r in docs.collect()}
    assert {k: r[:6] for k, r in rows.items()} == want
    assert sum(w[4] > 0 for w in want.values()) > 50 and sum(w[3] > 0 for w in want.values()) > 20
    assert not any(r[5] and r[6] for r in rows.values())
    quality = {r.doc_id: r.quality for r in table(spark, small, "labels").collect()}
    passed = {k: r[6] for k, r in rows.items() if not r[5]}
    assert np.mean([passed[k] for k, q in quality.items() if q == 1 and k in passed]) > 0.98
    assert np.mean([passed[k] for k, q in quality.items() if q == 0 and k in passed]) < 0.1


AWKWARD = [
    (1, None, "en", "a"), (2, "", None, None), (None, "one two three four five six seven " * 3, "en", "a"), (3, "x " * 60_000, "en", "a"),
    (4, "w" * 200_000, None, "a"), (5, "\n \n\t", "en", None), (6, " ".join(f"w{i}" for i in range(8)) + "\v" + " ".join(f"w{i}" for i in range(9)), "", ""),
    (7, "a b\nc d\na b\n\na b \nc d", "en", "a"), (7, "a b\nc d\na b\n\na b \nc d", "en", "a"), (8, "é # ñ ** <ü>|$ % && " + " ".join(map(str, range(40))), "fr", "é"),
    (9, " ".join(map(str, range(30))) + " " + " ".join(map(str, range(9))), "en", "a"),
]


def test_awkward_rows(spark):
    extra = "kept int, distance string, x0 int, key string, n_words string, group int, mu int"
    docs = spark.createDataFrame([(*r, 1, "own", 2, "k", "w", 3, 4) for r in AWKWARD], "doc_id long, text string, lang string, source string, " + extra)
    rows = sorted(map(tuple, quality_rules.quality_report(docs).collect()), key=str)
    want = sorted(((r[0], *(c := counts(r[1])), not c[5]) for r in AWKWARD), key=str)
    assert rows == want  # too few for any estimate
    assert quality_rules.quality_report(docs.limit(0)).collect() == []
    assert all(r.distance is None for r in quality_rules.judge(docs).collect())
    judged = quality_rules.judge(docs, least_rows=1).collect()
    assert len(judged) == len(AWKWARD) and all(r.distance >= 0 for r in judged if not r.base_failed)


def determinant(x, weight):
    floors = np.diag((np.array(quality_rules.FLOORS) * quality_rules.UNIT) ** 2)
    return np.linalg.slogdet(quality_rules.FACTOR_NEAREST * np.cov(x[weight].T, bias=True) + floors)[1]


def fast_mcd(x, draw, starts=100):
    """Least determinant of the nearest three quarters, over random starts."""
    h, best = int(np.ceil(quality_rules.NEAREST * len(x))), (np.inf, None)
    floors = np.diag((np.array(quality_rules.FLOORS) * quality_rules.UNIT) ** 2)
    for _ in range(starts):
        chosen = draw.permutation(len(x))[:12]
        for _ in range(30):
            scatter = quality_rules.FACTOR_NEAREST * np.cov(x[chosen].T, bias=True) + floors
            off = x - x[chosen].mean(axis=0)
            chosen = np.argsort(np.einsum("ij,jk,ik->i", off, np.linalg.inv(scatter), off), kind="stable")[:h]
        best = min(best, (determinant(x, chosen), tuple(chosen)))
    return best


def vectors(draw, n, bad):
    mix = draw.normal(size=(5, 5)) * 300
    x = draw.normal(size=(n, 5)) @ mix + 2000
    x[:bad] = draw.normal(size=(bad, 5)) * 40 + 2000 + draw.normal(size=5) * 6000
    return np.round(x).astype(int)


def test_estimate_against_random_starts(spark):
    draw = np.random.default_rng(3)
    groups = {"a": vectors(draw, 400, 80), "b": vectors(draw, 300, 0), "c": vectors(draw, 900, 200), "d": np.full((60, 5), 7)}
    rows = spark.createDataFrame([(k, *map(int, v)) for k, x in groups.items() for v in x], "key string, x0 long, x1 long, x2 long, x3 long, x4 long")
    found = quality_rules.estimate(rows.repartition(7))
    near = quality_rules._look_up(rows, found, "key", quality_rules.X).withColumn("distance", quality_rules.distance())
    for key, bad in (("a", 80), ("b", 0), ("c", 200)):
        x = groups[key]
        got = {tuple(r[1:6]) if r[0] == key else None: r.distance for r in near.filter(F.col("key") == key).select("key", *quality_rules.X, "distance").collect()}
        distance = np.array([got[tuple(v)] for v in x.tolist()])
        assert (distance[:bad] > quality_rules.CUTOFF).all() and (distance[bad:] > quality_rules.CUTOFF).mean() < 0.01
        best, chosen = fast_mcd(x, draw)
        row = found.filter(F.col("key") == key).first()
        m = np.zeros((5, 5))
        m[np.tril_indices(5)] = row.m
        inside = x[list(chosen)]
        off = x - inside.mean(axis=0)
        scatter = quality_rules.FACTOR_NEAREST * np.cov(inside.T, bias=True) + np.diag((np.array(quality_rules.FLOORS) * quality_rules.UNIT) ** 2)
        within = x[np.einsum("ij,jk,ik->i", off, np.linalg.inv(scatter), off) <= quality_rules.WITHIN]
        # The reweighted estimates of the best random start and ours.
        assert np.allclose(row.mu, within.mean(axis=0), atol=40)
        theirs = quality_rules.FACTOR_WITHIN * np.cov(within.T, bias=True) + np.diag((np.array(quality_rules.FLOORS) * quality_rules.UNIT) ** 2)
        assert np.linalg.slogdet(np.linalg.inv(m.T @ m))[1] == pytest.approx(np.linalg.slogdet(theirs)[1], abs=0.35)
    flat = found.filter("key = 'd'").first()
    assert flat.mu == [7.0] * 5
    assert quality_rules.estimate(rows.limit(0)).collect() == []


def test_copies_and_small_sources(spark):
    """Two thirds of a source are copies of one text, which must not make outliers of the rest; small sources share an estimate."""
    draw = np.random.default_rng(1)
    text = lambda n: " ".join(f"{draw.integers(1e9)}" for _ in range(n))
    copy = text(200)
    rows = [(i, copy, "en", "a") for i in range(400)] + [(1000 + i, text(int(draw.integers(60, 600))), "en", "a") for i in range(200)]
    rows += [(2000 + i, text(int(draw.integers(60, 600))), "en", f"s{i % 20}") for i in range(100)]
    rows += [(3000, "# $ % & " * 30 + " ".join(map(str, range(300))), "en", "a"), (3001, "### " * 3 + "|| " * 90 + text(300), "en", "s1"), (3002, text(100), "de", "z")]
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not got[3001].kept and not got[3000].kept
    assert got[3002].distance is None and got[3002].kept
    assert all(got[i].distance is not None for i in range(2000, 2100))
    assert np.mean([r.kept for i, r in got.items() if i < 3000]) > 0.99 and got[0].kept
