"""Queries with SQL, on whole tables and on rows made to be awkward; and the classifiers."""

import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import compare
from txrisk.llm import buffers, decontaminate, mixing, quality_fm, queries, toxicity_gru


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, small, name):
    with compare.connect(small) as con:
        assert compare.differences(queries.QUERIES[name](spark, small), con, queries.ORACLE[name]) == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in queries.QUERIES and set(queries.ORACLE) <= set(queries.QUERIES)


DOCS = [(1, "one two three", "a"), (1, "one two three", "a"), (2, None, "b"), (3, "", None), (None, "x " * 50, None), (4, "y \t\n", "é"), (5, "z " * 1000, "c"), (6, "w " * 7, "c"), (7, "v", "d"), (8, "u " * 3, "e")]


def sql(spark, tables, query):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return con, query


def test_mixing_edge_cases(spark):
    docs = spark.createDataFrame([(*r, 1, 2) for r in DOCS], "doc_id long, text string, source string, size int, weight int")
    assert compare.differences(mixing.mix_report(docs), *sql(spark, {"documents": docs}, mixing.ORACLE_SQL)) == []
    assert set(docs.columns) <= set(mixing.mix(docs).columns)
    rows = mixing.mix(docs, parts=3).collect()
    assert sum(r.size for r in rows) >= sum(r.taken for r in rows) > 0.9 * sum(r.size for r in rows)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    empty = docs.limit(0)
    assert mixing.mix_report(empty).collect() == []
    nothing = docs.filter("doc_id in (2, 3)")
    assert [r.taken for r in mixing.mix_report(nothing).collect()] == [0, 0]


ITEMS = [(1, "b c d"), (2, "a b c d e f g h i j k"), (3, "h é i"), (4, None), (5, "e"), (5, "b c d"), (6, "a b c d e f g h i j z")]
TEXTS = [(1, "xx A b c d e Yy"), (2, "a b c d e f g h i j k l"), (3, None), (4, ""), (5, "g h é I j k q e"), (1, "xx A b c d e Yy"), (None, "a-b_c.d e f g h i j z"), (6, "q " * 5000 + "b c d")]


@pytest.mark.parametrize("block_words", [1, 10**6])
def test_decontamination_edge_cases(spark, block_words):
    docs = spark.createDataFrame([(*r, 3, 4) for r in TEXTS], "doc_id long, text string, hits int, n_words int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    con, query = sql(spark, {"documents": docs, "benchmark": items}, decontaminate.ORACLE_SQL)
    assert compare.differences(decontaminate.contamination_report(docs, items), con, query) == []
    found = decontaminate.find(docs, items, block_words=block_words)
    assert sorted((str(r.doc_id), r.hits[0].stop) for r in found.collect() if r.hits) == sorted(
        [("1", 12), ("1", 12), ("2", 21), ("5", 8), ("None", 21), ("6", 10005)]
    )
    assert decontaminate.find(docs.limit(0), items).collect() == []
    assert not any(r.hits for r in decontaminate.find(docs, items.limit(0)).collect())
    cut = decontaminate.remove(docs, items, max_coverage=0.7)
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "xx A  Yy", 3: None, 4: "", 5: "g  j k q ", 6: "q " * 5000}


def test_filters_give_back_the_callers_columns(spark):
    docs = spark.createDataFrame([(1, "plain words here", "mine", "own", 4, "six", "x")], "doc_id long, text string, score string, predicted string, n_words int, hits string, items string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    items = spark.createDataFrame([(9, "elsewhere")], "item_id long, text string")
    for kept in (quality_fm.keep_good(docs, labels), decontaminate.remove(docs, items)):
        assert kept.schema == docs.schema
        assert all(tuple(r) == (1, "plain words here", "mine", "own", 4, "six", "x") for r in kept.collect())
    assert decontaminate.remove(docs, items).count() == 1


def test_quality_scores(spark, tmp_path):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op1_quality_fm"](spark, sf)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.98
    assert np.mean([r.predicted for r in rows if r.quality == 0]) < 0.25


def test_toxicity_scores(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op10_toxicity_gru"](spark, sf)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted for r in rows if r.toxic == 1]) > 0.8
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.05


AWKWARD = [(1, None, None), (2, "", 0), (None, "no id", 5), (3, "long " * 60_000, 300_000), (3, "long " * 60_000, 300_000), (4, "w" * 200_000, None), (5, "\n", 1)]


@pytest.mark.parametrize("classifier, label", [(quality_fm, "quality"), (toxicity_gru, "toxic")])
def test_classifier_edge_cases(spark, classifier, label):
    docs = spark.createDataFrame([(*r, 1.0, 9) for r in AWKWARD], "doc_id long, text string, n_chars long, score double, y int")
    report = classifier.quality_report if label == "quality" else classifier.toxicity_report
    for pairs in ([], [(1, 1)], [(1, 1), (2, 0), (2, 0), (3, 1), (5, None), (None, 1), (99, 0)]):
        labels = spark.createDataFrame([(*p, 3) for p in pairs], f"doc_id long, {label} int, y int")
        rows = report(docs, labels).collect()
        assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 3}) == 1
    assert report(docs.limit(0), labels).collect() == []
    again = classifier.score(docs, classifier.train(docs, labels))
    assert sorted(again.columns) == sorted([*docs.columns, "predicted"])


def test_pairwise_sum_is_that_of_all_pairs():
    model, draw = quality_fm.FactorisationMachine(), np.random.default_rng(4)
    model.w[:], model.v[:] = draw.normal(size=model.w.shape), draw.normal(size=model.v.shape)
    buckets, value, stats = np.array([3, 70, 900]), 0.5, draw.normal(size=quality_fm.N_STATS)
    x = np.zeros(len(model.w))
    x[buckets], x[quality_fm.WORD_BUCKETS :] = value, stats
    at = np.flatnonzero(x)
    pairs = sum(model.v[i] @ model.v[j] * x[i] * x[j] for n, i in enumerate(at) for j in at[:n])
    margin, _ = model.margins(np.array([0, 3]), buckets, np.array([value]), stats[None, :])
    assert margin[0] == pytest.approx(model.w @ x + pairs, rel=1e-5)


def test_gradient_of_the_network():
    draw = np.random.default_rng(0)
    net = toxicity_gru.Network.random(3)
    net.p = {k: a.astype(np.float64) for k, a in net.p.items()}
    x, index, length = draw.normal(size=(7, 2 * toxicity_gru.DIM)), draw.integers(0, 7, (4, 6)), np.array([6, 5, 5, 2])
    y = np.array([1, 0, 1, 0.0])

    def loss():
        margin = net.run(x, index, length)[0]
        return np.sum(np.logaddexp(0, margin) - y * margin)

    margin, cache = net.run(x, index, length)
    gradient, dx = net.gradient(x, index, length, 1 / (1 + np.exp(-margin)) - y, cache)
    for array, found in [*((net.p[k], g) for k, g in gradient.items()), (x, dx)]:
        for _ in range(3):
            at = tuple(draw.integers(0, n) for n in array.shape)
            kept = array[at]
            array[at] = kept + 1e-3
            above = loss()
            array[at] = kept - 1e-3
            below = loss()
            array[at] = kept
            assert found[at] == pytest.approx((above - below) / 2e-3, rel=0.02, abs=1e-5)


def test_windows_cover_every_word():
    bounds = np.array([0, 0, 1, 33, 65, 1065])
    row, start, length = toxicity_gru.windows(bounds)
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        covered = {w for r, s, n in zip(row, start, length) if r == i for w in range(s, s + n)}
        assert covered == set(range(a, b))


def test_word_hashes_follow_the_words():
    texts = ["One two\tone", "", None, " é  É ", "two" * 3, "x\n"]
    data, offsets = buffers.text_bytes(pa.array(texts))
    hashes, rows = buffers.words(data, offsets)
    words = [(i, w) for i, t in enumerate(texts) for w in (t or "").replace("O", "o").replace("T", "t").split()]
    assert rows.tolist() == [i for i, _ in words]
    assert len(set(hashes.tolist())) == len({w for _, w in words})
    assert len(set(zip(hashes.tolist(), [w for _, w in words]))) == len({w for _, w in words})
    assert [r[0] for r in buffers.slices(pa.array(texts), 4)] == [0, 1, 3, 4, 5]
