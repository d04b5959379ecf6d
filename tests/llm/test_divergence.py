"""Awkward rows, many vectorisers and exact large counts; the whole table is compared with SQL in test_queries."""

import duckdb
import pytest
from pyspark.sql import functions as F

import compare
from txrisk.llm import divergence

ROWS = [
    ("en", "a", "One two, TWO three-four é"), ("en", "a", "two two two"), ("en", "b", "one TWO É é"), ("en", "b", None), ("en", "c", "12 34 --"),
    ("en", "c", "three two one"), ("en", None, "two ñandú ünder"), (None, "a", "two"), (None, None, "two three"), ("", "", "two"), ("fr", "a", "un deux"),
    ("fr", "b", "trois"), ("de", "x", None), ("en", "ä", "zwei ééé " * 2000), ("en", "d", "k" * 60_000 + " two"), ("en", "d", "k" * 60_000 + " ninth"),
] * 2 + [("en", "only", "rare")]


@pytest.mark.parametrize("bounds, least", [({}, 1), ({}, 4), ({"model_terms": 8}, 2)])
def test_awkward_rows(spark, bounds, least):
    docs = spark.createDataFrame([(i, *r, 5, "own") for i, r in enumerate(ROWS)], "doc_id long, lang string, source string, text string, rank int, term string")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    query = divergence.ORACLE_SQL.replace("count(*) >= 30", f"count(*) >= {least}")
    found = divergence.divergence_report(docs, min_documents=least, **bounds)
    assert compare.differences(found, con, query) == []


def test_nothing_kept(spark):
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "doc_id long, lang string, source string, text string")
    rows = divergence.divergence_report(docs).collect()
    assert {(r.part, r.value) for r in rows} == {("pair", 0)}
    assert [(r.item, r["rank"]) for r in rows if (r.lang, r.source) == ("fr", "a")] == [("b", 1)]
    assert divergence.divergence_report(docs.limit(0)).collect() == []


def test_top_is_a_parameter(spark):
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "doc_id long, lang string, source string, text string")
    rows = divergence.divergence_report(docs, min_documents=1, top=2).filter("part = 'term'")
    assert rows.groupBy("lang", "source").agg(F.max("rank").alias("r")).agg(F.max("r")).first()[0] == 2


def test_shares_are_exact(spark):
    big = 9 * 10**15 + 7
    row = spark.range(1).select(divergence._share(F.lit(big), F.lit(3 * big + 1), F.lit(12345)).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 5) // (3 * big + 1 + 5 * 12345)
