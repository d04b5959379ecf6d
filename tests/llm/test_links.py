"""Every link of the n-gram join, not only as many as connect."""

import itertools

import pytest

from test_signature_tree import rows, shingles
from txrisk.llm import common, signature_tree


@pytest.mark.parametrize("settings", [{}, {"group_shingles": 60}])
def test_all_links_between_different_sets(spark, settings):
    data = rows()
    least, copies = {}, set()
    for i, text in sorted((r for r in data if r[0] is not None and shingles(r[1])), key=lambda r: r[0]):
        first = least.setdefault(frozenset(shingles(text)), i)
        if first != i:
            copies.add((first, i))
    near = {tuple(sorted((least[x], least[y]))) for x, y in itertools.combinations(least, 2) if 100 * len(x & y) >= 90 * len(x | y)}
    assert len(near) > 2 * len({i for pair in near for i in pair})  # more than connect
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    found = [tuple(sorted(r)) for r in signature_tree.similar(df, **settings)[1].collect()]
    assert len(found) == len(set(found)) and set(found) == near | copies


@pytest.mark.parametrize("settings", [{}, {"group_shingles": 60}])
def test_number_of_links_of_every_row(spark, settings):
    data = [*rows(), (40, "a copy with its own id and text"), (40, "a copy with its own id and text"), (41, "A copy with its own id AND text")]
    sets = [(i, shingles(text)) for i, text in data]

    def links(k):
        i, x = sets[k]
        return sum(100 * len(x & y) >= 90 * len(x | y) for j, (h, y) in enumerate(sets) if j != k and h is not None and x and y) if i is not None else 0

    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    want = sorted(((i, len(x), links(k)) for k, (i, x) in enumerate(sets)), key=str)
    assert sum(n for *_, n in want) > 2 * len(want)
    assert sorted(map(tuple, signature_tree.connected(df, **settings)[0].collect()), key=str) == want


def test_rows_grow_no_faster_than_a_group_of_near_copies(spark, monkeypatch):
    """Texts that differ in a word each, all linked with all: no step hands on a row for each of the 44,850 pairs."""
    base = [f"w{i}" for i in range(200)]
    data = [(i, " ".join([*base, f"end{i}"])) for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    written = []

    def staged(frame, name):
        out = common.staged(frame, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(signature_tree, "staged", staged)
    assert [r.doc_id for r in signature_tree.keep_one(df, words=5, numerator=80).collect()] == [0]
    assert {r.n_links for r in signature_tree.join_report(df).collect()} == {299}
    assert "links" in dict(written) and all(n <= 300 for _, n in written), written
