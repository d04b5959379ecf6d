import random
import re

import numpy as np

from txrisk.llm import queries, signature_tree


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else ({tuple(words)} if words else set())


def expected(rows):
    """Brute force over all pairs that share a shingle."""
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    index = {}
    for i, s in sets:
        for token in s:
            index.setdefault(token, []).append(i)
    by_id = {}
    for i, s in sets:
        by_id.setdefault(i, []).append(s)
    pairs = set()
    for ids in index.values():
        if len(ids) < 400:
            pairs |= {(a, b) for a in ids for b in ids if a is not None and b is not None and a < b}
    for a, b in pairs:
        for x in by_id[a]:
            for y in by_id[b]:
                if 100 * len(x & y) >= 90 * len(x | y) and find(a) != find(b):
                    low, high = sorted((find(a), find(b)))
                    parent[high] = low
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in sets), key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"x{draw.randrange(9)}"
    return " ".join(words)


def rows():
    draw = random.Random(5)
    out = [(None, "a b c d"), (1, None), (2, ""), (3, " \t"), (4, "One two"), (5, "one TWO"), (5, "one two"), (6, "one two three")]
    at = 10
    for size in (3, 4, 5, 8, 11, 12, 14, 20, 21, 22, 40, 90, 200, 700):
        base = [f"w{draw.randrange(10**6)}" for _ in range(size)]
        for _ in range(30):
            out.append((at, edited(draw, base, draw.choice([0, 0, 1, 1, 2, max(1, size // 60), size // 30]))))
            at += 1
        for cut in range(1, 4):
            out.append((at, " ".join(base[: max(1, size - cut)])))
            at += 1
    draw.shuffle(out)
    return out


def test_matches_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert found(signature_tree.join_report(df)) == expected(data)


def test_groups_in_several_trees(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    sizes, links = signature_tree.similar(df, group_shingles=60)
    got = {r.node: r.component for r in signature_tree.components(links).collect()}
    assert all(got.get(i, i) == c for i, _, c in expected(data) if i is not None)


def test_whole_table(spark, small):
    data = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.QUERIES["op3_signature_tree"](spark, small)) == expected(data)


def test_empty_table_and_one_kept(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, component long, a int, u long")
    assert found(signature_tree.join_report(empty)) == []
    data = rows()
    df = spark.createDataFrame([(*r, 0, 1, 2) for r in data], "doc_id long, text string, component long, a int, u long")
    kept = signature_tree.keep_one(df)
    assert kept.columns == df.columns
    want = sorted((r for r in expected(data) if r[0] == r[2]), key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [r[0] for r in want]


def test_sizes_in_reach_share_a_class():
    draw = np.random.default_rng(3)
    for numerator in (50, 80, 90):
        for small in (1, 2, 3, 5, 8, 10, 13, 16, 25, 31, 57, 104, 310):
            for large in range(small, small * 100 // numerator + 1):
                tokens = draw.integers(1, 2**62, large).astype(np.uint64)
                sets = np.concatenate([np.sort(tokens[:small]), np.sort(tokens)])
                keys, owner = signature_tree.part_keys(sets, np.array([0, small, small + large]), numerator, 100)
                assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist()), (numerator, small, large)


def test_nested_sets_at_lower_likeness(spark):
    """Each text and a copy with 15 to 25 % more text: five-word shingles at 0.8, against brute force."""
    data, linked = [], set()
    for small in (8, 13, 16, 25, 31, 104, 310):
        for more in range(small * 115 // 100, small * 5 // 4 + 1):
            words = [f"w{len(data)}x{i}" for i in range(more + 4)]
            at = len(data)
            data += [(at, " ".join(words[: small + 4])), (at + 1, " ".join(words))]
            a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words[: small + 4], words))
            if 100 * len(a & b) >= 80 * len(a | b):
                linked.add(at)
    assert len(linked) > 30
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in signature_tree.keep_one(df, words=5, numerator=80).collect()}
    assert {at for at in range(0, len(data), 2) if at + 1 not in kept} == linked
    assert set(range(0, len(data), 2)) <= kept


def test_common_lines_do_not_route_texts_together(spark):
    """Texts that share a long passage, but no likeness, stay apart; a row order or a sample changes no link."""
    draw = random.Random(8)
    line = " ".join(f"line{i}" for i in range(60))
    data = [(i, line + " " + " ".join(f"w{draw.randrange(10**9)}" for _ in range(100))) for i in range(300)]
    data += [(1000 + i, line) for i in range(5)] + [(2000 + i, data[i][1] + " more") for i in range(20)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    assert found(signature_tree.join_report(df)) == expected(data)
    shared = np.sort(draw_tokens(draw, 30))
    sets = [np.sort(np.concatenate([draw_tokens(draw, 90), shared])) for _ in range(40)]
    bounds = np.cumsum([0, *map(len, sets)])
    keys, _ = signature_tree.part_keys(np.concatenate(sets), bounds, 80, 100, shared)
    assert len(keys) == len(set(keys.tolist()))


def test_sets_with_common_tokens_meet():
    """Sets at the likeness asked for agree in a key whatever is taken for common, little of them or nearly all."""
    draw = random.Random(4)
    for numerator in (50, 80, 90):
        for size in (1, 2, 5, 9, 20, 60, 200, 700):
            for share in (0.0, 0.1, 0.3, 0.5, 0.9, 1.0):
                body = draw_tokens(draw, size)
                # Replace as many tokens as the likeness allows: 100 (n - k) >= numerator (n + k).
                k = size * (100 - numerator) // (100 + numerator)
                other = np.concatenate([body[k:], draw_tokens(draw, k)])
                common = np.sort(np.array(draw.sample(body.tolist(), int(share * size)), np.uint64))
                both = np.concatenate([np.sort(body), np.sort(other)])
                keys, owner = signature_tree.part_keys(both, np.array([0, size, 2 * size]), numerator, 100, common)
                assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist()), (numerator, size, share)


def draw_tokens(draw, n):
    return np.array([draw.randrange(1, 2**63) for _ in range(n)], np.uint64)


def test_many_rows_of_one_id(spark):
    """A thousand rows of one id, alike and different: linked through the id, and sent on once each."""
    draw = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    data = [(1, edited(draw, base, i % 3)) for i in range(500)] + [(1, " ".join(f"u{draw.randrange(10**6)}" for _ in range(30))) for _ in range(500)]
    data += [(2, " ".join(base)), (3, " ".join(base) + " z"), (4, "else where is no thing alike")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.component_id) for r in signature_tree.join_report(df).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}
