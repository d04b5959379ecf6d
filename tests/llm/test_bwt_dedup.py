import collections
import hashlib
import random

import numpy as np

from txrisk.llm import bwt_dedup, queries

N = bwt_dedup.LENGTH


def expected(rows):
    seen = collections.Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[i : i + N] for i in range(len(data) - N + 1))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - N + 1):
            if seen[data[k : k + N]] > 1:
                gone[k : k + N] = b"\1" * N
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def rows():
    draw = random.Random(7)

    def text(n, letters="abcdefgh é\n"):
        return "".join(draw.choice(letters) for _ in range(n))

    passages = [text(n) for n in (150, 198, 199, 200, 201, 230, 369, 400, 900)]
    out = [(None, text(300)), (1, None), (2, ""), (3, "short"), (4, "a" * 1000), (5, "a" * 199), (6, "ab" * 300), (7, "\0" * 450), (7, "x" + "\0" * 300), (8, "Is onhe. " * 90)]
    for i in range(60):
        parts = [text(draw.randrange(0, 300))]
        for _ in range(draw.randrange(4)):
            parts += [draw.choice(passages), text(draw.choice([0, 1, 2, 150]))]
        out.append((100 + i, "".join(parts)))
    out += [(300 + i, out[20 + i][1]) for i in range(5)] + [out[30], (400, out[30][1][5:]), (401, text(5000)), (402, out[-1][1])]
    return out


def test_matches_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 1, 2) for r in data], "doc_id long, text string, block int, keys int").repartition(5)
    assert found(bwt_dedup.dedup_report(df)) == expected(data)
    assert bwt_dedup.dedup_report(df.limit(0)).collect() == []


def test_whole_table(spark, small):
    data = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.QUERIES["op5_bwt_dedup"](spark, small)) == expected(data)


def test_columns_give_the_common_prefixes():
    draw = np.random.default_rng(2)
    content = draw.integers(0, 2, (50, 2 * N - bwt_dedup.GRAM)).astype(np.uint8)
    for _ in range(80):
        i, k = draw.integers(0, 50, 2)
        a = draw.integers(0, 150)
        content[i, a : a + 215] = content[k, a : a + 215]
    full = np.full(50, N - bwt_dedup.GRAM), np.full(50, N)
    got = bwt_dedup.repeated_starts(content, *full, N)
    for c in range(N - bwt_dedup.GRAM + 1):
        strings = [row[c : c + N].tobytes() for row in content]
        count = collections.Counter(strings)
        assert got[:, c].tolist() == [count[s] > 1 for s in strings]
