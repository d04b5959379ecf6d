import random

from txrisk.llm import components


def expected(edges):
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for u, v in edges:
        low, high = sorted((find(u), find(v)))
        parent[high] = low
    return {i: find(i) for i in list(parent)}


def test_paths_stars_and_random_graphs(spark):
    draw = random.Random(3)
    ids = draw.sample(range(-10**6, 10**6), 3000)
    edges = list(zip(ids[:800], ids[1:801]))
    edges += [(ids[1000], i) for i in ids[1001:1500]]
    edges += [(draw.choice(ids[1600:]), draw.choice(ids[1600:])) for _ in range(900)]
    edges = [e for e in edges if e[0] != e[1]]
    draw.shuffle(edges)
    df = spark.createDataFrame(edges + [(5 * 10**6, 5 * 10**6)], "u long, v long").repartition(40)
    assert {r.node: r.component for r in components.components(df).collect()} == expected(edges)


def test_no_edges(spark):
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []
