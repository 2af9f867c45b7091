import random

from txrisk.llm.graph import components


def _brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {x: find(x) for x in list(parent)}


def test_components(spark):
    rnd = random.Random(6)
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(5000, x) for x in range(5001, 5400)] + [(x, 9999) for x in range(6000, 6200)]
    some = [(rnd.randrange(10_000, 10_400), rnd.randrange(10_000, 10_400)) for _ in range(180)]
    for edges in (chain, star, some, chain + star + some + [(7, 5003), (-3, 12), (1, 1), (2, 1), (1, 2)], []):
        rnd.shuffle(edges)
        df = spark.createDataFrame(edges, "a long, b long")
        got = {r.node: r.component for r in components(df, "a", "b").collect()}
        assert got == _brute(edges)
