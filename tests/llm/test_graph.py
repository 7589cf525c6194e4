import random

from addrflow.llm._graph import components


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(201, 260)] + [(300 + i, 300 + (i + 1) % 30) for i in range(30)] + [(7, 7)]
    links += [(400 + rng.randrange(40), 400 + rng.randrange(40)) for _ in range(30)]
    up: dict = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for x in nodes}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
