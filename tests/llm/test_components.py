import random

from pktscope.llm.components import connected_components


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 501 + i) for i in range(80)]
    links += [(rng.randint(1000, 1200), rng.randint(1000, 1200)) for _ in range(150)]
    links += [(7, 7), (None, 3), (160, 900), (900, 160)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
