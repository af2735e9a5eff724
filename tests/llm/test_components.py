import random

from footfall.llm.components import connected_components
from tests.llm import brute


def test_chains_stars_and_random_edges(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    edges += [(5, 5), (None, 3), (4, None), (1, 0)]
    nodes = sorted({x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)})
    pairs = set(edges)
    roots = brute.components(nodes, lambda a, b: (a, b) in pairs or (b, a) in pairs)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: nodes[r] for n, r in zip(nodes, roots)}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0
