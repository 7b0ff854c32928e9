import random

import pytest

from meridia.llm.components import connected_components


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs_and_a_long_chain(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)]
    chain = list(range(1000, 1060))
    rnd.shuffle(chain)
    edges += list(zip(chain, chain[1:], strict=False)) + [(None, 5), (7, None), (9, 9), edges[0]]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {n: find(n) for n in parent}
    assert len(found) == len(parent)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
