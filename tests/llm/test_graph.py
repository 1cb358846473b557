import random

import pytest

from siltstone.llm.graph import components


def roots(edges):
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {i: root(i) for e in edges for i in e if e[0] != e[1]}


def shapes():
    draw = random.Random(4)
    path = list(range(40))
    draw.shuffle(path)
    yield "none", []
    yield "loop only", [(3, 3)]
    yield "path", [*zip(path, path[1:])]
    yield "star around the largest", [(100, k) for k in range(60)]
    yield "many", [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] * 2


@pytest.mark.parametrize("name, edges", list(shapes()), ids=lambda x: x if isinstance(x, str) else "")
def test_components(spark, no_broadcast, name, edges):
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["component"] for r in found} == roots(edges)
