"""Connected components against union-find."""

import random

from sonomere.llm.components import components


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 130)]  # a chain
    links += [(200, i) for i in range(201, 260)]  # a star
    links += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    links += [(7, 7), (None, 3), (3, None), (1, 2), (2, 1), (1, 2)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert sorted((r.id, r.component) for r in found) == sorted((x, find(x)) for x in parent)
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0
