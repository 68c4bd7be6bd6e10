import random

from strandlake.llm.components import components


def test_components_equal_union_find(spark):
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 300)]
    edges += [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(150)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
