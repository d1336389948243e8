import numpy as np
import pytest

from railpulse.llm.components import connected_components


def plain(links):
    root = {}

    def top(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {i: top(i) for i in root}


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(None, 3), (3, None)], [(5, 2)],
    [(k, k + 1) for k in range(60)],  # a long path
    [(0, k) for k in range(1, 300)] + [(299, -7)],  # a star
    [(2, 1), (1, 2), (2, 1), (9, 8), (8, 7), (-3, 9)],
    [tuple(map(int, e)) for e in np.random.default_rng(0).integers(0, 400, (300, 2))],
])
def test_components(spark, links):
    rows = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(rows) == len({r["node"] for r in rows})
    assert {r["node"]: r["component"] for r in rows} == plain(links)
