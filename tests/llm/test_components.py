"""Connected components against a plain search."""

import random

import pytest

from quarry.llm._components import components


def _plain(links):
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for start in sorted(near):
        todo = [start] if start not in out else []
        while todo:
            node = todo.pop()
            if node not in out:
                out[node] = start
                todo.extend(near[node])
    return {(n, c) for n, c in out.items()}


def _links(kind):
    rng = random.Random(7)
    if kind == "chain":
        nodes = rng.sample(range(10_000), 200)
        return list(zip(nodes, nodes[1:]))
    if kind == "stars":
        return [(10 * (k // 7) + 1 + k % 7, 10 * (k // 7)) for k in range(70)]
    if kind == "hot node":
        return [(5_000, k) for k in range(300)] + [(k, k + 6_000) for k in range(0, 300, 3)]
    if kind == "two smaller neighbours":
        return [(9, 1), (9, 2), (8, 2), (7, 8)]
    if kind == "own smaller neighbour":
        return [(3, 2), (2, 1)]
    return [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(350)]


@pytest.mark.parametrize("kind", ["chain", "stars", "hot node", "two smaller neighbours", "own smaller neighbour", "random"])
def test_components_equal_a_plain_search(spark, kind):
    links = [(a, b) for a, b in _links(kind) if a != b]
    rows = components(spark, spark.createDataFrame(links + links[:5], "a long, b long")).collect()
    assert len(rows) == len({r["node"] for r in rows})
    assert {(r["node"], r["component"]) for r in rows} == _plain(links)


def test_no_links(spark):
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0
