import random

import pytest

from archivolt.operators.graph import capped_clusters, connected_components


def union(nodes, edges, cap=None, free=70):
    parent, size = {n: n for n in nodes}, dict.fromkeys(nodes, 1)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j, s in sorted(edges, key=lambda e: (e[2], e[0], e[1]), reverse=True):
        a, b = find(i), find(j)
        if a != b and (cap is None or s >= free or size[a] + size[b] <= cap):
            parent[max(a, b)] = min(a, b)
            size[min(a, b)] += size[max(a, b)]
    out = {}
    for n in nodes:
        out.setdefault(find(n), set()).add(n)
    return {frozenset(v) for v in out.values()}


def groups(rows, label):
    out = {}
    for r in rows:
        out.setdefault(r[label], set()).add(r["node"])
    return {frozenset(v) for v in out.values()}


@pytest.mark.parametrize("seed", range(4))
def test_against_global_greedy(spark, seed):
    rng = random.Random(seed)
    edges = {}
    for _ in range(90):
        i, j = sorted(rng.sample(range(60), 2))
        edges[i, j] = rng.choice([30, 35, 45, 55, 65, 70, 95])
    rows = [(i, j, s) for (i, j), s in edges.items()]
    nodes = sorted({n for e in edges for n in e})
    df = spark.createDataFrame(rows, "i bigint, j bigint, score int")
    found = capped_clusters(df, cap=6).collect()
    assert groups(found, "cluster") == union(nodes, rows, cap=6)
    assert all(r.cluster == min(x for g in groups(found, "cluster") if r.node in g for x in g) for r in found)
    assert groups(connected_components(df, "i", "j").collect(), "root") == union(nodes, rows)


def test_cap_refuses_and_free_merges(spark):
    chain = [(i, i + 1, 80) for i in range(7)] + [(i, i + 1, 80) for i in range(10, 17)]
    for score, n in ((65, 2), (70, 1)):
        df = spark.createDataFrame([*chain, (0, 10, score)], "i bigint, j bigint, score int")
        assert len(groups(capped_clusters(df).collect(), "cluster")) == n


def test_odd_edges(spark):
    df = spark.createDataFrame([("a", "a"), ("b", None), ("c", "d"), ("c", "d"), ("d", "c")], "u string, v string")
    assert {(r.node, r.root) for r in connected_components(df).collect()} == {("a", "a"), ("c", "c"), ("d", "c")}
    assert connected_components(df.limit(0)).count() == 0


def test_long_path_and_hub(spark):
    path = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1000 + k) for k in range(1, 400)]
    found = connected_components(spark.createDataFrame(path + hub, "u bigint, v bigint")).collect()
    assert {r.root for r in found} == {0, 1000}
