import numpy as np
import pytest
from pyspark.sql import functions as F

from spolia.llm import grid_join as G


def brute(rows, cosine):
    valid = {}
    for at, (_, v) in enumerate(rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            valid[at] = x / np.sqrt(x @ x)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in valid:
        for b in valid:
            if a < b and valid[a] @ valid[b] >= cosine:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    low = {}
    for at, (key, _) in enumerate(rows):
        low[root(at)] = min(low.get(root(at), key), key)
    return sorted((key, links[at], low[root(at)], low[root(at)] == key) for at, (key, _) in enumerate(rows))


@pytest.mark.parametrize("leaf, tile", [(2048, 128), (16, 4)])
def test_all_links(spark, monkeypatch, leaf, tile):
    monkeypatch.setattr(G, "LEAF", leaf)
    monkeypatch.setattr(G, "TILE", tile)
    rng = np.random.default_rng(leaf)
    rows, size = [], 16
    for _ in range(60):
        center = rng.normal(size=size)
        for _ in range(rng.integers(1, 8)):
            rows.append((len(rows), (center + rng.normal(size=size) * rng.choice([0.02, 0.2])).astype(np.float32).tolist()))
    rows += [(len(rows) + k, rows[3][1]) for k in range(5)]
    n = len(rows)
    rows += [(n, None), (n + 1, [0.0] * size), (n + 2, [None] + [1.0] * (size - 1)), (n + 3, [float("nan")] * size), (n + 4, [float("inf")] * size),
             (n + 5, [2 * x for x in rows[0][1]])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rep", F.lit("clash")).repartition(3)
    got = sorted(tuple(r) for r in G.links(df).collect())
    assert got == brute(rows, 0.95)


def test_small_tables(spark):
    df = spark.createDataFrame([(7, [1.0, 0.0]), (5, [1.0, 0.01]), (6, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, G.links(df).collect())) == [(5, 1, 5, True), (6, 0, 6, True), (7, 1, 5, False)]
    assert G.links(df.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in G.links(nothing).collect()] == [(1, 0, 1, True)]


@pytest.mark.parametrize("leaf", [2048, 2])
def test_lengths_are_joined_apart(spark, monkeypatch, leaf):
    monkeypatch.setattr(G, "LEAF", leaf)
    vectors = [[1.0, 0.0], [1.0, 0.01], [0.0, 1.0], [1.0, 0.02], [0.0, 1.0], [1.0, 0.0, 0.0], [1.0, 0.0, 0.01], [1.0, 0.0, 0.0, 0.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, G.links(df).collect())) == [
        (0, 2, 0, True), (1, 2, 0, False), (2, 1, 2, True), (3, 2, 0, False), (4, 1, 2, False), (5, 1, 5, True), (6, 1, 5, False), (7, 0, 7, True)]
