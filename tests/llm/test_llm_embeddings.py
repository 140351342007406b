import math
import random

import numpy as np
import pytest

from ledgerline.llm import embedding_dedup as E


def brute(rows, limit=0.98):
    def able(r):
        return None not in r and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    n, links, parent = len(rows), [0] * len(rows), {r[0]: r[0] for r in rows if r[0] is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(n):
            a, b = rows[i], rows[j]
            if i != j and able(a) and able(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], dtype=np.float32).astype(float), np.array(b[1], dtype=np.float32).astype(float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= limit:
                    links[i] += 1
                    p, q = root(a[0]), root(b[0])
                    parent[max(p, q)] = min(p, q)
    return sorted((r[0] if r[0] is not None else -1, links[i], root(r[0]) if r[0] is not None else -1,
                   r[0] is not None and root(r[0]) == r[0]) for i, r in enumerate(rows))


def vectors(seed=2, big=40):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for c in range(12):
        centre = rng.standard_normal(16)
        for k in range(big if c == 0 else int(rng.integers(1, 5))):
            v = (centre + rng.standard_normal(16) * 0.04 * (k > 0)).tolist()
            for _ in range(int(rng.integers(1, 3))):
                rows.append((i, v, c % 3))
                i += 1
    rows += [(i, None, 0), (i + 1, [0.0] * 16, 0), (i + 2, [], 1), (i + 3, [None] + [1.0] * 15, 1), (i + 4, [float("nan")] * 16, 1),
             (i + 5, [float("inf")] * 16, 1), (i + 6, rows[0][1], None), (None, rows[0][1], 0), (i + 7, rows[0][1][:8], 0), rows[1],
             (i + 8, [1e30 * x for x in rows[0][1]], 0)]
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("window,tile", [(64, 512), (4, 8)])
def test_links_and_components_equal_brute_force(spark, monkeypatch, window, tile):
    monkeypatch.setattr(E, "WINDOW", window)
    monkeypatch.setattr(E, "BLOCK", 4 * window)
    monkeypatch.setattr(E, "TILE", tile)
    rows = vectors()
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, node int")
    got = E.near_duplicates(frame).collect()
    got = sorted((r[0] if r[0] is not None else -1, r[1], r[2] if r[2] is not None else -1, r[3]) for r in got)
    assert got == brute(rows)


def test_recall_on_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [tuple(r) for r in frame.select("vec_id", "embedding", "label").collect()]
    want = brute(rows)
    got = sorted(tuple(r) for r in E.near_duplicates(frame).collect())
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_isolated_pairs_off_centre(spark, monkeypatch):
    """Pairs that share one common direction with all vectors of a large label."""
    monkeypatch.setattr(E, "WINDOW", 4)
    rng = np.random.default_rng(5)
    unit = lambda v: v / np.sqrt((v * v).sum(axis=-1, keepdims=True))
    x = unit(3 * unit(rng.standard_normal(64)) + unit(rng.standard_normal((3000, 64))))     # cosine about 0.9
    x[:200] = unit(x[200:400] + 0.19 * unit(rng.standard_normal((200, 64))))                # pairs of about 0.982
    near = x @ x.T >= 0.98
    rows = [(i, v, 0) for i, v in enumerate(x.astype(np.float32).astype(float).tolist())]
    got = {r[0]: r[1] for r in E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    want = near.sum(axis=1) - 1
    assert want.sum() >= 380 and [got[i] for i in range(len(x))] == want.tolist()


def test_ids_that_stand_for_several_vectors(spark):
    rng = np.random.default_rng(8)
    v, w, u = (rng.standard_normal(16) for _ in range(3))
    z = w + rng.standard_normal(16) * 0.01
    rows = [(1, v, 0), (5, v, 0), (1, w, 0), (7, w, 0), (8, z, 0), (9, u, 0), (8, u, 0), (8, u, 1), (8, None, 0), (10, u, 1)]
    rows = [(i, None if x is None else x.tolist(), n) for i, x, n in rows]
    got = sorted(tuple(r) for r in E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect())
    assert got == brute(rows)
    assert {(i, n) for i, n, _, _ in got} >= {(7, 2), (8, 2)} and {c for i, _, c, _ in got} == {1}


def test_empty_table(spark):
    assert E.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
