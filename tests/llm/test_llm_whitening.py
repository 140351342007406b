import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.llm import queries
from ledgerline.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, components=8):
    x = np.array([[math.floor(float(np.float32(c)) * 1024) + 100000 for c in v] for v in rows], dtype=np.int64)
    n, s = len(x), x.sum(0)
    y = x - s / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    deviation = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(r, s)) for r in x]
    return y @ u / np.sqrt(e), e / np.trace(v), deviation


def check(out, rows, components=8):
    white, explained, deviation = expected(rows, components)
    got = np.full(white.shape, np.nan)
    for r in out:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.n == len(rows) and r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-9
    sign = np.sign((got * white).sum(0))
    assert len(out) == white.size and np.abs(got * sign - white).max() < 1e-7


def test_equals_a_dense_decomposition(spark):
    rng = np.random.default_rng(1)
    rows = (rng.standard_normal((700, 80)) * np.linspace(1, 0.2, 80)) @ np.linalg.qr(rng.standard_normal((80, 80)))[0] + 0.7
    df = spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(rows)], SCHEMA)
    check(W.whiten(df).collect(), rows)


def test_close_eigenvalues(spark):
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((3000, 64))
    df = spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(rows)], SCHEMA)
    check(W.whiten(df).collect(), rows)


def test_fewer_dimensions_than_the_block(spark):
    rng = np.random.default_rng(3)
    rows = rng.standard_normal((50, 5)) * [5, 4, 3, 2, 1]
    df = spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(rows)], SCHEMA)
    check(W.whiten(df).collect(), rows, 5)


def test_low_rank(spark):
    rng = np.random.default_rng(4)
    basis = rng.integers(-3, 4, (3, 70))
    rows = (rng.integers(-5, 6, (200, 3)) @ basis) / 1024.0 * 8
    out = W.whiten(spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(rows)], SCHEMA)).collect()
    assert {r.component for r in out} == {1, 2, 3} and len(out) == 600
    assert all(r.identity_error < 1e-8 for r in out)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = rng.standard_normal((40, 6))
    rows = [(i, r.tolist(), 1) for i, r in enumerate(good)]
    odd = [(100, None, 1), (101, [1.0, None, 0, 0, 0, 0], 1), (102, [float("nan")] * 6, 1), (103, [float("inf"), 0, 0, 0, 0, 0], 1),
           (104, [], 1), (105, [1.0, 2.0], 1), (106, [1e30, 0, 0, 0, 0, 0], 1)]
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], n) for i, v, n in rows + odd], SCHEMA)
    out = W.whiten(df.withColumn("x", F.lit("mine")).withColumn("n", F.lit(0))).collect()
    check(out, good, 6)
    again = W.whiten(df.where("vec_id < 40").unionByName(df.where("vec_id < 40").withColumn("vec_id", F.lit(None).cast("long")))).collect()
    assert len(again) == 80 * 6 and sum(r.vec_id is None for r in again) == 240 and {r.n for r in again} == {80}


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], [(1, None, 0)]])
def test_no_variance_no_rows(spark, rows):
    out = W.whiten(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.count() == 0


def test_large_deviation_is_exact_or_null():
    x = np.array([[1 << 40, 0], [0, 0]], dtype=np.int64)
    whole, apart, n = np.array([1 << 39, 0]), [0, 0], 2
    y = (x - whole).astype(float)
    assert W.deviations(x, y, whole, apart, n).to_pylist() == [None, None]
    n = 1 << 20
    x = np.array([[3, 1], [1 << 11, 0]], dtype=np.int64)
    assert W.deviations(x, x.astype(float), np.array([0, 0]), [5, 7], n).to_pylist() == [
        (3 * n - 5) ** 2 + (n - 7) ** 2, ((n << 11) - 5) ** 2 + 49]


def test_query_over_the_table(spark):
    out = queries.op12_embedding_whitening(spark, SF_SMALL).toPandas()
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas().sort_values("vec_id")
    white, _, deviation = expected(table.embedding)
    got = out.pivot(index="vec_id", columns="component", values="whitened").loc[table.vec_id].to_numpy()
    assert np.abs(got * np.sign((got * white).sum(0)) - white).max() < 1e-7
    assert out[out.component == 1].set_index("vec_id").deviation.loc[table.vec_id].tolist() == deviation
