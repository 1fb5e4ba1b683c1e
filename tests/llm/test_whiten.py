"""Exact scatter against Python integers, whitening against its definition; the defined edge cases."""

import numpy as np
import pytest

from conftest import SF_SMALL
from curbline.llm import whiten
from curbline.llm.common import table
from curbline.llm.queries import QUERIES


@pytest.mark.parametrize("low, high, shape", [(0, 500, (1000, 64)), (10 ** 6 - 300, 10 ** 6 + 300, (130, 3)), (-(1 << 61), 1 << 61, (100, 5)),
                                              (0, 1 << 31, (70, 4)), (5, 6, (65, 2)), (-9, 9, (1, 7))])
def test_scatter_is_exact(low, high, shape):
    x = np.random.default_rng(3).integers(low, high, shape)
    own = whiten.Scatter.empty(shape[1])
    for part in (x[:33], x[33:]):
        own.add(part)
    exact = x.astype(object)
    assert own.n == len(x) and (own.sums == exact.sum(axis=0)).all() and (own.products == exact.T.dot(exact)).all()


def test_parts_add_up():
    for value in (0, 1, -1, 1 << 40, -(1 << 40), (1 << 125) + 12345, -(1 << 125) - 12345, (1 << 80) - 1, -(1 << 80) + 1):
        parts = list(whiten._parts(value))
        assert sum(v << whiten.PART_BITS * k for k, v in parts) == value
        assert all(-(1 << 62) < v < 1 << 62 for _, v in parts)


def check(found, x, ids, components):
    """Rows ``(vec_id, component, n, deviation, whitened, explained, identity_error)`` against the definition."""
    n, exact = len(x), x.astype(object)
    centred = exact * n - exact.sum(axis=0)
    v = (centred.T.dot(centred) / n ** 3).astype(float)
    values = np.sort(np.linalg.eigvalsh(v))[::-1][:components]
    assert len(found) == n * len(values)
    w = np.full((n, len(values)), np.nan)
    place = {i: k for k, i in enumerate(ids)}
    deviation = (centred ** 2).sum(axis=1)
    for r in found:
        k = place[r["vec_id"]]
        w[k, r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviation[k] and r["identity_error"] <= 1e-4
        assert np.isclose(r["explained"], values[r["component"] - 1] / np.trace(v), rtol=1e-4, atol=0)
    assert np.abs(w.T @ w / n - np.eye(len(values))).max() < 1e-6 and np.abs(w.mean(axis=0)).max() < 1e-6
    # unscaled, each component's direction is an eigenvector: x's covariance with it is its eigenvalue times it
    for c in range(len(values)):
        along = (centred / n).astype(float).T @ w[:, c] / n
        assert np.isclose(along @ along, values[c], rtol=1e-6)


def test_query_follows_its_definition(spark):
    rows = table(spark, SF_SMALL, "embeddings").collect()
    x = np.floor(64 * np.array([r["embedding"] for r in rows], dtype=np.float64)).astype(np.int64) + 1_000_000
    check(QUERIES["op13_embedding_whitening"](spark, SF_SMALL).collect(), x, [r["vec_id"] for r in rows], 32)


def test_rows_that_take_part(spark):
    rng = np.random.default_rng(1)
    good = [(k, [float(v) for v in rng.normal(size=5)]) for k in range(40)]
    bad = [(50, None), (51, []), (52, [1.0, None, 1.0, 1.0, 1.0]), (53, [float("nan")] * 5), (54, [float("inf")] * 5), (55, [1.0] * 4),
           (56, [1e30] * 5)]
    df = spark.createDataFrame([(i, v, "clash", 2) for i, v in good + bad], "vec_id long, embedding array<double>, x string, dims int")
    found, model = whiten.whiten(df, components=3)
    assert model.n == 40 and sorted(r["vec_id"] for r in found.collect()) == list(range(40))
    assert all(len(r["whitened"]) == 3 for r in found.collect())
    # repeated rows count each time, a null id stays null
    found, model = whiten.whiten(df.where("vec_id < 40").union(df.where("vec_id < 2").withColumn("vec_id", df.vec_id * 0)).unionByName(
        df.where("vec_id = 3").withColumn("vec_id", df.vec_id + None)))
    assert model.n == 43 and sorted((r["vec_id"] for r in found.collect()), key=str) == sorted([*range(40), 0, 0, None], key=str)


def test_flat_directions_empty_tables_and_large_entries(spark):
    form = "vec_id long, embedding array<float>"
    found, model = whiten.whiten(spark.createDataFrame([], form))
    assert model is None and found.count() == 0
    found, model = whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0])], form))
    assert model.n == 1 and [tuple(r["whitened"]) for r in found.collect()] == [()]
    line = [(k, [float(k), 2.0 * k, 7.0]) for k in range(9)]
    found, model = whiten.whiten(spark.createDataFrame(line, form))
    assert len(model.explained) == 1 and abs(model.explained[0] - 1) < 1e-9
    far = [(k, [float(k) * 2.0 ** 50, float(k * k % 7)]) for k in range(9)]
    found, model = whiten.whiten(spark.createDataFrame(far, form))
    assert model.n == 9 and all(r["deviation"] is None for r in found.collect() if r["vec_id"] != 4)


def test_query_on_an_empty_table(spark, tmp_path):
    table(spark, SF_SMALL, "embeddings").where("false").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert QUERIES["op13_embedding_whitening"](spark, str(tmp_path)).count() == 0
