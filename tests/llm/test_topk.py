"""Exact top-k against all pairs, with ties, unusable vectors and mixed lengths."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import topk


def brute(rows, is_query, k, scale=256):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
              if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in {(i, tuple(v)) for i, v in usable}:
        if is_query(q):
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in usable if i != q and len(y) == len(x))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_equals_all_pairs(spark):
    rng = random.Random(1)
    rows = [(k, [float(np.float32(rng.gauss(0, 1) * (3 if k % 9 == 0 else 1))) for _ in range(24)]) for k in range(230)]
    rows += [(300 + k, rows[k][1]) for k in range(40)]  # equal vectors: ties
    rows += [(400, None), (401, []), (402, [1.0, None] * 12), (403, [float("nan")] * 24), (404, [float("inf")] * 24),
             (None, rows[0][1]), (410, [1.0, 2.0]), (420, [0.0] * 24), (420, [0.0] * 24), (430, [-1.0] * 7)]
    df = (spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
          .withColumn("dims", F.lit(0)))
    for q_block, c_block in ((512, 4096), (4, 16)):
        found = topk.top_k(df, F.col("vec_id") % 10 == 0, k=5, query_block=q_block, candidate_block=c_block)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, found.collect())) == brute([(i, v) for i, v in rows], lambda i: i % 10 == 0, 5)


def test_bounds_drop_candidates_and_keep_the_best():
    rng = np.random.default_rng(2)
    rows = rng.integers(-5, 6, (500, 32))
    rows[:10] += 200  # a cluster far from the rest
    ids = np.arange(500)
    want = [(0, int(i), int(s)) for i, s in sorted(((i, rows[i] @ rows[0]) for i in range(1, 500)), key=lambda p: (-p[1], p[0]))[:5]]
    assert topk.best_of_block(ids[:1], rows[:1], ids, rows, 5) == want


def test_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, F.lit(True)).count() == 0
    # components of any size that a long holds: exact; larger ones take no part
    large = [(0, [1e30, 0.0]), (1, [5000.0, 1.0]), (2, [2.0 ** 22, -3.0]), (3, [-4096.5, 2.0 ** 21]), (4, [1.0, 2.0])]
    found = topk.top_k(spark.createDataFrame(large, "vec_id long, embedding array<double>"), F.lit(True)).collect()
    assert sorted(map(tuple, found)) == brute(large[1:], lambda i: True, 5)


@pytest.mark.parametrize("low,high,n,dims", [(-3, 3, 40, 5), (-300, 300, 200, 64), (0, 2, 30, 1), (5, 6, 9, 4), (-2 ** 29, 2 ** 29, 60, 4),
                                             (-2 ** 31, 2 ** 31, 30, 2)])
def test_blocks_equal_brute_force(low, high, n, dims):
    """Ties, one dimension, scores beyond what doubles hold and beyond 64-bit sums."""
    rng = np.random.default_rng(4)
    rows, ids = rng.integers(low, high, (n, dims)), np.arange(n) * 3
    want = []
    for i in range(0, n, 7):
        scores = [(-sum(int(a) * int(b) for a, b in zip(rows[i], rows[j])), int(ids[j])) for j in range(n) if j != i]
        want += [(int(ids[i]), j, -s) for s, j in sorted(scores)[:5]]
    assert topk.best_of_block(ids[::7], rows[::7], ids, rows, 5) == want
