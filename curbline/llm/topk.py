"""Exact top-k by integer inner product with bounds from multi-resolution segment statistics.

A vector is cut into 1, 2, 4, ... segments; each segment has a mean and a deviation. For two vectors the squared
distance is at least ``sum(len * ((mean - mean')^2 + (dev - dev')^2))`` over the segments of any resolution, so their
inner product is at most ``(|q|^2 + |x|^2 - that) / 2``. Queries meet candidates in blocks of bounded size: from coarse
to fine, candidates whose bound falls short of the query's k-th best exact score so far are dropped, and exact scores
are computed for the survivors only. The bounds carry a margin for rounding, so the result is exact.

Queries are a stated set; they travel in blocks to the blocks of candidates (hash-dealt, so no block depends on the
order or labels of rows), each pair of blocks reports at most k rows a query, and a final ranking merges them. Memory
per task follows the block sizes. Vectors that are null or hold null or non-finite components take no part, nor do
empty vectors; vectors meet vectors of the same length only. Components are quantised to ``floor(scale * x)``, which a
long must hold (``BEYOND``); where products could overflow they are Python's integers, and a score that no long holds is
the nearest that one does. A repeated id is several candidates; a row is no
candidate for queries with its own id. Equal query rows ask one question. Rows with a null id take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import arrow_map, stored

#: Components of this size after scaling, and larger ones, are beyond a long with the others: their rows take no part.
BEYOND = 2.0 ** 62


def quantised(rows: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id``, ``x`` (array of int), ``dims`` of the rows that take part."""
    usable = (F.col(id_col).isNotNull() & (F.size(vector_col) > 0)
              & F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x)
                         & (F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(BEYOND))))
    ints = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    return (rows.where(F.coalesce(usable, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("x"), F.size(vector_col).alias("dims")))


def segment_statistics(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For 1, 2, 4, ... segments: lengths, means and deviations of the rows of ``x``."""
    n, levels, parts = x.shape[1], [], 1
    while parts <= max(1, n // 2):
        cuts = np.linspace(0, n, parts + 1).astype(int)
        size = np.diff(cuts).astype(np.float64)
        total = np.add.reduceat(x, cuts[:-1], axis=1)
        mean = total / size
        spread = np.sqrt(np.maximum(np.add.reduceat(x * x, cuts[:-1], axis=1) / size - mean ** 2, 0.0))
        levels.append((size, mean, spread))
        parts *= 2
    return levels


def _exact(queries: np.ndarray, rows: np.ndarray, q: np.ndarray, c: np.ndarray, wide: bool) -> np.ndarray:
    """Inner products of the pairs (``q``, ``c``): 64-bit integers, or Python's where these could overflow."""
    found = []
    for at in range(0, len(q), 1 << 16):
        left, right = queries[q[at:at + (1 << 16)]], rows[c[at:at + (1 << 16)]]
        found.append((left.astype(object) * right).sum(axis=1) if wide else np.einsum("nd,nd->n", left, right))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def best_of_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray,
                  k: int) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of each query's ``k`` best of a block of candidates, ties to the smaller id.

    With the roots of the segment lengths as weights a level's means and deviations are vectors, and the bound of a pair
    is their product plus a term of either side: a level's bounds of the whole block are one matrix product.
    """
    q, x = queries.astype(np.float64), rows.astype(np.float64)
    q_norm, x_norm = (q * q).sum(axis=1), (x * x).sum(axis=1)
    largest = [int(max(-int(v.min()), int(v.max()))) if v.size else 0 for v in (queries, rows)]
    wide = queries.shape[1] * largest[0] * largest[1] >= 1 << 63
    floor = np.full(len(q), -np.inf)  # an exact score that k candidates reach
    alive = ids[None, :] != query_ids[:, None]
    enough = alive.sum(axis=1) >= k
    levels = list(zip(segment_statistics(q), segment_statistics(x)))
    for level, ((size, q_mean, q_dev), (_, x_mean, x_dev)) in enumerate(levels):
        weight = np.sqrt(size)
        q_at, x_at = (np.concatenate([mean * weight, dev * weight], axis=1) for mean, dev in ((q_mean, q_dev), (x_mean, x_dev)))
        bound = q_at @ x_at.T
        bound += ((q_norm - (q_at * q_at).sum(axis=1)) / 2)[:, None]
        bound += ((x_norm - (x_at * x_at).sum(axis=1)) / 2)[None, :]
        # rounding of sums of this size is far below a millionth of the norms
        bound += 1e-6 * (1 + q_norm[:, None] + x_norm[None, :])
        bound[~alive] = -np.inf
        if level in (0, len(levels) // 2, len(levels) - 1) and len(ids) > k:
            likely = np.argpartition(bound, len(ids) - k, axis=1)[:, len(ids) - k:]
            score = _exact(queries, rows, np.repeat(np.arange(len(q)), k), likely.ravel(), wide).reshape(-1, k)
            reached = score.min(axis=1).astype(np.float64)
            # the next smaller double: a score beyond 2**53 may have been rounded up
            floor = np.where(enough, np.maximum(floor, np.nextafter(reached, -np.inf)), floor)
            alive &= bound >= floor[:, None]
        else:
            alive &= bound >= floor[:, None]
    of_query, of_row = np.nonzero(alive)
    if queries.shape[1] * largest[0] * largest[1] < 1 << 53:
        # doubles hold such sums exactly: one product for the candidates that some query has left
        left = np.flatnonzero(alive.any(axis=0))
        place = np.zeros(len(ids), dtype=np.int64)
        place[left] = np.arange(len(left))
        score = (q @ x[left].T)[of_query, place[of_row]].astype(np.int64)
        # only scores that reach a query's k-th best need an order
        if len(score):
            kept = score >= floor[of_query]
            of_query, of_row, score = of_query[kept], of_row[kept], score[kept]
    else:
        score = _exact(queries, rows, of_query, of_row, wide)
    if wide:
        order = np.array(sorted(range(len(score)), key=lambda j: (of_query[j], -score[j], ids[of_row[j]])), dtype=np.int64)
    else:
        order = np.lexsort((ids[of_row], -score, of_query))
    starts = np.searchsorted(of_query[order], np.arange(len(q) + 1)) if len(order) else np.zeros(len(q) + 1, dtype=int)
    found = []
    for i in range(len(q)):
        for j in order[starts[i]:min(starts[i + 1], starts[i] + k)]:
            found.append((int(query_ids[i]), int(ids[of_row[j]]), max(-(1 << 63), min((1 << 63) - 1, int(score[j])))))
    return found


def _blocks(rows: DataFrame, rows_per_block: int, prefix: str) -> DataFrame:
    """Blocks of about ``rows_per_block`` rows of one vector length, dealt by a hash of the id: numbers, ids, rows."""
    sizes = (rows.groupBy("dims").count()
             .select("dims", F.ceil(F.col("count") / rows_per_block).cast("int").alias("blocks")))
    dealt = (rows.join(sizes, "dims")
             .withColumn("block", F.pmod(F.xxhash64("vec_id", F.hash("x")), F.col("blocks")).cast("int")))
    return dealt.groupBy("dims", "block").agg(F.collect_list(F.struct("vec_id", "x")).alias("rows")).select(
        "dims", F.col("block").alias(f"{prefix}_block"), F.col("rows.vec_id").alias(f"{prefix}_ids"),
        F.flatten("rows.x").alias(f"{prefix}_rows"))


def top_k(rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding", query_block: int = 512, candidate_block: int = 4096) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` best candidates of every row where ``is_query`` (an
    expression over ``vec_id``) holds, against all rows but its own."""
    usable = quantised(rows, scale, id_col, vector_col)
    asked = usable.where(is_query).dropDuplicates(["vec_id", "x"])
    queries = stored(_blocks(asked, query_block, "q"), "topk-queries")
    candidates = stored(_blocks(usable, candidate_block, "c"), "topk-candidates")
    # each query block goes to every candidate block of its vector length: the stated set against all rows, in blocks
    meetings = (queries.select("dims", "q_block").join(candidates.select("dims", "c_block"), "dims"))
    met = meetings.join(queries, ["dims", "q_block"]).join(candidates, ["dims", "c_block"])
    # a pair of blocks is much work for its few bytes: the pairs are dealt by number, not by size
    pairs = queries.count() * candidates.count()
    met = met.repartition(max(1, min(pairs, 4 * rows.sparkSession.sparkContext.defaultParallelism)), "q_block", "c_block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int, int]] = []
            for row in range(batch.num_rows):
                dims = batch.column(0)[row].as_py()
                q_ids, q_rows, c_ids, c_rows = (np.asarray(batch.column(c)[row].values) for c in range(1, 5))
                found += best_of_block(q_ids, q_rows.reshape(-1, dims), c_ids, c_rows.reshape(-1, dims), k)
            table = np.array(found, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(table[:, c].copy()) for c in range(3)],
                                             ["query_id", "vec_id", "score"])

    best = arrow_map(met.select("dims", "q_ids", "q_rows", "c_ids", "c_rows"), run,
                     "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
