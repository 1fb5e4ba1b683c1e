"""SimHash near-duplicates: exact links by tiled comparison of fingerprints, then connected components.

1. Each text gets a 64-bit fingerprint from the XXH64 of its word shingles (Arrow batches, no shuffle).
2. Equal fingerprints collapse to one row, so a group of exact copies of any size costs one fingerprint.
3. Fingerprints fall into *cells* by the population counts of their four 16-bit quarters. Two fingerprints within
   ``radius`` bits differ by at most ``radius`` in the sum of the four count differences, so only cells that close
   are compared: the other tile pairs are skipped. There are at most 17**4 cells whatever the input, which bounds
   the broadcast table of cell sizes.
4. A cell is cut into tiles of about ``tile_rows`` fingerprints. A tile travels to the tiles of its neighbour cells,
   and each pair of tiles is compared whole by numpy exclusive-or and bit counts. A pair of tiles reports a
   spanning forest of its links: connectivity is kept, the squares of dense groups are never written.
5. Components come from alternating large-star and small-star steps, each stored in the shared folder.

Null texts count as empty. Texts without words have fingerprint zero and link like any other. Equal rows are
separate rows of the result with the same values; rows with a null id keep null as id and never name a component.
An empty table gives an empty result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import arrow_map, stored

MAX_ROUNDS = 60


def fingerprint(text: bytes | None, shingle_words: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text as an unsigned integer."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle_words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, seed) for s in shingles], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                 seed: int = 42, keep: str | None = None) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's 64 bits as a signed long) for every row, and the long column ``keep``."""
    more = [keep] if keep else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle_words, seed) for t in batch.column(1)),
                                dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]],
                                             ["doc_id", "fp", *more])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("body"), *more)
    return arrow_map(rows, run, ", ".join(["doc_id long", "fp long", *[f"{c} long" for c in more]]))


def _cell(fp):
    """Population counts of the four quarters, each plus 4 in five bits: a neighbour's counts never borrow."""
    total = F.lit(0)
    for k in range(4):
        quarter = F.shiftright(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))
        total = total + F.shiftleft(F.bit_count(quarter) + F.lit(4), 5 * k)
    return total.cast("int")


def _neighbour_steps(radius: int) -> list[int]:
    """Differences of cell codes for count differences that sum to at most ``radius``; each unordered pair once."""
    span = range(-radius, radius + 1)
    steps = {sum(d << (5 * k) for k, d in enumerate(ds))
             for ds in product(span, repeat=4) if sum(map(abs, ds)) <= radius}
    return sorted(s for s in steps if s >= 0)


def forest(left: np.ndarray, right: np.ndarray, radius: int, same: bool, rows: int = 64) -> list[tuple[int, int]]:
    """Links between two tiles that join different groups so far: a spanning forest of all links within ``radius``."""
    n = len(left)
    root = np.arange(n) if same else np.arange(n + len(right))
    own = root[:n] if same else root[n:]  # views: they follow the merges
    links: list[tuple[int, int]] = []
    for start in range(0, n, rows):
        near = np.bitwise_count(left[start:start + rows, None] ^ right[None, :]) <= radius
        if same:
            near &= np.arange(len(right))[None, :] > np.arange(start, min(n, start + rows))[:, None]
        for i in np.flatnonzero(near.any(axis=1)):
            hits = np.flatnonzero(near[i])
            groups, first = np.unique(own[hits], return_index=True)
            for group, k in zip(groups, first):
                mine = root[start + i]
                if group != mine:
                    links.append((int(left[start + i]), int(right[hits[k]])))
                    root[root == group] = mine
    return links


def links(distinct: DataFrame, radius: int = 3, tile_rows: int = 4096) -> DataFrame:
    """``a``, ``b``: links that connect exactly the fingerprints of column ``fp`` that bit distances up to
    ``radius`` connect. ``radius`` may be 0 to 4 (cells leave room for count differences up to 4)."""
    if not 0 <= radius <= 4:
        raise ValueError("radius must be between 0 and 4")
    celled = distinct.select("fp", _cell(F.col("fp")).alias("cell"))
    cells = celled.groupBy("cell").count().select("cell", F.ceil(F.col("count") / tile_rows).cast("int").alias("subs"))
    cells = stored(cells, "simhash-cells")  # at most 17**4 rows
    tiles = (celled.join(F.broadcast(cells), "cell")
             .withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs")).cast("int"))
             .groupBy("cell", "sub").agg(F.collect_list("fp").alias("fps")))
    tiles = stored(tiles, "simhash-tiles")
    steps = F.array(*[F.lit(s) for s in _neighbour_steps(radius)])
    near = cells.select(F.col("cell").alias("to_cell"), F.col("subs").alias("to_subs"))
    sent = (tiles.withColumn("step", F.explode(steps))
            .withColumn("to_cell", F.col("cell") + F.col("step"))
            .join(F.broadcast(near), "to_cell")
            .withColumn("to_sub", F.explode(F.sequence(F.lit(0), F.col("to_subs") - 1)))
            .where((F.col("step") > 0) | (F.col("to_sub") >= F.col("sub")))
            .select("to_cell", "to_sub", F.col("fps").alias("left"),
                    ((F.col("step") == 0) & (F.col("to_sub") == F.col("sub"))).alias("same")))
    pairs = sent.join(tiles.select(F.col("cell").alias("to_cell"), F.col("sub").alias("to_sub"),
                                   F.col("fps").alias("right")), ["to_cell", "to_sub"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            left, right, same = batch.columns
            for k in range(batch.num_rows):
                a, b = (np.asarray(c[k].values, dtype=np.int64).view(np.uint64) for c in (left, right))
                found += forest(a, b, radius, same[k].as_py())
            ends = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["a", "b"])

    return arrow_map(pairs.select("left", "right", "same"), run, "a long, b long")


def _digest(edges: DataFrame) -> tuple:
    """Row count and sum of row hashes: equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node reachable over ``edges`` (``a``, ``b``), for every node that has one.

    Alternating large-star and small-star steps; the number of edges never grows, each step is stored.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), "links")
    state = _digest(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.where("u <> v").union(low.select("u", F.col("low").alias("v"))).distinct()
        edges = stored(small, "small-star")
        before, state = state, _digest(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _rooted(marked: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """``fp``, ``first_id`` (its smallest id), ``root`` (of its group) for every fingerprint of ``marked``."""
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), radius, tile_rows))
    return (distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    radius: int = 3, seed: int = 42, tile_rows: int = 4096) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` (smallest id linked, directly or through others) for every row."""
    marked = stored(fingerprints(docs, id_col, text_col, shingle_words, seed), "simhash-fingerprints")
    rooted = _rooted(marked, radius, tile_rows)
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                  radius: int = 3, seed: int = 42, tile_rows: int = 4096) -> DataFrame:
    """One row of ``docs`` for each group: that with the smallest id (a null id comes last), of several the one whose
    text has the smallest hash, of equal ones any."""
    text_id = F.xxhash64(F.col(text_col).cast("string"))
    marked = stored(fingerprints(docs.withColumn("_text_id", text_id), id_col, text_col, shingle_words, seed, keep="_text_id"),
                    "simhash-fingerprints")
    rooted = _rooted(marked, radius, tile_rows)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_text_id")
    chosen = (marked.join(rooted.select("fp", "root"), "fp").groupBy("root").agg(F.min(order).alias("c"))
              .select(F.col("c.doc_id").alias("_id"), F.col("c._text_id").alias("_chosen")).distinct())
    same = docs[id_col].cast("long").eqNullSafe(F.col("_id")) & (text_id == F.col("_chosen"))
    # rows that agree in id and text are few unless they are copies: any one of them stays
    return docs.join(chosen, same, "left_semi").withColumns({"_id": F.col(id_col), "_text_id": text_id}).dropDuplicates(
        ["_id", "_text_id"]).drop("_id", "_text_id")
