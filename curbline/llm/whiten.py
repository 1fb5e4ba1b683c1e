"""Whitening of vectors from an exact covariance: bit-sliced scatter, centred as integers before the decomposition.

Components become integers ``floor(scale * c) + offset``. A task takes its vectors in slices: in each it shifts every
dimension by the slice's smallest value and packs the bits of the rest, one plane for each bit, across rows into 64-bit
words. The sum over rows of a product of two dimensions is then the sum over their planes ``p``, ``q`` of
``2**(p + q)`` times the number of bits set in both; the shifts are added back exactly. A task reports one row for each
pair of dimensions; Spark adds these up. What reaches the driver is bounded by the square of the number of
dimensions, whatever the number of rows. Sums are centred as integers (``n * sum(x y) - sum(x) * sum(y)``), so nothing
cancels, and only then become the doubles that ``eigh`` reads.

Rows take part if their vector is not null, not empty, holds no null or non-finite entry, has integers of less than
2**62 in absolute value, and the length that most such vectors have (the larger of lengths that are equally frequent).
Repeated rows and ids count each time, a null id stays null. Only the id and the vector are read, so names can't clash.
Components whose eigenvalue is not above ``FLAT`` of the largest have no direction in double precision and are left
out; a table without rows, or with one vector only, so gives no components (and an empty result). Where the exact
``deviation`` of a row is beyond a long it is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import arrow_map

#: Rows that are packed together: words of 64 rows.
SLICE_ROWS = 1 << 14
#: Eigenvalues below this part of the largest are rounding.
FLAT = 1e-13


def usable(rows: DataFrame, scale: float, offset: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id``, ``x`` (array of long), ``dims`` of the rows whose vectors can take part."""
    small = 2.0 ** 62 - abs(offset)
    scaled = F.transform(F.col(vector_col), lambda c: c.cast("double") * F.lit(float(scale)))
    fine = F.coalesce((F.size(vector_col) > 0) & F.forall(scaled, lambda c: F.coalesce(F.abs(c) < small, F.lit(False))),
                      F.lit(False))
    # nan compares as larger than every number here, so the test drops it too
    return (rows.where(fine).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(scaled, lambda c: F.floor(c).cast("long") + F.lit(offset).cast("long")).alias("x"),
        F.size(vector_col).alias("dims")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes of the columns of non-negative ``y`` (rows by dimensions), each packed across rows into 64-bit words, with
    each plane's dimension and bit. Bits that no row has set make no plane."""
    planes, dims, bits = [], [], []
    padded = np.zeros((-(-len(y) // 64) * 64, y.shape[1]), dtype=np.uint64)
    padded[:len(y)] = y
    for bit in range(int(padded.max(initial=0)).bit_length()):
        set_ = (padded >> np.uint64(bit) & np.uint64(1)).astype(np.uint8)
        used = np.flatnonzero(set_.any(axis=0))
        planes.append(np.packbits(set_[:, used].T, axis=1).view(np.uint64))
        dims.append(used)
        bits.append(np.full(len(used), bit))
    if not planes:
        return np.zeros((0, len(padded) // 64), dtype=np.uint64), np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    return np.concatenate(planes), np.concatenate(dims), np.concatenate(bits)


def cross_products(y: np.ndarray) -> np.ndarray:
    """Exact ``y.T @ y`` of non-negative integers (Python integers), from counts of bits that planes share."""
    planes, dims, bits = bit_planes(y)
    # every sum is below rows * 4**(number of bits)
    narrow = len(planes) == 0 or 2 * int(bits.max() + 1) + len(y).bit_length() < 63
    sums = np.zeros((y.shape[1], y.shape[1]), dtype=np.int64 if narrow else object)
    for k in range(len(planes)):
        shared = np.bitwise_count(planes[k:] & planes[k]).sum(axis=1, dtype=np.int64)
        weight = bits[k:] + int(bits[k])
        weighted = shared << weight if narrow else shared.astype(object) * np.array([1 << int(w) for w in weight] + [None], dtype=object)[:-1]
        np.add.at(sums, (dims[k], dims[k:]), weighted)
        np.add.at(sums, (dims[k + 1:], dims[k]), weighted[1:])
    return sums.astype(object)


@dataclass
class Scatter:
    """Number of rows, sums of each dimension, and of the products of each two, as Python integers."""

    n: int
    sums: np.ndarray
    products: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> Scatter:
        return cls(0, np.zeros(dims, dtype=object), np.zeros((dims, dims), dtype=object))

    def add(self, x: np.ndarray) -> None:
        if not len(x):
            return
        shift = x.min(axis=0).astype(object)
        y = (x - x.min(axis=0)).astype(np.uint64)  # differences of longs under 2**62
        low = y & np.uint64(0xFFFFFFFF)
        y_sums = low.sum(axis=0, dtype=np.uint64).astype(object) + (y >> np.uint64(32)).sum(axis=0, dtype=np.uint64).astype(object) * (1 << 32)
        n = len(x)
        self.n += n
        self.sums = self.sums + y_sums + shift * n
        mixed = np.outer(shift, y_sums)
        self.products = self.products + cross_products(y) + mixed + mixed.T + np.outer(shift, shift) * n

    def centred(self) -> np.ndarray:
        """``n**2`` times the covariance (divisor ``n``), exact."""
        return self.products * self.n - np.outer(self.sums, self.sums)


#: Sums travel in parts of so many bits, so that a million tasks' parts add up in a long.
PART_BITS = 40


def _parts(value: int) -> Iterator[tuple[int, int]]:
    """The value's parts that aren't zero, from the lowest; the last one carries the sign."""
    place = 0
    while value:
        low = value & ((1 << PART_BITS) - 1) if value > 0 or value < -(1 << PART_BITS) else value
        if low:
            yield place, low
        value, place = (value - low) >> PART_BITS, place + 1


def scatter(vectors: DataFrame, dims: int) -> Scatter:
    """The exact scatter of all ``vectors`` (``x``: arrays of ``dims`` longs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scatter.empty(dims)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for start in range(0, len(x), SLICE_ROWS):
                own.add(x[start:start + SLICE_ROWS])
        i, j = np.triu_indices(dims)
        values = {(-2, 0): own.n, **{(-1, k): v for k, v in enumerate(own.sums)},
                  **dict(zip(zip(i.tolist(), j.tolist()), own.products[i, j]))}
        rows = [(*place, part, v) for place, value in values.items() for part, v in _parts(int(value))]
        yield pa.RecordBatch.from_pylist([dict(zip(("i", "j", "part", "v"), r)) for r in rows],
                                         pa.schema([("i", pa.int32()), ("j", pa.int32()), ("part", pa.int32()), ("v", pa.int64())]))

    partial = arrow_map(vectors.select("x"), run, "i int, j int, part int, v long")
    found = Scatter.empty(dims)
    for i, j, part, v in partial.groupBy("i", "j", "part").agg(F.sum("v").alias("v")).collect():
        value = v << PART_BITS * part
        if i == -2:
            found.n += value
        elif i == -1:
            found.sums[j] += value
        else:
            found.products[i, j] += value
            found.products[j, i] = found.products[i, j]
    return found


@dataclass(frozen=True)
class Whitening:
    """Directions (one row each, already divided by the root of their eigenvalue), eigenvalues over their sum, and the
    largest absolute difference between the whitened covariance and the identity."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    explained: np.ndarray
    identity_error: float

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """Whitened rows, and the exact sums of squares of ``n * x - sums`` (None beyond a long)."""
        top = max((abs(s) for s in self.sums), default=0) + self.n * int(np.abs(x).max(initial=0))
        if top < 1 << 62:
            moved = x * np.int64(self.n) - np.array(self.sums, dtype=np.int64)
        else:
            moved = x.astype(object) * self.n - np.array(self.sums, dtype=object)
        # the largest difference decides whether squares can be added in 64 bits
        if moved.dtype != object and int(np.abs(moved).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
            deviation = (moved * moved).sum(axis=1).tolist()
        else:
            deviation = [d if d < 1 << 63 else None for d in (moved.astype(object) ** 2).sum(axis=1)]
        return (moved / self.n).astype(np.float64) @ self.directions.T, deviation


def fit(found: Scatter, components: int) -> Whitening:
    """Unit eigenvectors of the covariance by falling eigenvalue, as far as they have a direction."""
    exact = found.centred()
    covariance = (exact / (found.n * found.n)).astype(np.float64) if found.n else np.zeros(exact.shape)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > FLAT * max(values.max(initial=0.0), 0.0)]
    directions = vectors[:, order].T / np.sqrt(values[order])[:, None]
    apart = np.abs(directions @ covariance @ directions.T - np.eye(len(order)))
    trace = float(sum(exact[k, k] for k in range(len(exact))) / (found.n * found.n)) if found.n else 1.0
    return Whitening(found.n, tuple(int(s) for s in found.sums), directions, values[order] / trace, float(apart.max(initial=0.0)))


def commonest_length(vectors: DataFrame) -> int | None:
    """The length that most vectors have, of equally frequent ones the larger."""
    first = vectors.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    return first["dims"] if first else None


def whiten(rows: DataFrame, components: int = 32, scale: float = 64.0, offset: int = 1_000_000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> tuple[DataFrame, Whitening | None]:
    """Per remaining row ``vec_id``, ``deviation`` and ``whitened`` (array of double), with the model fitted on all of
    them (None where there are none)."""
    vectors = usable(rows, scale, offset, id_col, vector_col)
    dims = commonest_length(vectors)
    form = "vec_id long, deviation long, whitened array<double>"
    if dims is None:
        return rows.sparkSession.createDataFrame([], form), None
    vectors = vectors.where(F.col("dims") == dims)
    model = fit(scatter(vectors, dims), components)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whitened, deviation = sent.value.apply(_matrix(batch.column(1), dims))
            upto = pa.array(np.arange(len(whitened) + 1, dtype=np.int32) * whitened.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(upto, pa.array(whitened.ravel()))],
                ["vec_id", "deviation", "whitened"])

    return arrow_map(vectors.select("vec_id", "x"), run, form), model
