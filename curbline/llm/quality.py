"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

The pairwise part is computed in linear time by the sum-of-squares identity
``1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``. Words (hashed, lower-cased, weight log(1 + count), scaled
to length 1) and statistics share one index space, so words interact with statistics and with the metadata.

Training takes at most ``max_train`` labelled texts (those with the smallest hash of their id), whatever the size of
the corpus; several labels of one id count by their mean. Scoring is one pass over the texts without a shuffle, the
model's size is fixed by its parameters. A task works on runs of whole texts of about ``SLICE_BYTES`` together, so that
its work arrays don't follow the rows of a batch. Labels that are null teach nothing. Null texts score as empty texts; a null
or negative length statistic counts as 0. Without labelled rows every text scores 0.5. Repeated rows score alike,
columns other than those named are not read.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import arrow_map, ship_package, slices, stored

MAX_TRAIN = 6_000
BUCKETS = 1 << 16
FACTORS = 4
KEPT_WORDS = 150_000
SLICE_BYTES = 1_000_000
STATISTICS = ("bias", "upper", "digit", "blank", "line_end", "stop", "symbol", "bar", "mark", "other", "long_word",
              "new_word", "echo", "new_line_share", "size", "words", "declared", "undeclared")

_of_byte = np.full(256, 8)  # classes: 0 letters, 1 A-Z, 2 digits, 3 blank, 4 line end, 5 stops, 6 symbols, 7 bar, 8 rest
for _class, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                                 b" \t", b"\n\r", b".,;:'\"()-", b"#$%&*+/<=>@[\\]^_`{}~", b"|")):
    _of_byte[list(_chars)] = _class
_of_byte[list(b"!?")] = 9


def statistics(text: str, tokens: list[str], words: Counter, declared: int | None) -> np.ndarray:
    """Structure of the text and its declared length, each between 0 and about 1, in the order of STATISTICS."""
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    size = max(1, len(raw))
    share = np.bincount(_of_byte[raw], minlength=10)[1:] / size
    lines, n_words = text.split("\n"), len(tokens)
    echo = sum(map(operator.eq, tokens, tokens[1:])) / max(1, n_words)
    declared = max(0, declared or 0)
    return np.array([1.0, share[0], share[1], share[2], share[3], share[4], share[5] * 4, share[6] * 4, share[8] * 4,
                     share[7], min(1.0, len(raw) / max(1, n_words) / 20), len(words) / max(1, n_words), echo,
                     len(set(lines)) / len(lines), np.log1p(len(raw)) / 12, np.log1p(n_words) / 12,
                     np.log1p(declared) / 12, min(1.0, abs(declared - len(text)) / size)])


class Features:
    """Sparse rows (``index``, ``value``) of texts: statistics first, hashed words behind them."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.bucket_of = buckets, {}

    def __call__(self, text: str | None, declared: int | None) -> tuple[np.ndarray, np.ndarray]:
        text = text or ""
        tokens = text.lower().split()
        words = Counter(tokens)
        known = self.bucket_of
        if len(known) > KEPT_WORDS:
            known.clear()
        own = np.empty(len(words), dtype=np.int64)
        for k, word in enumerate(words):
            at = known.get(word)
            if at is None:
                at = known[word] = zlib.crc32(word.encode("utf-8")) % self.buckets
            own[k] = at
        weight = np.log1p(np.fromiter(words.values(), np.float64, len(words)))
        weight /= max(1e-12, float(np.sqrt(weight @ weight)))
        return (np.concatenate([np.arange(len(STATISTICS)), own + len(STATISTICS)]),
                np.concatenate([statistics(text, tokens, words, declared), weight]))

    def of(self, texts: pa.Array, declared: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """The rows of some texts, which become strings one at a time."""
        return [self(text.as_py(), n.as_py()) for text, n in zip(texts, declared)]


@dataclass
class Machine:
    """``linear`` (one weight an index) and ``factors`` (index x factor); the bias is the first statistic's weight."""

    linear: np.ndarray
    factors: np.ndarray

    def sums(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logit of each row (rows begin at ``starts``, none is empty) and its sums of factors times values."""
        weighted = self.factors[index] * value[:, None]
        total = np.add.reduceat(weighted, starts, axis=0)
        squares = np.add.reduceat(np.einsum("nf,nf->n", weighted, weighted), starts)
        logit = np.add.reduceat(self.linear[index] * value, starts) + 0.5 * ((total ** 2).sum(axis=1) - squares)
        return logit, total

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        sizes = np.array([len(index) for index, _ in rows])
        logit, _ = self.sums(np.concatenate([index for index, _ in rows]), np.concatenate([v for _, v in rows]),
                             np.cumsum(sizes) - sizes)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, buckets: int = BUCKETS, factors: int = FACTORS,
        epochs: int | None = None, batch: int | None = None, rate: float = 0.03, decay: float | None = None,
        seed: int = 7) -> Machine:
    """Logistic loss, Adam on mini-batches; rows in an order fixed by ``seed``. Both labels weigh alike, however rare one
    is. By default few rows are seen more often, in smaller batches, and their weights decay by one over the number of
    rows, so that what is learned is what rows share and not the words of single rows."""
    rng = np.random.default_rng(seed)
    few = max(1, len(rows))
    epochs = min(200, max(20, 20_000 // few)) if epochs is None else epochs
    batch = (64 if few < 1000 else 256) if batch is None else batch
    decay = 1 / few if decay is None else decay
    positive = float(labels.sum()) if len(rows) else 0.0
    weight_of = np.array([few / max(1.0, 2 * (few - positive)), few / max(1.0, 2 * positive)])
    n = len(STATISTICS) + buckets
    both = np.concatenate([np.zeros((n, 1)), rng.normal(0, 0.05, (n, factors))], axis=1)
    first, second, step = np.zeros_like(both), np.zeros_like(both), 0
    for _ in range(epochs if len(rows) else 0):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            sizes = np.array([len(rows[k][0]) for k in some])
            index, value = (np.concatenate([rows[k][part] for k in some]) for part in (0, 1))
            machine = Machine(both[:, 0], both[:, 1:])
            logit, total = machine.sums(index, value, np.cumsum(sizes) - sizes)
            wrong = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[some]) * weight_of[labels[some].astype(int)]
            wrong = np.repeat(wrong / len(some), sizes)
            slope = np.empty((len(index), 1 + factors))
            slope[:, 0] = wrong * value
            slope[:, 1:] = (wrong * value)[:, None] * (np.repeat(total, sizes, axis=0)
                                                      - both[index, 1:] * value[:, None])
            by = np.argsort(index, kind="stable")
            used, starts = np.unique(index[by], return_index=True)
            slope = np.add.reduceat(slope[by], starts, axis=0) + decay * both[used]
            step += 1
            first[used] = 0.9 * first[used] + 0.1 * slope
            second[used] = 0.99 * second[used] + 0.01 * slope ** 2
            both[used] -= rate * (first[used] / (1 - 0.9 ** step)) / (np.sqrt(second[used] / (1 - 0.99 ** step)) + 1e-8)
    if not len(rows):
        both[:] = 0
    return Machine(both[:, 0].astype(np.float32), both[:, 1:].astype(np.float32))


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", length_col: str = "n_chars", max_train: int = MAX_TRAIN,
          buckets: int = BUCKETS) -> Machine:
    """A machine fitted to the labelled rows where ``learnable`` (an expression over ``doc_id``) holds."""
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label"))
             .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & learnable)
             .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    chosen = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train), "quality-labels")
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.col(length_col).cast("long").alias("declared"))
             .join(F.broadcast(chosen), "doc_id")  # at most max_train rows
             .groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text"),
                                    F.min("declared").alias("declared")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(buckets)
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                found = features.of(part.column(2), part.column(3))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32())),
                     pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32()))],
                    ["doc_id", "label", "index", "value"])

    taught = arrow_map(texts, run, "doc_id long, label int, index array<int>, value array<float>").toArrow()
    taught = taught.sort_by("doc_id")  # at most max_train rows
    rows = [(np.asarray(i.values), np.asarray(v.values, dtype=np.float64))
            for i, v in zip(taught.column("index"), taught.column("value"))]
    return fit(rows, np.asarray(taught.column("label"), dtype=np.float64), buckets)


def batch_scores(machine: Machine, features: Features, texts: pa.Array, lengths: pa.Array) -> pa.Array:
    """The scores of a batch, a run of whole texts at a time."""
    batch = pa.RecordBatch.from_arrays([texts, lengths], ["text", "length"])
    parts = [machine.scores(features.of(part.column(0), part.column(1))) for part in slices(batch, 0, SLICE_BYTES)]
    return pa.array(np.concatenate(parts) if parts else [], pa.float64())


def with_score(docs: DataFrame, machine: Machine, text_col: str = "text", length_col: str = "n_chars",
               name: str = "score", buckets: int = BUCKETS) -> DataFrame:
    """All columns of ``docs`` and ``name``: the probability of label 1, from the whole text."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def scored(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        features = Features(buckets)
        for texts, lengths in batches:
            yield batch_scores(sent.value, features, texts, lengths)

    return docs.withColumn(name, scored(F.col(text_col), F.col(length_col).cast("long")))
