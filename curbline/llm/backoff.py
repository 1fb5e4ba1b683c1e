"""Language-model scores by stupid backoff, computed relationally over the whole corpus.

    S(w | v) = count(v w) / count(v)          if count(v w) >= least_count, in least_documents documents or more
             = alpha * count(w) / N           otherwise

A text's score is the sum of log S over its words, the first word after a begin mark. Words are what stands between
white space, A-Z lower-cased.

``whole_scores`` keeps every word and every pair of words apart, whatever the input's size. Words are keyed by 63 bits
of their hash, pairs by 64 bits made from both words' keys; pairs are dealt by a second hash of both, and only pairs
that agree in both hashes would be counted as one.

The relational part: tasks gather documents into batches of about a million words and store them, each word as its
number in the batch's word list. A batch's distinct words and pairs with their counts are dealt by hash into buckets, one
row for each bucket, and summed there over all batches; the sums go back in the order in which the batch sent its keys,
so neither keys nor document ids travel back. Each batch, met again with its sums, then scores its documents. A word or
pair takes one entry in a batch however often it occurs there, so none fills a bucket. Buckets grow in number with the
input, what a task holds does not: one batch (a longer document is a batch of its own) or one bucket.

Rows that repeat an id (or have none) are scored together as one document; rows without id are not counted towards
least_documents. Null and empty texts have 0 words and score 0. An empty table gives an empty result. Columns other than
those named are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import arrow_map, stored

BATCH_WORDS = 1 << 20
BUCKET_WORDS = 1 << 21
#: Shares by which an earlier form told frequent words apart. Nothing reads them any more; the tests still set them.
HOT_SHARE = 512
FREQUENT_SHARE = 1 << 17

ENCODED = "batch long, n_words long, doc_ids array<long>, sizes array<long>, codes binary, words binary"
SENT = "batch long, bucket int, word_keys binary, word_n binary, pair_keys binary, pair_n binary, pair_documents binary"
TOTALS = "batch long, bucket int, word_n binary, together binary"
SCORES = "doc_id long, n long, log_score double"


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def code_of(word: bytes) -> int:
    """A word's key: 63 bits of its hash, as a negative number."""
    return -(xxhash.xxh64_intdigest(word) >> 1) - 1


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers of 64 bits: all their lowest bytes, then all second ones and so on, compressed."""
    planes = np.ascontiguousarray(numbers.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return len(numbers).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], 8 * n), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).reshape(n)


def encoded(rows: DataFrame, batch_words: int) -> DataFrame:
    """Batches of the documents ``doc_id``, ``text`` (binary): ids, numbers of words, the keys of the different words and
    all words in order, by their places among those. Frequent words come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        ids, found = [], []

        def flush() -> pa.RecordBatch:
            words = np.concatenate(found)
            by_count = np.argsort(-np.bincount(words, minlength=len(numbers)), kind="stable")
            place = np.empty(len(numbers), dtype=np.int64)
            place[by_count] = np.arange(len(numbers))
            codes = np.fromiter(map(code_of, numbers), np.int64, len(numbers))[by_count]
            out = pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | made]), pa.array([len(words)]), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[len(f) for f in found]], pa.list_(pa.int64())), pa.array([packed(codes)]),
                 pa.array([packed(place[words])])], ["batch", "n_words", "doc_ids", "sizes", "codes", "words"])
            numbers.clear(), ids.clear(), found.clear()
            return out

        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                words = words_of(text.as_py())
                ids.append(doc_id.as_py())
                found.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                size += len(words) + 1
                if size > batch_words:
                    yield flush()
                    made, size = made + 1, 0
        if ids:
            yield flush()

    return arrow_map(rows.select("doc_id", "text"), run, ENCODED)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class Dealt:
    """Different keys by bucket, in rising order within each."""

    def __init__(self, keys: np.ndarray, hashes: np.ndarray, buckets: int) -> None:
        bucket = (hashes % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
        order = np.argsort(keys)
        self.order = order[np.argsort(bucket[order], kind="stable")]
        self.keys = keys[self.order]
        self.ends = np.searchsorted(bucket[self.order], np.arange(buckets + 1))

    def cut(self, numbers: np.ndarray, bucket: int) -> np.ndarray:
        return numbers[self.ends[bucket]:self.ends[bucket + 1]]


class Batch:
    """A row of ``encoded`` with its different words, the begin mark last (key 0), and its different pairs."""

    def __init__(self, row: dict, buckets: int) -> None:
        self.ids, self.sizes = row["doc_ids"], np.array(row["sizes"], dtype=np.int64)
        words = unpacked(row["words"]).astype(np.int64)
        codes = np.append(unpacked(row["codes"]), np.uint64(0))
        begins = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[begins] = len(codes) - 1
        self.word_n = np.append(np.bincount(words, minlength=len(codes) - 1), len(begins))
        distinct, self.pair_at, self.pair_n = np.unique(
            before * len(codes) + words, return_inverse=True, return_counts=True)
        self.first, self.second = np.divmod(distinct, len(codes))
        v, w = codes[self.first], codes[self.second]
        self.words = Dealt(codes, mixed(codes), buckets)
        self.pairs = Dealt(
            v * np.uint64(0x9E3779B97F4A7C15) + turned(w, 29) * np.uint64(0xC2B2AE3D27D4EB4F),
            mixed(v * np.uint64(0x165667B19E3779F9) ^ turned(w * np.uint64(0x27D4EB2F165667C5), 31)), buckets)

    def pair_documents(self) -> np.ndarray:
        """In how many of the documents with an id each pair stands."""
        owner = np.repeat(np.arange(len(self.ids)), self.sizes)
        known = np.array([i is not None for i in self.ids])[owner]
        each = np.unique(self.pair_at[known] * len(self.ids) + owner[known])
        return np.bincount(each // max(1, len(self.ids)), minlength=len(self.pair_n))


def sent(batches: Iterator[pa.RecordBatch], buckets: int, least_documents: int) -> Iterator[pa.RecordBatch]:
    """A row for each bucket and batch: keys (differences of rising ones) and counts. No numbers of documents stand for
    one document at least, where no more is asked."""
    fields = SENT.replace(" long", "").replace(" int", "").replace(" binary", "").split(", ")
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if not row["n_words"]:
                continue
            b = Batch(row, buckets)
            word_n, pair_n = b.word_n[b.words.order], b.pair_n[b.pairs.order]
            counted = least_documents > 1 or None in b.ids
            documents = b.pair_documents()[b.pairs.order] if counted else None
            out = []
            for bucket in range(buckets):
                words, pairs = (d.cut(d.keys, bucket) for d in (b.words, b.pairs))
                if len(words) or len(pairs):
                    out.append((row["batch"], bucket, packed(np.diff(words, prepend=np.uint64(0))),
                                packed(b.words.cut(word_n, bucket)), packed(np.diff(pairs, prepend=np.uint64(0))),
                                packed(b.pairs.cut(pair_n, bucket)),
                                packed(b.pairs.cut(documents, bucket)) if counted else None))
            types = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], fields)


def summed(keys: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """For each key the sum of the counts of all keys like it."""
    if not len(keys):
        return [*counts]
    order = np.argsort(keys)
    new = np.append(True, np.diff(keys[order]) != 0)
    group = np.empty(len(keys), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return [np.add.reduceat(n[order], np.flatnonzero(new))[group] for n in counts]


def totals(rows: pa.Table, least_count: int, least_documents: int) -> pa.Table:
    """A bucket's counts over all batches, for each batch in its order; 0 for a pair that is not common."""
    rows = rows.combine_chunks()

    def column(name: str) -> list[np.ndarray]:
        return [unpacked(x.as_py()) for x in rows[name]]

    word_keys, pair_keys, pair_n = ([np.cumsum(x, dtype=np.uint64) for x in column("word_keys")],
                                    [np.cumsum(x, dtype=np.uint64) for x in column("pair_keys")], column("pair_n"))
    documents = [np.ones(len(keys), dtype=np.uint64) if x is None else unpacked(x)
                 for x, keys in zip(rows["pair_documents"].to_pylist(), pair_keys)]
    word_n, = summed(np.concatenate(word_keys), np.concatenate(column("word_n")))
    together, held = summed(np.concatenate(pair_keys), np.concatenate(pair_n), np.concatenate(documents))
    together[(together < max(0, least_count)) | (held < max(0, least_documents))] = 0
    return pa.table([rows["batch"], rows["bucket"], *(
        pa.array([packed(x) for x in np.split(all_n, np.cumsum([len(k) for k in keys])[:-1])], pa.binary())
        for all_n, keys in ((word_n, word_keys), (together, pair_keys)))], ["batch", "bucket", "word_n", "together"])


def scored(batch: pa.Table, found: pa.Table, buckets: int, total: int, alpha: float) -> pa.Table:
    """The scores of a batch's documents by the sums that came back."""
    row = batch.to_pylist()[0]
    b = Batch(row, buckets)
    score = np.zeros(len(b.ids))
    if row["n_words"]:
        found = found.sort_by("bucket")
        alone, together = np.empty(len(b.word_n)), np.empty(len(b.pair_n))
        alone[b.words.order] = np.concatenate([unpacked(x.as_py()) for x in found["word_n"]])
        together[b.pairs.order] = np.concatenate([unpacked(x.as_py()) for x in found["together"]])
        common = together > 0
        log_s = np.log(np.where(common, together, alone[b.second]))
        log_s += np.where(common, -np.log(alone)[b.first], math.log(alpha / total))
        score = np.bincount(np.repeat(np.arange(len(b.ids)), b.sizes), log_s[b.pair_at], len(b.ids))
    return pa.table([pa.array(b.ids, pa.int64()), pa.array(b.sizes), pa.array(score)], ["doc_id", "n", "log_score"])


def whole_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = 0.4,
                 least_count: int = 2, least_documents: int = 1) -> DataFrame:
    """``doc_id``, ``n_words``, ``log_score`` (natural logarithm, summed) of every document, all words kept apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    batches = stored(encoded(rows, BATCH_WORDS), "word-batches")
    total = batches.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    buckets = 1 + total // BUCKET_WORDS
    dealt = arrow_map(batches, partial(sent, buckets=buckets, least_documents=least_documents), SENT)
    summed_up = dealt.groupBy("bucket").applyInArrow(lambda rows: totals(rows, least_count, least_documents), TOTALS)
    found = stored(summed_up, "word-totals", tidy=True)
    scores = batches.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(
        lambda batch, counts: scored(batch, counts, buckets, total, alpha), SCORES)
    return scores.groupBy("doc_id").agg(F.sum("n").alias("n_words"), F.sum("log_score").alias("log_score"))
