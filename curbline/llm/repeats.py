"""Repeated passages across documents, found by level-wise doubling of word windows.

A passage of ``least`` words repeats if the same words also start somewhere in a document with a smaller id. Levels are
``least`` halved while the half stays at ``SHORTEST`` words or more, from short to long (50 words: 25, 50; 200 words:
25, 50, 100, 200). At the first level each window of the final length is represented by one window of that level inside
it: that with the smallest hash, so that equal windows are represented alike and neighbours mostly share theirs. Only
windows whose representative occurs in two documents are extended to the next level: to the window of twice the length
that starts at the representative, or ends with the final window where that would go beyond it. Again only those that
occur in two documents are extended, until none is left or the final length is reached; there the smallest document id
of each window decides. Each level's windows are (hash, document) rows, combined per slice before they are shuffled; the
final level's hash has 128 bits, and everything at a level counts over all documents.

Documents with the same text are looked at once: the one with the smallest id stands for them, and the others, if they
have ``least`` words, are repeated as a whole.

The last level's rows meet the first ids by a sort-merge join, whose skewed keys Spark splits, so that a passage that a
third of all documents share is no task's group. Documents travel once to meet what survives the first level and are
stored then; only documents with survivors are looked at again. What a stored step shuffled is deleted with its end.

Words are what ``[^\\x20\\x09-\\x0D]+`` matches, as they are. Null or empty texts have no words. A null id comes after
all ids: its passages repeat those of any document with an id, and it makes nobody else's a repeat. Rows that share an
id don't repeat each other, as neither's id is smaller; equal rows get equal results. Whether to remove is judged on
the input, not on what is left. Other columns aren't read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import arrow_map, slices, stored

SHORTEST = 20
#: Bytes of texts whose windows are hashed together in one task.
SLICE_BYTES = 1 << 21
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

#: Odd multipliers of the two rolling hashes, and their inverses modulo 2**64.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(f, -1, 1 << 64) for f in _FACTORS)


def levels(least: int) -> list[int]:
    """Window lengths from the first level to ``least``."""
    found = [least]
    while found[0] // 2 >= SHORTEST:
        found.insert(0, -(-found[0] // 2))
    return found


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that order and low bits of the hashes are even."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Windows:
    """Word hashes of some texts one after the other, with the rolling hashes of their windows."""

    def __init__(self, texts: list[bytes]):
        self.words = [WORD.findall(t) for t in texts]
        self.counts = np.array([len(w) for w in self.words], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        known: dict[bytes, int] = {}
        hashed = []
        for words in self.words:
            for word in words:
                if (h := known.get(word)) is None:
                    h = known[word] = xxhash.xxh64_intdigest(word)
                hashed.append(h)
        flat = np.array(hashed, dtype=np.uint64)
        self._sums, self._powers = [], []
        with np.errstate(over="ignore"):
            for k, (factor, inverse) in enumerate(zip(_FACTORS, _INVERSES)):
                own = flat if k == 0 else mixed(flat ^ np.uint64(factor))
                down, up = (np.concatenate([[np.uint64(1)], np.full(len(flat), np.uint64(f))]).cumprod(dtype=np.uint64)
                            for f in (inverse, factor))
                self._sums.append(np.concatenate([[np.uint64(0)], np.cumsum(own * down[:-1], dtype=np.uint64)]))
                self._powers.append(up)

    def hashes(self, at: np.ndarray, length: int, which: int = 0) -> np.ndarray:
        """Hash of the window of ``length`` words that starts at each of ``at``."""
        with np.errstate(over="ignore"):
            total = self._sums[which][at + length] - self._sums[which][at]
            return mixed(total * self._powers[which][at])

    def finals(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows of ``least`` words that lie in one text, and the text of each."""
        per_text = np.maximum(self.counts - least + 1, 0)
        text = np.repeat(np.arange(len(self.counts)), per_text)
        within = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        return self.starts[text] + within, text

    def representatives(self, finals: np.ndarray, least: int, upto: int) -> np.ndarray:
        """For each final window the start of the window that stands for it at level number ``upto``."""
        lengths = levels(least)
        reach = least - lengths[0] + 1
        if reach == 1 or not len(finals):
            return finals
        every = self.hashes(np.arange(int(self.starts[-1]) - lengths[0] + 1), lengths[0])
        seen = np.lib.stride_tricks.sliding_window_view(every, reach)[finals]
        at = finals + seen.argmin(axis=1)
        for length in lengths[1:upto + 1]:
            at = np.minimum(at, finals + least - length)
        return at


Batches = Iterator[pa.RecordBatch]


def _per_slice(handle: Callable[[pa.RecordBatch, Windows], pa.RecordBatch]) -> Callable[[Batches], Batches]:
    """Applies ``handle`` to runs of rows (the text in the first column) with their windows."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in slices(batch, 0, SLICE_BYTES):
                yield handle(part, Windows([t or b"" for t in part.column(0).to_pylist()]))
    return run


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _lists(flat: pa.Array, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), flat)


def _alive(part: pa.RecordBatch, windows: Windows, least: int, level: int, kept_at: int) -> tuple[np.ndarray, np.ndarray]:
    """Final windows (and their texts) whose representative at ``level`` is among the row's kept hashes."""
    finals, text = windows.finals(least)
    if not len(finals):
        return finals, text
    own = windows.hashes(windows.representatives(finals, least, level), levels(least)[level]).view(np.int64)
    kept = part.column(kept_at)
    rows = np.repeat(np.arange(part.num_rows), np.diff(kept.offsets.to_numpy()))
    # one sorted list of (row, hash) pairs; a pair's place in it tells whether it is there
    flat = kept.flatten().to_numpy()
    names, code = np.unique(np.concatenate([flat, own]), return_inverse=True)
    there = np.zeros(0, dtype=bool)
    if len(flat):
        wide = np.int64(len(names))
        there = np.isin(text * wide + code[len(flat):], rows * wide + code[:len(flat)])
    else:
        there = np.zeros(len(finals), dtype=bool)
    return finals[there], text[there]


ROW = "doc_id", "row_id"


def _identified(docs: DataFrame) -> DataFrame:
    """``body`` (UTF-8), ``doc_id``, a hash of the text that tells rows with one id apart, and the text's digest."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(text.cast("binary").alias("body"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("row_id"), F.unhex(F.md5(text)).alias("text_id"))


def _copies(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``row_id`` of the rows whose text a smaller id has too, from ``doc_id``, ``row_id``, ``text_id``."""
    first = (rows.groupBy("text_id").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 and first is not null").select("text_id", "first"))
    return (rows.join(first.hint("merge"), "text_id").where("doc_id > first or doc_id is null").select(*ROW).distinct())


def _level_rows(rows: DataFrame, least: int, level: int, kept_level: int | None) -> DataFrame:
    """``doc_id``, ``row_id``, ``hashes``: each document's distinct windows at ``level``, of the final windows that were
    kept at ``kept_level`` (None: of all)."""
    def handle(part: pa.RecordBatch, windows: Windows) -> pa.RecordBatch:
        finals, text = windows.finals(least) if kept_level is None else _alive(part, windows, least, kept_level, 3)
        at = windows.representatives(finals, least, level)
        at, first = np.unique(at, return_index=True)
        hashes = windows.hashes(at, levels(least)[level])
        return pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in range(1, part.num_columns - (kept_level is not None))),
             _lists(_signed(hashes), np.bincount(text[first], minlength=part.num_rows))], [*named, "hashes"])

    named = [c for c in rows.columns if c not in ("body", "kept")]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*named).schema)
    return arrow_map(rows, _per_slice(handle), f"{types}, hashes array<long>")


def _repeated(level_rows: DataFrame) -> DataFrame:
    """``doc_id``, ``row_id``, ``kept``: per document its hashes that another document id has too."""
    each = level_rows.select(*ROW, F.explode(F.array_distinct("hashes")).alias("hash"))
    shared = (each.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
                                       F.max(F.col("doc_id").isNull()).alias("nameless"))
              .where("low < high or (nameless and low is not null)").select("hash"))
    return (each.join(shared.hint("merge"), "hash").groupBy(*ROW).agg(F.collect_set("hash").alias("kept")))


def _with_kept(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents that kept something: ``body``, ``doc_id``, ``row_id``, ``kept``."""
    d, k = docs.alias("d"), kept.hint("merge").alias("k")
    return d.join(k, _same_row("d", "k")).select("body", "d.doc_id", "d.row_id", "kept")


def _final_windows(rows: DataFrame, least: int, kept_level: int | None) -> DataFrame:
    """``h1``, ``h2``, ``doc_id``, ``row_id``, ``at``: the final windows that are left, with the place of their first
    word in the document."""
    def handle(part: pa.RecordBatch, windows: Windows) -> pa.RecordBatch:
        finals, text = windows.finals(least) if kept_level is None else _alive(part, windows, least, kept_level, 3)
        own = [part.column(c).take(pa.array(text)) for c in (1, 2)]
        return pa.RecordBatch.from_arrays([_signed(windows.hashes(finals, least, which)) for which in (0, 1)]
                                          + own + [pa.array((finals - windows.starts[text]).astype(np.int32))],
                                          ["h1", "h2", *ROW, "at"])

    return arrow_map(rows, _per_slice(handle), "h1 long, h2 long, doc_id long, row_id long, at int")


def repeated_windows(docs: DataFrame, least: int = 50, name: str = "repeats") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents that may hold a repeat (``body``, ``doc_id``, ``row_id``), stored; ``doc_id``, ``row_id``,
    ``starts``: the first words of each one's windows that also start in a document with a smaller id; and ``doc_id``,
    ``row_id`` of the documents that are copies of a smaller id's whole text."""
    rows, lengths = _identified(docs), levels(least)
    found = stored(_level_rows(rows, least, 0, None), f"{name}-{lengths[0]}-hashes", tidy=True)
    copies = stored(_copies(found.select(*ROW, "text_id")), f"{name}-copies", tidy=True)
    f, c = found.where(F.size("hashes") > 0).alias("f"), copies.hint("merge").alias("c")
    found = f.join(c, _same_row("f", "c"), "left_anti").select(*ROW, "hashes")
    rows = rows.select("body", *ROW)
    for level in range(len(lengths) - 1):
        if level:
            found = stored(_level_rows(rows, least, level, level - 1), f"{name}-{lengths[level]}-hashes", tidy=True)
        rows = stored(_with_kept(rows.select("body", *ROW), _repeated(found)), f"{name}-{lengths[level]}", tidy=True)
    if len(lengths) == 1:  # no shorter level: the documents without their copies
        r, c = rows.alias("r"), copies.hint("merge").alias("c")
        rows = stored(r.join(c, _same_row("r", "c"), "left_anti"), f"{name}-single", tidy=True)
    kept_level = len(lengths) - 2 if len(lengths) > 1 else None
    windows = stored(_final_windows(rows, least, kept_level), f"{name}-{least}", tidy=True)
    first = (windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                                             F.max(F.col("doc_id").isNull()).alias("nameless"))
             .where("first < last or (nameless and first is not null)").select("h1", "h2", "first"))
    again = (windows.join(first.hint("merge"), ["h1", "h2"]).where("doc_id > first or doc_id is null")
             .groupBy(*ROW).agg(F.collect_set("at").alias("starts")))
    return rows.select("body", *ROW), stored(again, f"{name}-starts", tidy=True), copies


def _same_row(left: str, right: str) -> Column:
    return ((F.col(f"{left}.row_id") == F.col(f"{right}.row_id"))
            & F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")))


def _kept_words(rows: DataFrame, least: int) -> DataFrame:
    """``doc_id``, ``row_id``, ``n_words``, ``n_removed``, ``kept`` of ``body``, ``doc_id``, ``row_id``, ``starts`` (null:
    none), ``copied`` (the whole text is a repeat)."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            counts, removed, kept = [], [], []
            for body, starts, copied in zip(batch.column(0), batch.column(3), batch.column(4)):
                words = WORD.findall(body.as_py())
                covered = np.zeros(len(words) + 1, dtype=np.int64)
                if copied.as_py() and len(words) >= least:
                    covered[0] = 1
                elif starts.is_valid:
                    at = starts.values.to_numpy()
                    np.add.at(covered, at, 1)
                    np.add.at(covered, at + least, -1)
                gone = np.cumsum(covered[:-1]) > 0
                counts.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if removed[-1] else words))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:3], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(kept, pa.binary())], [*ROW, "n_words", "n_removed", "kept"])

    return arrow_map(rows.select("body", *ROW, "starts", "copied"), run,
                     "doc_id long, row_id long, n_words long, n_removed long, kept binary")


def _marked(copies: DataFrame) -> DataFrame:
    return copies.withColumn("copied", F.lit(True)).hint("merge")


def without_repeats(docs: DataFrame, least: int = 50) -> DataFrame:
    """Per document ``doc_id``, ``n_words``, ``n_removed`` and ``kept``: the words that no repeated window covers, joined
    by one blank, as UTF-8 bytes."""
    _, again, copies = repeated_windows(docs, least)
    d, a, c = _identified(docs).alias("d"), again.hint("merge").alias("a"), _marked(copies).alias("c")
    met = d.join(a, _same_row("d", "a"), "left").join(c, _same_row("d", "c"), "left").select(
        "body", "d.doc_id", "d.row_id", "starts", F.coalesce("copied", F.lit(False)).alias("copied"))
    return _kept_words(met, least).drop("row_id")


def kept_digests(docs: DataFrame, least: int = 50) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` of ``without_repeats``. Only documents with repeats are met
    with them; of all others the digest is taken where they are read, so that their texts never travel."""
    def digests(rows: DataFrame) -> DataFrame:
        return (_kept_words(rows.withColumn("copied", F.lit(False)), least)
                .withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept"))

    rows, again, copies = repeated_windows(docs, least)
    r, a = rows.alias("r"), again.hint("merge").alias("a")
    cut = (digests(r.join(a, _same_row("r", "a")).select("body", "r.doc_id", "r.row_id", "starts"))
           .dropDuplicates([*ROW]).hint("merge").alias("c"))
    whole = digests(_identified(docs).withColumn("starts", F.lit(None).cast("array<int>"))).alias("w")
    m = _marked(copies).alias("m")
    gone = F.col("copied") & (F.col("w.n_words") >= least)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return (whole.join(cut, _same_row("w", "c"), "left").join(m, _same_row("w", "m"), "left").select(
        "w.doc_id", "w.n_words",
        F.when(gone, F.col("w.n_words")).otherwise(F.coalesce("c.n_removed", "w.n_removed")).alias("n_removed"),
        F.when(gone, nothing).otherwise(F.coalesce("c.kept_sha256", "w.kept_sha256")).alias("kept_sha256")))
