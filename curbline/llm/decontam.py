"""Benchmark decontamination by edit distance: CGK embedding, bit-sampling LSH, exact verification.

Texts and items are word sequences (what stands between white space, lower-cased, only its letters and digits; what
has none is no word). The CGK random walk turns a window of
``n`` words into a string of ``3 n`` symbols: at step ``j`` it writes the word it stands on and moves on if a random
bit of (``j``, word) is 1, so windows at small edit distance come out at small Hamming distance. ``tables`` hash
tables over ``walks`` walks each sample ``samples`` places of that string; a window that agrees with an item's in all
sampled places of any table is a candidate. Every candidate is verified exactly: the smallest edit distance (words
inserted, deleted, replaced) of the *whole* item to any stretch of the text around it; an item is found if that is
at most ``max_edit`` of the item's words.

Sizes: windows are item-sized by classes. A class of ``n`` words takes the items whose shortest allowed copy still
holds a window of ``n`` words at each multiple of ``n / 2``, so a text is cut at these multiples only, while all
windows of the (few) items are indexed, at every offset: any copy, wherever it starts, holds an aligned window whose
twin is indexed. With the defaults a copy without edits is always found; measured recall for edited copies is in the
README. Work per word of text is constant, nothing is shuffled, and memory follows ``slice_words``.

Items travel to the tasks in blocks of at most ``block_items``; more items mean more passes, not larger broadcasts.
Null and empty texts contain nothing; null, empty and wordless items are found nowhere. Rows of the result are
distinct pairs: repeated documents or items give one row per id pair, with the smallest distance. Columns other than
those named are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import arrow_map, ship_package

BLOCK_ITEMS = 20_000
_not_word = re.compile(r"[\W_]+")
MIX = np.uint64(0x9E3779B97F4A7C15)
KEPT_WORDS = 200_000


@dataclass(frozen=True)
class Settings:
    max_edit: float = 0.2
    walks: int = 2
    tables: int = 8
    samples: int = 4
    seed: int = 11
    slice_words: int = 400_000


class _Codes(dict):
    """Token -> code of its letters and digits, lower-cased; 0 if it has none."""

    def __missing__(self, token: str) -> int:
        raw = _not_word.sub("", token.lower()).encode("utf-8")
        code = (zlib.crc32(raw) << 31 ^ zlib.crc32(raw, 0x9E3779B9)) or 1 if raw else 0
        self[token] = code
        return code


class WordCodes:
    """The words of a text as integers; tokens without letters and digits are left out."""

    def __init__(self) -> None:
        self.known = _Codes()

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = text.split() if text else []
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        codes = np.fromiter(map(self.known.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        return codes[codes != 0]


def window_size(n_words: int, max_edit: float) -> int:
    """The class of an item: the largest power of two ``n`` such that any copy within ``max_edit``, wherever it
    starts, holds a whole window of ``n`` words that begins at a multiple of ``max(1, n // 2)``."""
    shortest = n_words - int(max_edit * n_words)
    n = 1
    while 2 * n + n - 1 <= shortest:
        n *= 2
    return n


def stride(n: int) -> int:
    return max(1, n // 2)


def embedded(windows: np.ndarray, turns: np.ndarray, wanted: list[int]) -> np.ndarray:
    """CGK embeddings of windows (one a row): the symbols written at the steps ``wanted``, one a row. A window is
    followed by zeros; a walk stays on a zero, as no turn moves it."""
    count, n = windows.shape
    steps = wanted[-1] + 1
    flat = np.zeros((count, n + steps), dtype=np.int64)
    flat[:, :n] = windows
    flat = flat.ravel()
    at = np.arange(count, dtype=np.int64) * (n + steps)
    keep = {j: k for k, j in enumerate(wanted)}
    out = np.empty((len(keep), count), dtype=np.int64)
    for j in range(steps):
        symbol = flat.take(at)
        if j in keep:
            out[keep[j]] = symbol
        symbol *= turns[j]
        symbol >>= 63  # -1 if the word's bit at this step is set
        at -= symbol
    return out


def keys(windows: np.ndarray, settings: Settings, chunk: int = 8_192) -> np.ndarray:
    """One hash key a table (row) and window (column)."""
    n = windows.shape[1]
    # of the 3 n steps, the later ones mostly stand past the end; each sample comes from a stretch of its own, so that
    # it mostly sees a word of its own
    cuts = np.linspace(0, max(settings.samples, 3 * n // 2), settings.samples + 1).astype(int)
    found = np.empty((settings.tables, len(windows)), dtype=np.uint64)
    for walk in range(settings.walks):
        rng = np.random.default_rng([settings.seed, walk, n])
        turns = rng.integers(-1 << 62, 1 << 62, int(cuts[-1])) * 2 + 1
        tables = range(walk, settings.tables, settings.walks)
        places = [rng.integers(cuts[:-1], cuts[1:]) for _ in tables]
        wanted = np.unique(np.concatenate(places))
        for start in range(0, len(windows), chunk):
            part = slice(start, start + chunk)
            symbols = embedded(windows[part], turns, wanted.tolist()).view(np.uint64)
            for table, own in zip(tables, places):
                key = np.full(symbols.shape[1], table * 0x10001 + n, dtype=np.uint64)
                for place in np.searchsorted(wanted, own):
                    key = (key ^ symbols[place]) * MIX
                    key ^= key >> np.uint64(29)
                found[table, part] = key
    return found


def all_windows(codes: np.ndarray, n: int, starts: np.ndarray) -> np.ndarray:
    return codes[starts[:, None] + np.arange(n)]


def nearest(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """Smallest edit distance of ``item`` to any stretch of ``text`` if at most ``most``, with the stretch
    (leftmost end, then its latest start)."""
    m, n = len(item), len(text)
    score, begin = np.arange(m + 1), np.zeros(m + 1, dtype=np.int64)
    best = (m, 0, 0)
    rows = np.arange(m + 1)
    for j in range(n):
        # column j + 1: from the left (text word skipped), the diagonal (matched or replaced), then from above
        left, diagonal = score + 1, np.concatenate([[0], score[:-1] + (item != text[j])])
        origin = np.concatenate([[j + 1], begin[:-1]])
        step = np.where(diagonal <= left, diagonal, left)
        start = np.where(diagonal <= left, origin, begin)
        step[0], start[0] = 0, j + 1
        low = np.minimum.accumulate(step - rows)  # deletions of item words: running minimum along the column
        source = np.maximum.accumulate(np.where(step - rows == low, rows, 0))
        score, begin = low + rows, start[source]
        if score[m] < best[0]:
            best = (int(score[m]), int(begin[m]), j + 1)
    return best if best[0] <= most else None


class Index:
    """The windows of a block of items, by class and table."""

    def __init__(self, items: list[tuple[int, str]], settings: Settings):
        codes = WordCodes()
        self.settings = settings
        self.items = [(item_id, words) for item_id, text in items if len(words := codes(text))]
        by_size: dict[int, list[tuple[int, int]]] = {}
        for k, (_, words) in enumerate(self.items):
            n = window_size(len(words), settings.max_edit)
            by_size.setdefault(n, []).extend((k, start) for start in range(len(words) - n + 1))
        self.classes = []
        for n, places in sorted(by_size.items()):
            windows = np.stack([self.items[k][1][start:start + n] for k, start in places])
            found = keys(windows, settings)
            filters = np.zeros((len(found), 1 << 16), dtype=bool)
            tables = []
            for t, key in enumerate(found):
                filters[t, key >> np.uint64(48)] = True
                order = np.argsort(key, kind="stable")
                tables.append((key[order], order))
            self.classes.append((n, np.array(places), filters, tables))

    def find(self, texts: list[np.ndarray]) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(text number, item number) -> (edit distance, first word, word after the last)."""
        whole = np.concatenate([*texts, np.zeros(0, np.int64)])
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        begins = np.cumsum(sizes) - sizes
        suspects: set[tuple[int, int, int]] = set()  # text, item, where the item would begin in the text
        for n, places, filters, tables in self.classes:
            step = stride(n)
            per_text = np.maximum(0, (sizes - n) // step + 1)
            owner = np.repeat(np.arange(len(texts)), per_text)
            if not len(owner):
                continue
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)) * step
            found = keys(all_windows(whole, n, begins[owner] + start), self.settings)
            for t, key in enumerate(found):
                some = np.flatnonzero(filters[t, key >> np.uint64(48)])
                sorted_keys, order = tables[t]
                low, high = (np.searchsorted(sorted_keys, key[some], side) for side in ("left", "right"))
                hits = high > low
                for w, lo, hi in zip(some[hits], low[hits], high[hits]):
                    for item, offset in places[order[lo:hi]]:
                        suspects.add((int(owner[w]), int(item), int(start[w] - offset)))
        stretches: dict[tuple[int, int], list[list[int]]] = {}
        for text, item, begin in sorted(suspects):
            size = len(self.items[item][1])
            most = int(self.settings.max_edit * size)
            low, high = max(0, begin - 2 * most), min(int(sizes[text]), begin + size + 2 * most)
            known = stretches.setdefault((text, item), [])
            if known and low <= known[-1][1]:  # begins come in order: overlapping stretches are checked as one
                known[-1][1] = max(known[-1][1], high)
            else:
                known.append([low, high])
        result: dict[tuple[int, int], tuple[int, int, int]] = {}
        for (text, item), known in stretches.items():
            words = self.items[item][1]
            most, spelled = int(self.settings.max_edit * len(words)), words.tolist()
            for low, high in known:
                stretch = texts[text][low:high]
                if sum(map(set(stretch.tolist()).__contains__, spelled)) < len(words) - most:
                    continue  # each word that isn't there costs an edit
                best = nearest(words, stretch, most)
                if best and ((text, item) not in result or best[0] < result[text, item][0]):
                    result[text, item] = (best[0], low + best[1], low + best[2])
        return result


def _runs(codes: Iterable[np.ndarray], most_words: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Runs of whole texts of about ``most_words`` words, with the number of the first."""
    first, size, run = 0, 0, []
    for text in codes:
        run.append(text)
        size += len(text)
        if size >= most_words:
            yield first, run
            first, size, run = first + len(run), 0, []
    if run:
        yield first, run


def item_blocks(items: DataFrame, item_col: str = "item_id", text_col: str = "text",
                block_items: int = BLOCK_ITEMS) -> Iterator[list[tuple[int, str]]]:
    """The items with their ids, at most ``block_items`` at a time (read one partition at a time)."""
    rows = (items.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t"))
            .where("i is not null and t is not null").distinct())
    block: list[tuple[int, str]] = []
    for row in rows.toLocalIterator():
        block.append((row["i"], row["t"]))
        if len(block) >= block_items:
            yield block
            block = []
    if block:
        yield block


def contaminations(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text",
                   settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``item_id``, ``edit_distance``, ``item_words``, ``first_word``, ``last_word`` (the stretch of the
    text, counted in words): one row for each document and item it holds."""
    schema = "doc_id long, item_id long, edit_distance int, item_words int, first_word int, last_word int"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = []
    for block in item_blocks(items, item_col, item_text_col):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index, codes = Index(sent.value, settings), WordCodes()
            for batch in batches:
                ids, out = batch.column(0), []
                for first, texts in _runs((codes(t.as_py()) for t in batch.column(1)), settings.slice_words):
                    for (text, item), (distance, begin, end) in index.find(texts).items():
                        out.append((ids[first + text].as_py(), index.items[item][0], distance,
                                    len(index.items[item][1]), begin, end - 1))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("doc_id", "item_id", "edit_distance", "item_words", "first_word", "last_word"), r))
                     for r in out], schema=_arrow_schema)

        parts.append(arrow_map(rows, run, schema))
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    found = reduce(DataFrame.union, parts)
    best = F.min(F.struct("edit_distance", "item_words", "first_word", "last_word"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


_arrow_schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edit_distance", pa.int32()),
                           ("item_words", pa.int32()), ("first_word", pa.int32()), ("last_word", pa.int32())])


def _clean(sent: Broadcast, settings: Settings) -> Callable[[Column], Column]:
    """A function of a text: True if it holds no item of the block."""

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, codes = Index(sent.value, settings), WordCodes()
        for texts in batches:
            good = np.ones(len(texts), dtype=bool)
            for first, run in _runs((codes(text) for text in texts), settings.slice_words):
                good[[first + text for text, _ in index.find(run)]] = False
            yield pd.Series(good)

    return clean


def without_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                          item_text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all their columns; judged where the row is, no shuffle."""
    ship_package(docs.sparkSession)
    for block in item_blocks(items, item_col, item_text_col):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        docs = docs.where(_clean(sent, settings)(F.col(text_col)))
    return docs
