"""Language identification by rank order of character n-grams (out-of-place distance).

Learning: n-grams of 1 to ``max_n`` characters of all learnable texts are counted per language, first inside each
task (over the distinct words of its batches, a run of words at a time, so that a task's memory is bounded), then by a
grouped sum; a language's profile is its ``profile_size`` most frequent n-grams in order. Prediction: a text's most frequent ``profile_size`` n-grams, in order, are held
against each profile; an n-gram costs the difference of its two ranks, or ``profile_size`` where the profile lacks
it. The language with the smallest sum wins; ties go to the language first in byte order.

A word is a maximal run of letters, lower-cased, with a blank before and after. ``score`` is 1 minus the winner's
distance as a share of the largest possible. Texts that are null or have no letter are ``und`` with score 0, and so
is every text where no language was learned. Rows without text or language teach nothing. Repeated rows count as
often as they stand. Columns other than those named are not read. The profiles are bounded: at most
``max_languages`` languages of ``profile_size`` n-grams; more languages raise an error.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import arrow_map, ship_package, stored

UNDETERMINED = "und"
PROFILE_SIZE = 300
MAX_N = 3
MAX_LANGUAGES = 2_000
FLUSH_WORDS = 100_000
BITS = 21  # a code point

_not_letters = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """The lower-cased words of a text, a blank before and after each; only blanks if there is no letter."""
    return f" {_not_letters.sub(' ', text.lower())} " if text else " "


def gram_codes(words: str, max_n: int = MAX_N) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram of up to ``max_n`` characters as one integer (21 bits a character), and where it starts. Blanks
    stand at an end of an n-gram only, and not alone."""
    codes = np.frombuffer(words.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    blank = codes == ord(" ")
    grams, bad = codes, np.zeros(len(codes), dtype=bool)  # bad: a blank inside
    found, places = [codes[~blank]], [np.flatnonzero(~blank)]
    for n in range(2, min(max_n, len(codes)) + 1):
        grams = (grams[:-1] << BITS) | codes[n - 1:]
        bad = bad[:-1] | (blank[n - 2:-1] if n > 2 else False)
        good = ~(bad | (blank[:-1] & blank[1:])) if n == 2 else ~bad
        found.append(grams[good])
        places.append(np.flatnonzero(good))
    return np.concatenate(found), np.concatenate(places)


def summed(grams: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams and the sum of the weights of each."""
    kinds, kind = np.unique(grams, return_inverse=True)
    return kinds, np.bincount(kind, weights=weights).astype(np.int64)


def word_grams(words: dict[str, int], max_n: int = MAX_N, most_chars: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of words that occur so many times, and how often each occurs. Runs of words of about ``most_chars``
    characters together are cut at a time (a longer word is alone), so that the work arrays don't follow the number
    of words."""
    known, times = list(words), np.fromiter(words.values(), np.int64, len(words))
    sizes = np.fromiter(map(len, known), np.int64, len(known)) + 1  # a word owns the blank before it
    ends, parts, start = np.cumsum(sizes), [], 0
    while start < len(known):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most_chars, side="right")))
        found, places = gram_codes(f" {' '.join(known[start:stop])} ", max_n)
        parts.append(summed(found, np.repeat(times[start:stop], sizes[start:stop])[places]))
        start = stop
    return summed(*map(np.concatenate, zip(*parts)))


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, ties by code."""
    if len(grams) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        some = counts >= least
        grams, counts = grams[some], counts[some]
    return grams[np.lexsort((grams, -counts))][:size]


def learn(docs: DataFrame, learnable: Column, text_col: str = "text", lang_col: str = "lang",
          profile_size: int = PROFILE_SIZE, max_n: int = MAX_N, max_languages: int = MAX_LANGUAGES) -> dict:
    """Profiles, ``language -> n-gram codes, most frequent first``, of the rows where ``learnable`` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, words in seen.items():
                if not words:
                    continue
                grams, totals = word_grams(words, max_n)
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(grams)), pa.array(grams), pa.array(totals)],
                                                 ["lang", "gram", "n"])
            seen.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                seen.setdefault(lang, Counter()).update(letters(text.as_py()).split())
                if sum(map(len, seen.values())) > FLUSH_WORDS:
                    yield from flush()
        yield from flush()

    taught = docs.where(learnable & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = arrow_map(taught.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), run,
                       "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = stored(counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= profile_size),
                 "language-profiles")
    if top.select("lang").distinct().limit(max_languages + 1).count() > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    profiles: dict[str, list[tuple[int, int]]] = {}
    for row in top.collect():  # at most max_languages * profile_size rows
        profiles.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    return {lang: [gram for _, gram in sorted(found)] for lang, found in sorted(profiles.items())}


class Judge:
    """Out-of-place distances of one text at a time to all profiles."""

    def __init__(self, profiles: dict[str, list[int]], profile_size: int = PROFILE_SIZE, max_n: int = MAX_N):
        self.languages, self.size, self.max_n = sorted(profiles, key=lambda lang: lang.encode()), profile_size, max_n
        self.grams = np.unique(np.array([g for found in profiles.values() for g in found], dtype=np.int64))
        self.rank = np.full((len(self.grams) + 1, len(self.languages)), -1, dtype=np.int64)  # last row: not known
        for k, lang in enumerate(self.languages):
            self.rank[np.searchsorted(self.grams, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        grams, counts = np.unique(gram_codes(letters(text), self.max_n)[0], return_counts=True)
        if not len(grams) or not self.languages:
            return UNDETERMINED, 0.0
        own = ranked(grams, counts, self.size)
        place = np.searchsorted(self.grams, own)
        place[self.grams[np.minimum(place, len(self.grams) - 1)] != own] = len(self.grams)
        theirs = self.rank[place]
        apart = np.where(theirs < 0, self.size, np.abs(theirs - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(apart))
        return self.languages[best], 1.0 - float(apart[best]) / (self.size * len(own))


def predict(docs: DataFrame, profiles: dict, id_col: str = "doc_id", text_col: str = "text",
            profile_size: int = PROFILE_SIZE, max_n: int = MAX_N) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(sent.value, profile_size, max_n)
        for batch in batches:
            found = [judge(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([lang for lang, _ in found], pa.string()),
                 pa.array([score for _, score in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(rows, run, "doc_id long, lang_pred string, score double")


def with_language(docs: DataFrame, profiles: dict, text_col: str = "text", name: str = "_language",
                  profile_size: int = PROFILE_SIZE, max_n: int = MAX_N) -> DataFrame:
    """All columns of ``docs`` and the struct ``name`` (``lang``, ``score``): the form that a filtering stage uses."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(profiles)

    @F.arrow_udf("lang string, score double")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = Judge(sent.value, profile_size, max_n)
        for texts in batches:
            found = [judge(text.as_py()) for text in texts]
            yield pa.StructArray.from_arrays([pa.array([lang for lang, _ in found], pa.string()),
                                              pa.array([score for _, score in found], pa.float64())], ["lang", "score"])

    return docs.withColumn(name, judged(F.col(text_col)))
