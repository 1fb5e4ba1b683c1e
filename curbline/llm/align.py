"""Alignment of two tokenizers over the same text by galloping intersection of their token ends.

Both tokenizers turn one text into tokens whose bytes, joined, are the text's. Where a token of each ends at the same
byte, both sequences are cut: the tokens between two cuts form a group. The common ends are found by a galloping
intersection: the shorter end list of a document drives an exponential, then a binary search into the longer one, from
where the search before it ended. Differences of the ranks of two cuts are the group's sizes; the ranks of a token's
first and last byte in the other list are the range of tokens that it overlaps (``overlap_ranges``).

A link is a pair of tokens, one of each side, that end together. As both hold the bytes before that end, one's bytes are
a suffix of the other's: all pairs of ids that can ever be linked follow from the two vocabularies (at most one for each
byte of each entry), whatever the corpus. ``LinkTable`` lists them; counts over any corpus are one number for each, so
that they are summed per task, then by Spark, and the sums have a proven bound where they are sent to the tasks.

Texts that are null or empty, or that a tokenizer does not give back byte by byte, have no tokens: empty groups, no
links. Tokens of special meaning in a text are plain text. Rows are handled one by one: repeated rows and ids, ties and
null ids need no rule; other columns are not read, so names can't clash. An empty table gives an empty one. Very long
texts are encoded in pieces cut before a blank between an ASCII letter or digit and an ASCII letter, where neither
tokenizer can have a token that crosses (checked on the vocabularies).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import arrow_map, slices, stored

#: Bytes of texts that are encoded and aligned together in one task.
SLICE_BYTES = 1 << 20
#: Longer texts are encoded in pieces of about this many characters.
PIECE_CHARS = 1 << 16
#: One of so many driving ends starts its search at the document's first token, the others where that one ended.
HEAD_EVERY = 32

SAFE_CUT = re.compile(r"(?<=[0-9A-Za-z]) (?=[A-Za-z])")


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1 stands for itself, the other
    bytes, in order, for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """The bytes of each id, their number, and the ids' decimal names."""

    def _keep(self, entries: list[bytes]) -> None:
        self.bytes = entries
        self.sizes = np.array([len(b) for b in entries], dtype=np.int64)
        self.entries = pa.array(entries, pa.large_binary())
        self.names = pa.array([str(i) for i in range(len(entries))], pa.string())


class ByteLevel(Vocabulary):
    """A byte-level BPE vocabulary from its JSON file; a text is encoded with a blank before it.

    Where ids rank the merges (each merge makes the entry with the next id), the ids are the ranks that a merge by
    rank needs; files of any other kind are refused.
    """

    def __init__(self, source: bytes, pattern: str):
        model = json.loads(source)["model"]
        special = {x["id"] for x in json.loads(source).get("added_tokens", [])}
        letters = byte_alphabet()
        entries = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items() if i not in special}
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if any(a >= b for a, b in zip(made, made[1:])):
            raise ValueError("ids of the vocabulary are not in the order of its merges")
        self._keep([entries.get(i, b"") for i in range(max(entries) + 1)])
        self._library = tiktoken.Encoding("aligned", pat_str=pattern, special_tokens={},
                                          mergeable_ranks={b: i for i, b in entries.items()})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.concatenate([self._library.encode_to_numpy(piece, disallowed_special=()) for piece in pieces(" " + text)])
                for text in texts]


class Pieces(Vocabulary):
    """A sentence-piece vocabulary; the model puts the blank before a text itself."""

    def __init__(self, source: bytes):
        self._library = sentencepiece.SentencePieceProcessor(model_proto=source)
        n = self._library.get_piece_size()
        names = self._library.id_to_piece(list(range(n)))
        self._keep([bytes([int(names[i][1:-1], 16)]) if self._library.is_byte(i)
                    else names[i].replace("▁", " ").encode() for i in range(n)])
        self._may_cut = not any("▁" in name.lstrip("▁") for name in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        whole: list[list[int]] = self._library.encode([t if len(t) <= PIECE_CHARS or not self._may_cut else "" for t in texts],
                                                      num_threads=1)
        for k, text in enumerate(texts):
            if len(text) > PIECE_CHARS and self._may_cut:
                # a piece starts with its blank, which the model adds again
                parts = [piece[k > 0:] for k, piece in enumerate(pieces(text))]
                whole[k] = [t for ids in self._library.encode(parts, num_threads=1) for t in ids]
        return whole


def pieces(text: str) -> list[str]:
    """The text cut before safe blanks, about every ``PIECE_CHARS`` characters."""
    if len(text) <= PIECE_CHARS:
        return [text]
    cuts = [0]
    while found := SAFE_CUT.search(text, cuts[-1] + PIECE_CHARS):
        cuts.append(found.start())
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


@dataclass(frozen=True)
class Tokenizers:
    """The files of both tokenizers, read on the driver: a byte-level vocabulary (JSON) with its split pattern, and a
    sentence-piece model."""

    byte_level: bytes
    pattern: str
    piece_model: bytes

    @classmethod
    def read(cls, byte_level_path: str, pattern: str, piece_path: str) -> Tokenizers:
        with open(byte_level_path, "rb") as a, open(piece_path, "rb") as b:
            return cls(a.read(), pattern, b.read())

    def load(self) -> tuple[ByteLevel, Pieces]:
        return _loaded(self)


@lru_cache(maxsize=1)
def _loaded(files: Tokenizers) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(files.byte_level, files.pattern), Pieces(files.piece_model)


def gallop(longer: np.ndarray, targets: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each target the first index of the ascending ``longer``, not before ``start``, whose value reaches it
    (``len(longer)`` if none does): steps of 1, 2, 4, ... until it is passed, then halving of the last step."""
    low, last = start.astype(np.int64), len(longer) - 1
    high = low.copy()
    open_, step = np.arange(len(targets)), 1
    while len(open_):
        open_ = open_[high[open_] <= last]
        open_ = open_[longer[high[open_]] < targets[open_]]
        low[open_] = high[open_] + 1
        high[open_] = np.minimum(high[open_] + step, np.where(high[open_] < last, last, last + 1))
        step *= 2
    high = np.minimum(high, last + 1)
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        less = longer[middle] < targets[open_]
        low[open_[less]], high[open_[~less]] = middle[less] + 1, middle[~less]
        open_ = open_[low[open_] < high[open_]]
    return low


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray, a_from: np.ndarray, b_from: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (into ``a_ends``, into ``b_ends``) of equal ends. Both hold the ends of one document after the other,
    ascending over all of them; ``*_from`` are the index of each document's first token and, last, the length."""
    a_counts, b_counts = np.diff(a_from), np.diff(b_from)
    found = []
    for drives, ends, others, first, other_first, counts in (
            (a_counts <= b_counts, a_ends, b_ends, a_from, b_from, a_counts),
            (a_counts > b_counts, b_ends, a_ends, b_from, a_from, b_counts)):
        docs = np.flatnonzero(drives & (counts > 0))
        doc = np.repeat(docs, counts[docs])
        within = np.arange(len(doc)) - np.repeat(np.cumsum(counts[docs]) - counts[docs], counts[docs])
        driving = first[doc] + within
        head = np.flatnonzero(within % HEAD_EVERY == 0)
        at_head = gallop(others, ends[driving[head]], other_first[doc[head]])
        started = np.repeat(at_head, np.diff([*head, len(doc)]))
        at = gallop(others, ends[driving], started)
        hit = others[np.minimum(at, len(others) - 1)] == ends[driving] if len(others) else np.zeros(0, dtype=bool)
        found.append((driving[hit], at[hit]))
    a = np.concatenate([found[0][0], found[1][1]])
    b = np.concatenate([found[0][1], found[1][0]])
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


def overlap_ranges(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of one text's first list the first and (exclusive) last token of the second that it shares bytes
    with: ranks of its own start and end among the other's ends."""
    if not len(a_ends):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    starts = np.concatenate([[0], a_ends[:-1]])
    ranks = gallop(b_ends, np.concatenate([starts + 1, a_ends]), np.zeros(2 * len(a_ends), dtype=np.int64))
    return ranks[:len(a_ends)], ranks[len(a_ends):] + 1


class LinkTable:
    """All pairs of ids that can end together: one's bytes are a suffix of the other's. ``keys`` are ascending."""

    def __init__(self, a: ByteLevel, b: Pieces):
        pairs: set[int] = set()
        for left, right, swap in ((a.bytes, b.bytes, False), (b.bytes, a.bytes, True)):
            by_bytes: dict[bytes, list[int]] = {}
            for i, entry in enumerate(left):
                if entry:
                    by_bytes.setdefault(entry, []).append(i)
            for j, entry in enumerate(right):
                for cut in range(len(entry)):
                    for i in by_bytes.get(entry[cut:], ()):
                        pairs.add(j << 32 | i if swap else i << 32 | j)
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.a_ids, self.b_ids = self.keys >> 32, self.keys & 0xFFFFFFFF

    def index(self, a_ids: np.ndarray, b_ids: np.ndarray) -> np.ndarray:
        wanted = a_ids.astype(np.int64) << 32 | b_ids
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        if not (self.keys[at] == wanted).all():
            raise ValueError("tokens end together though neither's bytes end the other's")
        return at.astype(np.int32)

    def best(self, counts: np.ndarray) -> np.ndarray:
        """Whether a pair's count is the highest of its second id."""
        highest = np.zeros(int(self.b_ids.max()) + 1, dtype=np.int64)
        np.maximum.at(highest, self.b_ids, counts)
        return counts == highest[self.b_ids]


def group_texts(a_names: pa.Array, b_names: pa.Array, a_ids: np.ndarray, b_ids: np.ndarray, a_at: np.ndarray,
                b_at: np.ndarray, groups: np.ndarray) -> pa.Array:
    """Per document ``a1,a2|b1;a3|b2,b3``: the ids of each group, cut after the tokens at ``*_at`` (every document's
    last tokens among them); ``groups`` counts each document's."""
    sides = [pc.binary_join(_lists(names.take(pa.array(ids)), np.diff(at, prepend=-1)), ",")
             for names, ids, at in ((a_names, a_ids, a_at), (b_names, b_ids, b_at))]
    return pc.binary_join(_lists(pc.binary_join_element_wise(*sides, "|"), groups), ";")


def _flat(ids: list, given: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in one array, and how many each text has (none where it was not encoded)."""
    counts = np.zeros(len(given), dtype=np.int64)
    counts[given] = [len(x) for x in ids]
    return np.concatenate([np.zeros(0, dtype=np.int64), *ids]).astype(np.int64), counts


def _gives_back(entries: pa.Array, ids: np.ndarray, counts: np.ndarray, wanted: list[bytes], given: list[bool]) -> np.ndarray:
    """Whether the bytes of a text's ids, joined, are the wanted ones."""
    joined = entries.take(pa.array(ids))
    ends = joined.buffers()[1]
    upto = np.frombuffer(ends, dtype=np.int64, count=len(ids) + 1) if len(ids) else np.zeros(1, dtype=np.int64)
    data = joined.buffers()[2].to_pybytes() if len(ids) else b""
    fine = np.zeros(len(given), dtype=bool)
    if data == b"".join(wanted) and np.array_equal(np.diff(upto[np.concatenate([[0], np.cumsum(counts)])])[given], [len(w) for w in wanted]):
        fine[given] = True
        return fine
    edges = upto[np.concatenate([[0], np.cumsum(counts)])]
    for k, want in zip(np.flatnonzero(given), wanted):
        fine[k] = data[edges[k]:edges[k + 1]] == want
    return fine


def _tokens(texts: list[str | None], a: ByteLevel, b: Pieces) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and counts of both sides; none where a side's bytes are not the text's with a blank before it."""
    given = [bool(t) for t in texts]
    asked = [t for t in texts if t]
    wanted = [b" " + t.encode() for t in asked]
    sides = [(side, *_flat(side.encode(asked), given)) for side in (a, b)]
    fine = np.all([_gives_back(side.entries, ids, counts, wanted, given) for side, ids, counts in sides], axis=0)
    return [(ids[np.repeat(fine, counts)], counts * fine) for _, ids, counts in sides]


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups string, links array<int>"
WITH_TOKENS = ALIGNED + ", a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"


def _lists(flat: pa.Array, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), flat)


def _aligned(ids: pa.Array, texts: list[str | None], a: ByteLevel, b: Pieces, table: LinkTable,
             with_tokens: bool) -> pa.RecordBatch:
    (a_ids, a_counts), (b_ids, b_counts) = _tokens(texts, a, b)
    a_from, b_from = (np.concatenate([[0], np.cumsum(n)]) for n in (a_counts, b_counts))
    # both sides have the same bytes, document by document, so running ends are comparable across all of them
    a_at, b_at = common_ends(np.cumsum(a.sizes[a_ids]), np.cumsum(b.sizes[b_ids]), a_from, b_from)
    groups = np.diff(np.searchsorted(a_at, a_from))
    texts_ = group_texts(a.names, b.names, a_ids, b_ids, a_at, b_at, groups)
    links = pa.array(table.index(a_ids[a_at], b_ids[b_at]))
    columns = [ids, pa.array(a_counts), pa.array(b_counts), pa.array(groups), texts_, _lists(links, groups)]
    if with_tokens:
        doc = np.repeat(np.arange(len(groups)), groups)
        for flat, counts in ((a_ids, a_counts), (b_ids, b_counts), (a_at - a_from[doc], groups), (b_at - b_from[doc], groups)):
            columns.append(_lists(pa.array(flat.astype(np.int32)), counts))
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in (WITH_TOKENS if with_tokens else ALIGNED).split(", ")])


def align(docs: DataFrame, files: Tokenizers, with_tokens: bool = False) -> DataFrame:
    """Per document its token counts, its groups as text, and its links as indices into the ``LinkTable``; on request
    also the ids of both sides and, for each group, the index of its last token on either side."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sent.value.load()
        table = LinkTable(a, b)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                yield _aligned(part.column(0), part.column(1).to_pylist(), a, b, table, with_tokens)

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     WITH_TOKENS if with_tokens else ALIGNED)


def link_counts(aligned: DataFrame, size: int) -> np.ndarray:
    """How often each pair of the link table is linked in all documents: summed per task, then by Spark; at most
    ``size`` numbers, which the vocabularies fix, come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["link", "n"])

    partial = arrow_map(aligned.select("links"), run, "link int, n long")
    found = partial.groupBy("link").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, dtype=np.int64)
    counts[found.column("link").to_numpy()] = found.column("n").to_numpy()
    return counts


def with_link_scores(aligned: DataFrame, counts: np.ndarray, best: np.ndarray) -> DataFrame:
    """Adds per document ``n_links``, ``n_best`` (links whose count is their second id's highest) and ``count_sum``
    (sum of the links' counts), in place of ``links``."""
    spark = aligned.sparkSession
    sent = spark.sparkContext.broadcast((counts, best))
    kept = [c for c in aligned.columns if c != "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, is_best = sent.value
        for batch in batches:
            links = batch.column(batch.num_columns - 1)
            flat, upto = links.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(links).to_numpy())])
            sums = [np.concatenate([[0], np.cumsum(v[flat], dtype=np.int64)]) for v in (is_best, count)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.diff(upto)), *[pa.array(np.diff(s[upto])) for s in sums]],
                [*kept, "n_links", "n_best", "count_sum"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.select(*kept).schema)
    return arrow_map(aligned.select(*kept, "links"), run, f"{types}, n_links long, n_best long, count_sum long")


def alignment_scores(docs: DataFrame, files: Tokenizers, name: str = "aligned") -> DataFrame:
    """Per document ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``.

    Encoding is the dear part and done once: what later passes need (links, digests) is written to the shared folder,
    the counts of the whole corpus are summed from it, and it is read again for the documents' own sums.
    """
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    kept = stored(align(docs, files).select("doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "links"), name)
    table = LinkTable(*files.load())
    counts = link_counts(kept, len(table.keys))
    return with_link_scores(kept, counts, table.best(counts))
