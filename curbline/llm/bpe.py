"""Byte-level BPE over a corpus by merge replay.

Instead of running the merge loop once per word occurrence, a task gathers the *distinct* pattern matches of the
texts it holds, indexes their adjacent token pairs (by the rank of the token a pair makes: the positions where it
stands) and replays the merges in rank order over that index; the long tail of ranks that have few positions is replayed
in rank order within each word, all words at once. A merge touches only the two neighbours of its position. The texts
are then encoded by looking their matches up; finished words are kept for the task's next batches, and of more than
``kept_words`` those that were asked for most often. No shuffle is needed: a text's words meet their merges where the
text already is.

The rank file is read by the driver and sent to the tasks; its size is a property of the vocabulary, not of the data.
A null text is encoded as the empty text, a null list of ids decodes to no bytes. Ids outside the vocabulary raise.
Repeated rows give repeated results; columns other than those named are not read.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm.common import arrow_map, ship_package, slices

KEPT_WORDS = 150_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 token, blank, rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


SHIFT = 20  # a pair of ids as one integer; vocabularies stay below 2**20


def pair_table(ranks: dict[bytes, int]) -> dict[int, int]:
    """Each pair of tokens (as one integer) whose bytes together are a token -> the rank of that token."""
    if len(ranks) >= 1 << SHIFT or max(ranks.values()) >= 1 << SHIFT:
        raise ValueError("the vocabulary is too large")
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left << SHIFT | right] = rank
    return pairs


class PairRanks:
    """Looks pairs up: one by one in a dict, or many at a time in sorted arrays."""

    def __init__(self, pairs: dict[int, int]):
        self.get = pairs.get
        self.keys = np.fromiter(pairs, np.int64, len(pairs))
        self.ranks = np.fromiter(pairs.values(), np.int64, len(pairs))
        order = np.argsort(self.keys)
        self.keys, self.ranks = self.keys[order], self.ranks[order]

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it makes no token."""
        pairs = (left << SHIFT) | right
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where((self.keys[at] == pairs) & (left >= 0) & (right >= 0), self.ranks[at], -1)


def _add(index: dict[int, list], due: list[int], made: np.ndarray, places: np.ndarray) -> None:
    """Enter places into the index under the ranks they make (-1: none)."""
    some = np.flatnonzero(made >= 0)
    if not len(some):
        return
    order = some[np.argsort(made[some], kind="stable")]
    made, places = made[order], places[order]
    cuts = np.flatnonzero(np.diff(made)) + 1
    for rank, part in zip(made[np.r_[0, cuts]].tolist(), np.split(places, cuts)):
        if rank not in index:
            index[rank] = []
            heappush(due, rank)
        index[rank].append(part)


def _replay_common(symbols: np.ndarray, ranks: PairRanks, least_places: int) -> np.ndarray:
    """Replays merges in rank order, all places of a rank at once, as long as the ranks have many places; returns
    the symbols that are left, end marks included."""
    n = len(symbols)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    index: dict[int, list] = {}
    due: list[int] = []
    _add(index, due, ranks.of(symbols[:-1], symbols[1:]), np.arange(n - 1))
    few = 0  # ranks with few places in a row
    while due and few < 8:
        rank = due[0]
        places = np.unique(np.concatenate(index[rank]))
        few = few + 1 if len(places) < least_places else 0
        places = places[(symbols[places] >= 0)]
        places = places[ranks.of(symbols[places], symbols[after[places]]) == rank]
        right = after[places]
        # of places that overlap, one after the other, the first, third, ... merge
        joined = np.r_[False, right[:-1] == places[1:]] if len(places) else np.zeros(0, bool)
        run = np.arange(len(places)) - np.maximum.accumulate(np.where(joined, 0, np.arange(len(places))))
        places, right = places[run % 2 == 0], right[run % 2 == 0]
        old, other, follower = symbols[places], symbols[right], after[right]
        symbols[places], symbols[right] = rank, -1
        after[places], before[follower] = follower, places
        left = before[places]
        to_right, to_left = ranks.of(symbols[places], symbols[follower]), ranks.of(symbols[left], symbols[places])
        to_left[left < 0] = -1
        if ((to_right >= 0) & (to_right <= rank)).any() or ((to_left >= 0) & (to_left <= rank)).any():
            # some word goes on with a pair of lower or equal rank first: undo, and leave the rest to the other loop
            symbols[places], symbols[right] = old, other
            break
        heappop(due)
        del index[rank]
        _add(index, due, np.concatenate([to_right, to_left]), np.concatenate([places, left]))
    return symbols


def replay(words: list[bytes], byte_ids: np.ndarray, ranks: PairRanks, least_places: int = 1000,
           wave_symbols: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of all words, one word after the other, and the number of ids of each word.

    All words lie in one array of symbols, each word followed by an end mark (-1). ``index`` maps a rank to the
    positions whose symbol and next symbol make that token; merges are applied in rank order. Ranks with many
    positions come first and are applied to all of them at once. The long tail of ranks with few positions is replayed
    in rank order within each word, all words side by side: words don't meet, so their order among each other is free.
    Words that still have more than ``wave_symbols`` symbols are replayed one position at a time.
    """
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    body = byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
    ends = np.cumsum(sizes + 1) - 1
    whole = np.insert(body, np.cumsum(sizes), -1)
    marks = np.zeros(len(whole), dtype=bool)
    marks[ends] = True
    whole = _replay_common(whole, ranks, least_places)
    left = marks | (whole >= 0)
    symbols, marks = whole[left], marks[left]
    lengths = np.diff(np.flatnonzero(marks), prepend=-1)  # with the end mark
    of_long = np.repeat(lengths > wave_symbols + 1, lengths)
    if len(symbols):
        symbols[~of_long] = _replay_side_by_side(symbols[~of_long], ranks)
    if of_long.any():
        symbols[of_long] = _replay_rare(symbols[of_long], ranks)
    return symbols[symbols >= 0].astype(np.int32), np.diff(
        np.cumsum(symbols >= 0)[np.flatnonzero(marks)], prepend=0)


def _replay_side_by_side(symbols: np.ndarray, ranks: PairRanks) -> np.ndarray:
    """Replays one merge of every word at a time: that of its lowest rank, the first of its places; swallowed symbols
    become -1. Only the pairs with the two neighbours of a merge are looked up anew."""
    n, none = len(symbols), 1 << SHIFT
    word = np.cumsum(symbols < 0) - (symbols < 0)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    makes = np.full(n, none)  # the rank that the pair from here on makes

    def look_up(places: np.ndarray, followers: np.ndarray) -> None:
        found = ranks.of(symbols[places], symbols[followers])
        makes[places] = np.where(found < 0, none, found)

    look_up(np.arange(n - 1), np.arange(1, n))
    places = np.flatnonzero(makes < none)
    while len(places):
        owner = word[places]
        firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lowest = np.minimum.reduceat(makes[places] << 32 | places, firsts)
        at, rank = lowest & 0xFFFFFFFF, lowest >> 32
        right = after[at]
        follower, left = after[right], before[at]
        symbols[at], symbols[right], makes[right] = rank, -1, none
        after[at], before[follower] = follower, at
        look_up(at, follower)
        look_up(left, at)
        places = np.flatnonzero(makes < none)
    return symbols


def _replay_rare(whole: np.ndarray, ranks: PairRanks) -> np.ndarray:
    """Replays the merges in rank order one position at a time; swallowed symbols become -1."""
    n = len(whole)
    symbols = whole.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    entered: dict[int, list] = {}
    due: list[int] = []
    _add(entered, due, ranks.of(whole[:-1], whole[1:]), np.arange(n - 1))
    index = {rank: parts[0].tolist() for rank, parts in entered.items()}

    while due:
        rank = heappop(due)
        places = index.pop(rank, None)
        if not places:
            continue
        places.sort()
        base = rank << SHIFT
        for done, at in enumerate(places):
            right = after[at]
            if get(symbols[at] << SHIFT | symbols[right]) != rank:
                continue  # the pair has gone meanwhile
            follower, left = after[right], before[at]
            symbols[at], symbols[right] = rank, -1
            after[at], before[follower] = follower, at
            earlier = False
            for new, place in ((get(base | symbols[follower]), at), (get(symbols[left] << SHIFT | rank), left)):
                if new is not None:
                    if new in index:
                        index[new].append(place)
                    else:
                        index[new] = [place]
                        heappush(due, new)
                    earlier |= new <= rank
            if earlier:  # a pair of lower or equal rank came up: it goes first, the rest of these places wait
                if rank in index:
                    index[rank] += places[done + 1:]
                elif done + 1 < len(places):
                    index[rank] = places[done + 1:]
                    heappush(due, rank)
                break
    return np.array(symbols, dtype=np.int64)


LATIN_END = 0x250  # texts with characters from here on are split by the slower matcher


def fast_split(pattern: str) -> tuple[re.Pattern, re.Pattern] | None:
    """The pattern for the standard library's faster matcher, its classes written out as the characters they hold up to
    the end of the Latin blocks, and a search for characters beyond. None: no such pattern."""
    latin = "".join(map(chr, range(LATIN_END)))

    def listed(inside: str) -> str:
        return "".join(map(re.escape, regex.findall(f"[{inside}]", latin)))

    fast = pattern
    for slow_class in (r"[^\s\p{L}\p{N}]", r"\p{L}", r"\p{N}", r"\s", r"\S"):
        fast = fast.replace(slow_class, f"[{listed(slow_class.strip('[]'))}]")
    if r"\p" in fast:
        return None
    return re.compile(fast), re.compile(rf"[\U{LATIN_END:08x}-\U0010ffff]")


class Encoder:
    """Encodes texts by looking up their matches; the unknown ones of a call are replayed together."""

    def __init__(self, ranks: dict[bytes, int], pairs: PairRanks, pattern: str, kept_words: int = KEPT_WORDS):
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.pairs, self.slow, self.kept_words = pairs, regex.compile(pattern), kept_words
        self.fast = fast_split(pattern)
        self._forget()

    def split(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.fast and not self.fast[1].search(text):
            return self.fast[0].findall(text)
        return self.slow.findall(text)

    def _forget(self) -> None:
        self.number: dict[str, int] = {}  # word -> its place in size, start and uses
        self.size, self.start, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.uses = np.zeros(0, np.int64)

    def _make_room(self) -> None:
        """Keeps the words asked for most often, half as many as may be kept; what they were asked for counts half."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[:self.kept_words // 2])
        words, size = list(self.number), self.size[kept]
        self.number = {words[k]: place for place, k in enumerate(kept.tolist())}
        ends = np.cumsum(size)
        self.ids = self.ids[np.repeat(self.start[kept] - ends + size, size) + np.arange(size.sum())]
        self.size, self.start, self.uses = size, ends - size, self.uses[kept] // 2

    def _learn(self, words: set[str]) -> None:
        order = sorted(words)
        ids, sizes = replay([w.encode("utf-8") for w in order], self.byte_ids, self.pairs)
        self.number.update(zip(order, range(len(self.number), len(self.number) + len(order))))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(sizes) - sizes])
        self.size, self.ids = np.concatenate([self.size, sizes]), np.concatenate([self.ids, ids])
        self.uses = np.concatenate([self.uses, np.zeros(len(order), np.int64)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and the number of ids of each text."""
        if len(self.number) > self.kept_words:
            self._make_room()
        matches: list[str] = []
        text_ends = [0]
        for text in texts:
            matches += self.split(text)
            text_ends.append(len(matches))
        words = np.fromiter(map(self.number.get, matches, repeat(-1)), dtype=np.int64, count=len(matches))
        if len(unknown := np.flatnonzero(words < 0)):
            asked = [matches[k] for k in unknown.tolist()]
            self._learn(set(asked))
            words[unknown] = np.fromiter(map(self.number.__getitem__, asked), dtype=np.int64, count=len(asked))
        self.uses += np.bincount(words, minlength=len(self.uses))
        size = self.size[words]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(self.start[words] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.diff(np.r_[0, ends][text_ends])


_encoders: dict[tuple, Encoder] = {}  # of this Python worker: its next tasks go on with the words it knows


def _encoder(key: tuple, ranks: dict[bytes, int], pairs: PairRanks, pattern: str) -> Encoder:
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(ranks, pairs, pattern)
    return _encoders[key]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
           slice_bytes: int = 1_000_000) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int), one row per row of ``docs``. Runs of whole texts of about ``slice_bytes``
    together are encoded at a time, so that memory follows the text, not the batch's row count."""
    sent = docs.sparkSession.sparkContext.broadcast((ranks, PairRanks(pair_table(ranks))))
    key = (uuid.uuid4().hex, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, *sent.value, pattern)
        for batch in batches:
            for part in slices(batch, 1, slice_bytes):
                found, sizes = encoder.encode(part.column(1).to_pylist())
                ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(found))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(rows, run, "doc_id long, ids array<int>")


def decoder(spark: SparkSession, ranks: dict[bytes, int], slice_ids: int = 500_000) -> Callable[[Column], Column]:
    """A function of an array of ids: the bytes that they stand for."""
    ship_package(spark)
    by_rank = {rank: token for token, rank in ranks.items()}
    sent = spark.sparkContext.broadcast([by_rank.get(rank, b"") for rank in range(max(by_rank, default=-1) + 1)])

    def joined(tokens: pa.Array, ids: pa.ListArray, counts: np.ndarray) -> pa.Array:
        taken = tokens.take(ids.flatten())
        # the tokens' bytes lie one after the other: a text's bytes reach from its first token to its last
        ends = np.frombuffer(taken.buffers()[1], dtype=np.int64, count=len(taken) + 1) if len(taken) else np.zeros(1, np.int64)
        edges = ends[np.concatenate([[0], np.cumsum(counts)])]
        data = taken.buffers()[2] if len(taken) else pa.py_buffer(b"")
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ids), [None, pa.py_buffer(edges.tobytes()), data]).cast(pa.binary())

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = pa.array(sent.value, pa.large_binary())
        for ids in batches:
            counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, parts, start = np.cumsum(counts), [], 0
            while start < len(ids):  # runs of rows of about ``slice_ids`` ids together; a longer row is alone
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + slice_ids, side="right")))
                parts.append(joined(tokens, ids.slice(start, stop - start), counts[start:stop]))
                start = stop
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return decoded
