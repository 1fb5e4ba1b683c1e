"""Galloping intersection and links against brute force with the tokenizers' own libraries; the defined edge cases."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF_SMALL
from curbline.llm import align
from curbline.llm.common import table
from curbline.llm.queries import QUERIES

FILES = align.Tokenizers.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
                              public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain(text, libraries):
    """Ids of both sides and the groups, by the libraries and by walking through both lists of ends."""
    if not text:
        return [], [], []
    a, b = libraries
    letters = align.byte_alphabet()
    left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    left_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in left]
    right_bytes = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                   for i in right]
    whole = (" " + text).encode()
    if b"".join(left_bytes) != whole or b"".join(right_bytes) != whole:
        return [], [], []
    ends = [{int(e): k for k, e in enumerate(np.cumsum([len(x) for x in side]))} for side in (left_bytes, right_bytes)]
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0][end], ends[1][end]
        groups.append((left[i:p + 1], right[j:q + 1]))
        i, j = p + 1, q + 1
    return left, right, groups


def digests(texts, libraries):
    found = [plain(t, libraries) for t in texts]
    counts = Counter((a[-1], b[-1]) for _, _, groups in found for a, b in groups)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    rows = []
    for left, right, groups in found:
        links = [(a[-1], b[-1]) for a, b in groups]
        line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((len(left), len(right), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                     sum(counts[x] for x in links), hashlib.sha256(line.encode()).hexdigest() if line else ""))
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [None, "", " ", "a", "  two  blanks", "tab\tand\nline\n\n", "▁ mark", "<|endoftext|> <0x41> <s>", "日本語 текст émigré 🙂🙂",
       "x" * 3000, "don't we'll 12345 + 67", "word " * 30_000, "İstanbul ﬁ ½", "trailing ", "\x00\x01", "a​b"]


@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=60))
def test_gallop_is_lower_bound(steps, wanted):
    longer, targets = np.cumsum(steps), np.cumsum(wanted)
    start = np.minimum(np.searchsorted(longer, targets), 3)
    assert (align.gallop(longer, targets, start) == np.searchsorted(longer, targets)).all()


@given(st.lists(st.tuples(st.lists(st.integers(1, 5), max_size=80), st.lists(st.integers(1, 5), max_size=80)), max_size=6))
def test_common_ends_of_several_documents(docs):
    sides, fromm = ([], []), ([0], [0])
    base = 0
    want = []
    for a, b in docs:
        size = max(sum(a), sum(b))
        a, b = ([*x, size - sum(x)] if size > sum(x) else list(x) for x in (a, b))
        ends = [list(base + np.cumsum(x, dtype=int)) for x in (a, b)]
        want += [(len(sides[0]) + ends[0].index(e), len(sides[1]) + ends[1].index(e)) for e in sorted(set(ends[0]) & set(ends[1]))]
        for k in (0, 1):
            sides[k].extend(ends[k])
            fromm[k].append(len(sides[k]))
        base += size
    got = align.common_ends(*(np.array(x, dtype=np.int64) for x in (*sides, *fromm)))
    assert list(zip(*(g.tolist() for g in got))) == want


def test_overlap_ranges():
    a, b = np.array([2, 5, 9]), np.array([1, 2, 6, 9])
    first, last = align.overlap_ranges(a, b)
    assert list(zip(first.tolist(), last.tolist())) == [(0, 2), (2, 3), (2, 4)]
    assert all(len(x) == 0 for x in align.overlap_ranges(np.array([], dtype=int), np.array([], dtype=int)))


def test_link_table_holds_every_suffix_pair():
    a, b = FILES.load()
    links = align.LinkTable(a, b)
    some = links.keys[::997]
    for i, j in zip(some >> 32, some & 0xFFFFFFFF):
        assert a.bytes[i].endswith(b.bytes[j]) or b.bytes[j].endswith(a.bytes[i])
    assert len(links.keys) <= sum(map(len, a.bytes)) + 2 * sum(map(len, b.bytes))


def test_odd_texts(spark, libraries):
    rows = [(k if k % 5 else None, t, "clash") for k, t in enumerate(ODD + ODD[3:6])]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a string")
    found = align.alignment_scores(df, FILES).collect()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in found) == sorted(digests([t for _, t, _ in rows], libraries))
    assert sorted((r["doc_id"] for r in found), key=str) == sorted((i for i, _, _ in rows), key=str)
    assert align.alignment_scores(df.where("false"), FILES).count() == 0


def test_tokens_and_cuts(spark, libraries):
    rows = [(k, t) for k, t in enumerate(ODD)]
    for r in align.align(spark.createDataFrame(rows, "doc_id long, text string"), FILES, with_tokens=True).collect():
        left, right, groups = plain(ODD[r["doc_id"]], libraries)
        assert (r["a_ids"], r["b_ids"]) == (left, right)
        assert np.diff([-1, *r["a_cuts"]]).tolist() == [len(a) for a, _ in groups]
        assert np.diff([-1, *r["b_cuts"]]).tolist() == [len(b) for _, b in groups]


def test_query_equals_brute_force(spark, libraries):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    want = {d["doc_id"]: row for d, row in zip(docs, digests([d["text"] for d in docs], libraries))}
    found = QUERIES["op11_tokenizer_alignment"](spark, SF_SMALL).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in found} == want and len(found) == len(docs)
