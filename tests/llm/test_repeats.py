"""Repeated passages against brute force over all windows; the defined edge cases."""

import hashlib
import random

import numpy as np
import pytest

from curbline.llm import repeats


def brute(rows, least):
    """(doc_id, n_words, n_removed, kept) of each row."""
    split = [(i, [w for w in "".join(" " if c in " \t\n\x0b\f\r" else c for c in t or "").split(" ") if w]) for i, t in rows]
    first = {}
    for i, words in split:
        if i is not None:
            for k in range(len(words) - least + 1):
                key = tuple(words[k:k + least])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - least + 1):
            low = first.get(tuple(words[k:k + least]))
            if low is not None and (i is None or low < i):
                gone.update(range(k, k + least))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def planted(seed, least):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["é", "日本", "a\x1cb", "X", "x"]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passages = [words(n) for n in (least - 1, least, least + 1, 2 * least, 3 * least + 7)] + [["la"] * (2 * least)]
    rows = []
    for k in range(60):
        text = words(rng.randint(0, 2 * least))
        for p in rng.sample(passages, rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text[at:at] = p
        rows.append((k if k % 13 else None, rng.choice([" ", "  ", "\n", " \t"]).join(text)))
    rows += rows[5:9] + [(rows[3][0], rows[20][1]), (7, None), (8, ""), (9, " \n "), (100, rows[30][1]), (-4, rows[31][1])]
    return rows


@pytest.mark.parametrize("least", [50, 7, 87])
def test_equals_brute_force(spark, least):
    rows = planted(least, least)
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, kept string, row_id int")
    want = sorted(brute(rows, least), key=str)
    assert sum(r[2] > 0 for r in want) > 10
    found = repeats.without_repeats(df, least).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"].decode()) for r in found), key=str) == want
    digests = repeats.kept_digests(df, least).collect()
    assert (sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in digests), key=str)
            == sorted(((*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in want), key=str))


def test_very_long_texts_and_empty_table(spark):
    rng = random.Random(1)
    body = [str(rng.randrange(10 ** 6)) for _ in range(120_000)]
    rows = [(1, " ".join(body)), (2, " ".join(body[60_000:60_050])), (3, " ".join(["z", *body[7:56]]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in repeats.kept_digests(df).collect()}
    assert found == {1: (120_000, 0), 2: (50, 50), 3: (50, 0)}
    assert repeats.kept_digests(df.where("false")).count() == 0
    assert repeats.without_repeats(df.where("false")).count() == 0


def test_levels_double():
    assert repeats.levels(50) == [25, 50] and repeats.levels(200) == [25, 50, 100, 200] and repeats.levels(7) == [7]


def test_equal_windows_have_equal_hashes_and_representatives():
    words = [str(k % 37) for k in range(300)]
    one = repeats.Windows([b"a b c " + " ".join(words).encode(), " ".join(words[5:]).encode()])
    finals, text = one.finals(50)
    for which in (0, 1):
        h = one.hashes(finals, 50, which)
        offset = int((text == 0).sum())
        assert (h[8:8 + 246] == h[offset:offset + 246]).all()
    for level in (0, 1):
        at = one.representatives(finals, 50, level) - finals
        assert (at[8:8 + 246] == at[offset:offset + 246]).all() and at.min() >= 0 and at.max() <= 50 - repeats.levels(50)[level]
    assert len(np.unique(one.hashes(finals[:3 + 37], 50))) == 3 + 37
