"""SimHash groups against brute force over all pairs; the defined edge cases."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from curbline.llm import simhash


def plain_fingerprint(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\x1c", "\x1c").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(ids, prints, radius=3):
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    group = np.arange(len(prints))
    while True:
        low = np.array([group[near[k]].min() for k in range(len(prints))])
        if (low == group).all():
            break
        group = low
    return [min((i for i, g in zip(ids, group) if g == own and i is not None), default=None) for own in group]


def test_fingerprints():
    for text in ("", None, "One", "one two", "One two THREE", "a b c d e f a b c", "é É x", "a  b", "a\x1cb c"):
        assert simhash.fingerprint(text.encode() if text is not None else None) == plain_fingerprint(text)
    assert simhash.fingerprint("A B c".encode()) == plain_fingerprint("A B c")


def test_forest_joins_what_links_join():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    flips = np.array([np.uint64(0), np.uint64(1), np.uint64(3), np.uint64(7), np.uint64(15), np.uint64(31)])
    prints = np.unique((base[:, None] ^ flips[None, :]).ravel())
    rng.shuffle(prints)
    for same, left, right in ((True, prints, prints), (False, prints[:40], prints[40:])):
        everything = left if same else np.concatenate([left, right])
        near = np.bitwise_count(everything[:, None] ^ everything[None, :]) <= 3
        if not same:  # links inside one tile are another pair's business
            near[:40, :40] = np.eye(40, dtype=bool)
            near[40:, 40:] = np.eye(len(right), dtype=bool)
        links = simhash.forest(left, right, 3, same, rows=7)
        place = {int(v): k for k, v in enumerate(everything)}
        assert all(near[place[a], place[b]] for a, b in links)
        assert len(links) < len(everything)
        kept = np.eye(len(everything), dtype=bool)
        for a, b in links:
            kept[place[a], place[b]] = kept[place[b], place[a]] = True
        reach = [np.linalg.matrix_power(m.astype(float), 64) > 0 for m in (near / near.sum(0), kept / kept.sum(0))]
        assert (reach[0] == reach[1]).all()


def test_components_of_a_long_chain(spark):
    chain = [(k, k + 1) for k in range(1, 40)] + [(100, 100), (50, 60), (60, 55)]
    random.Random(2).shuffle(chain)
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{k: 1 for k in range(1, 41)}, 50: 50, 55: 50, 60: 50}


def test_groups_equal_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["the", "of", "and", "word", "other", "some", "text", "more", "less", "thing"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += [t + " end" for t in texts[:60]] + texts[:40] + ["", None, "x", "X", " \t\n "]
    rows = [(k if k % 37 else None, t) for k, t in enumerate(texts)] + [(5, texts[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    found = simhash.near_duplicates(df, tile_rows=16).collect()
    prints = np.array([simhash.fingerprint(t.encode() if t is not None else None) for _, t in rows], dtype=np.uint64)
    want = sorted(zip([i for i, _ in rows], prints.view(np.int64).tolist(), brute_groups([i for i, _ in rows], prints)), key=str)
    assert sorted(((r["doc_id"], r["fp"], r["component_id"]) for r in found), key=str) == want


def test_one_per_group_and_empty_table(spark):
    long_text = "a b c d e f g h i j k l m n o p " * 4
    other = "nothing in common with any of the rest of these rows at all, whatever one may say of it"
    rows = [(3, long_text), (1, long_text), (1, long_text), (2, "quite another text here"), (None, long_text),
            (1, other), (None, "only without an id, but twice"), (None, "only without an id, but twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("kept"))
    kept = simhash.one_per_group(df)
    assert kept.columns == df.columns
    # one row of each group: two texts under one id both stay, rows without id only where no other of the group has one
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, long_text), (1, other), (2, "quite another text here"), (None, "only without an id, but twice")], key=str)
    assert simhash.near_duplicates(df.where("false")).count() == 0
    assert simhash.one_per_group(df.where("false")).count() == 0
