"""Stupid backoff against a plain version."""

import math
import random
from collections import Counter
from functools import partial
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import backoff


def plain(rows, alpha=0.4, least=2):
    texts = {}
    for i, t in rows:
        words = [w for w in "".join(c.lower() if c < "\x80" else c for c in t or "").split(" ") if w]
        texts.setdefault(i, []).append(words)
    every = [words for own in texts.values() for words in own]
    one = Counter(w for words in every for w in words)
    total = sum(one.values())
    merged = Counter(one)
    two = Counter(pair for words in every for pair in zip(["<begin>", *words], words))
    merged["<begin>"] = sum(bool(words) for words in every)
    out = {}
    for i, own in texts.items():
        score = 0.0
        for words in own:
            for a, w in zip(["<begin>", *words], words):
                n = two[a, w]
                score += math.log(n / merged[a]) if n >= least else math.log(alpha * merged[w] / total)
        out[i] = (sum(map(len, own)), pytest.approx(score))
    return out


ROWS = [(1, "the cat sat on the mat"), (2, "The cat sat on the hat"), (3, None), (4, ""), (5, " x  y x "), (None, "the cat"),
        (1, "the cat sat on the mat"), (6, "é É the"), (7, "w " * 5_000), (8, " ".join(f"u{k}" for k in range(300)))]


@pytest.mark.parametrize("frequent,hot,least,documents", [(4096, 512, 2, 1), (2, 2, 2, 1), (100_000, 100_000, 2, 1),
                                                          (8, 4, 1, 1), (4096, 512, 3, 1)])
def test_every_word_has_its_own_count(spark, monkeypatch, frequent, hot, least, documents):
    """Rare words beside one very frequent word keep their own counts."""
    monkeypatch.setattr(backoff, "FREQUENT_SHARE", frequent)
    monkeypatch.setattr(backoff, "HOT_SHARE", hot)
    rows = [*ROWS, (20, "z " * 140_000), (21, "rare pair"), (22, "rare pair"), (23, "odd one"), (24, "rare one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("first", F.lit("clash")).withColumn("n", F.lit(0))
    found = {r["doc_id"]: (r["n_words"], r["log_score"])
             for r in backoff.whole_scores(df, least_count=least, least_documents=documents).collect()}
    assert found == plain(rows, least=least)


def test_whole_scores_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert backoff.whole_scores(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert sorted(map(tuple, backoff.whole_scores(blank).collect())) == [(1, 0, 0.0), (2, 0, 0.0)]


def common_scores(rows, least, documents, alpha=0.4):
    """``plain`` with documents counted: texts with an id that hold the pair."""
    texts = [(i, [w for w in (t or "").split(" ") if w]) for i, t in rows]
    pairs = [Counter(zip(["<begin>", *words], words)) for _, words in texts]
    one, two, held = Counter(w for _, words in texts for w in words), sum(pairs, Counter()), Counter()
    one["<begin>"], total = sum(bool(words) for _, words in texts), sum(len(words) for _, words in texts)
    for (i, _), own in zip(texts, pairs):
        held.update(own.keys() if i is not None else ())
    out = {}
    for (i, words), own in zip(texts, pairs):
        n, score = out.get(i, (0, 0.0))
        for (v, w), k in own.items():
            common = two[v, w] >= least and held[v, w] >= documents
            score += k * math.log(two[v, w] / one[v] if common else alpha * one[w] / total)
        out[i] = (n + len(words), score)
    return {i: (n, pytest.approx(score)) for i, (n, score) in out.items()}


@pytest.mark.parametrize("batch,bucket,least,documents", [(1, 5, 2, 1), (40, 30, 2, 2), (40, 1_000, 3, 3), (1 << 20, 1 << 21, 1, 2), (90, 7, 2, 0)])
def test_batches_and_buckets_change_no_score(spark, monkeypatch, batch, bucket, least, documents):
    monkeypatch.setattr(backoff, "BATCH_WORDS", batch)
    monkeypatch.setattr(backoff, "BUCKET_WORDS", bucket)
    rng = random.Random(batch)
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, "", "sun sun sun"] + 9 * [" ".join(rng.choices("abcdefghijklmno", k=rng.randint(1, 12)))]))
            for _ in range(120)] + [(None, "only nameless"), (None, "only nameless")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: (r["n_words"], r["log_score"])
             for r in backoff.whole_scores(df, least_count=least, least_documents=documents).collect()}
    assert found == common_scores(rows, least, documents)


def shuffled_rows(plan):
    rows, todo = [], [plan]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlanExec" in node.getClass().getName():
            todo.append(node.executedPlan())
            continue
        if "QueryStageExec" in node.getClass().getName():
            todo.append(node.plan())
            continue
        written = node.metrics().get("shuffleRecordsWritten")
        if written.isDefined():
            rows.append(written.get().value())
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return rows


def test_pairs_of_documents_are_not_shuffled(spark, monkeypatch):
    """What is stored and dealt stays under the size of the texts; no exchange has a row for each pair and document."""
    rng = random.Random(1)
    words = [f"{rng.randrange(1 << 30):x}" for _ in range(2_000)]
    rows = [(k, " ".join(words[int(len(words) * rng.random() ** 3)] for _ in range(400))) for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    kept = []
    monkeypatch.setattr(backoff, "stored", lambda *a, f=backoff.stored, **b: kept.append(f(*a, **b)) or kept[-1])
    found = backoff.whole_scores(df)
    assert len(found.collect()) == 500
    rows_written = shuffled_rows(found._jdf.queryExecution().executedPlan())
    assert rows_written and max(rows_written) <= 500
    dealt = backoff.arrow_map(kept[0], partial(backoff.sent, buckets=1, least_documents=1), backoff.SENT).toArrow()
    size = sum(f.stat().st_size for t in kept for f in Path(t.stored_at.removeprefix("file:")).glob("*.parquet"))
    assert size + dealt.nbytes < sum(len(t) for _, t in rows)


def test_packed_numbers_come_back():
    for numbers in ([], [0], [1, 0, 255, 256, 2**63, 2**64 - 1], range(100_000)):
        numbers = np.array(numbers, dtype=np.uint64)
        assert np.array_equal(backoff.unpacked(backoff.packed(numbers)), numbers)
