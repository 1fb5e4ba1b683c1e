"""CGK search: recall on planted copies, exact verification against a plain dynamic programme, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import decontam
from curbline.llm.common import table


def plain_nearest(item, text):
    """Smallest edit distance of item to any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        new = [i]
        for j, other in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (word != other)))
        row = new
    return min(row)


def edited(words, edits, rng, vocabulary):
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(words)), rng.random()
        if kind < 0.34:
            words[at] = rng.choice(vocabulary)
        elif kind < 0.67:
            del words[at]
        else:
            words.insert(at, rng.choice(vocabulary))
    return words


def test_nearest_equals_a_plain_programme():
    rng = random.Random(4)
    for _ in range(300):
        item = np.array([rng.randint(1, 5) for _ in range(rng.randint(1, 9))])
        text = np.array([rng.randint(1, 5) for _ in range(rng.randint(0, 15))])
        want = plain_nearest(item.tolist(), text.tolist())
        assert decontam.nearest(item, text, want - 1) is None
        distance, first, end = decontam.nearest(item, text, want)
        assert distance == want
        inside = text[first:end].tolist()
        row = list(range(len(inside) + 1))
        for i, word in enumerate(item.tolist(), 1):
            row = [i] + [0] * len(inside) if not inside else row
            new = [i]
            for j, other in enumerate(inside, 1):
                new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (word != other)))
            row = new
        assert row[-1] == want  # the stretch named is at that distance


@pytest.mark.parametrize("rate,least", [(0.0, 1.0), (0.1, 0.97), (0.2, 0.9)])
def test_recall_on_planted_copies(rate, least):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in rng.choices(range(3000), [1 / (k + 10) for k in range(3000)], k=6000)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 90)))) for k in range(150)]
    index, codes, texts = decontam.Index(items, decontam.Settings()), decontam.WordCodes(), []
    for _, text in items:
        words = text.split()
        copy = edited(words, int(rate * len(words)), rng, vocabulary)
        around = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 150))] for _ in range(2)]
        texts.append(codes(" ".join(around[0] + copy + around[1])))
    found = index.find(texts)
    assert sum((k, k) in found for k in range(len(items))) >= least * len(items)
    for (text, item), (distance, first, end) in found.items():  # whatever is reported is within the bound
        words = index.items[item][1]
        assert distance <= 0.2 * len(words)
        assert plain_nearest(words.tolist(), texts[text].tolist()) <= distance


def test_whole_tables_against_containment(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    found = {(r["doc_id"], r["item_id"]) for r in decontam.contaminations(docs, items).collect()}
    held = {(d["doc_id"], i["item_id"]) for d in docs.collect() for i in items.collect() if i["text"] in d["text"]}
    assert held <= found and len(held) > 0
    clean = {r["doc_id"] for r in decontam.without_contamination(docs, items).collect()}
    assert clean == {r["doc_id"] for r in docs.collect()} - {d for d, _ in found}


def test_edge_cases(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    rows = [(1, f"before {item.upper()}! after"), (2, None), (3, ""), (4, "alpha beta"), (None, item), (1, item), (5, "x " * 50_000 + item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (9, ""), (None, item), (10, "...")], "item_id long, text string")
    found = decontam.contaminations(docs, items).collect()
    assert sorted(((r["doc_id"], r["item_id"], r["edit_distance"]) for r in found), key=str) == [(1, 7, 0), (5, 7, 0), (None, 7, 0)]
    assert {(r["doc_id"]): (r["first_word"], r["last_word"]) for r in found}[5] == (50_000, 50_013)
    clean = decontam.without_contamination(docs, items)
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.collect()) == [2, 3, 4]
    assert decontam.contaminations(docs, items.where("false")).count() == 0
    assert decontam.contaminations(docs.where("false"), items).count() == 0
    assert decontam.without_contamination(docs, items.where("false")).count() == len(rows)
    blocks = list(decontam.item_blocks(items, block_items=1))
    assert all(len(b) == 1 for b in blocks) and len(blocks) == 3
