"""Merge replay against the tiktoken library, and exact round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from curbline.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PAIRS = bpe.PairRanks(bpe.pair_table(RANKS))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXTS = ["", "Hello world, it's 12 o'clock!!", " leading  and   trailing  ", "tabs\t\tand\n\nlines\r\n", "ünïcödé ßtraße ñandú",
         "日本語のテキスト 한국어", "x²½ a\x1cb\x85c d e", "<|endoftext|> stays text", "aaaaaaaaaaaaaaaaaaaaaaaa" * 20,
         "'s't're've'm'll'd 'S", "a" * 5_000, "😀😀 ‍", "___ -- $$$ ***", " \n \n x", "1234567890 " * 50]


@pytest.mark.parametrize("least_places,wave_symbols", [(1, 64), (3, 5), (48, 64), (10**9, 64), (10**9, 0), (10**9, 8)])
def test_replay_equals_the_library(least_places, wave_symbols):
    rng = random.Random(1)
    words = [bytes(rng.choice(b"aabtheino r\xc3\xa9s1.") for _ in range(rng.randint(1, 25))) for _ in range(3_000)]
    words += [b"a" * 40, b" " * 33, b"\xff\x00\xff", b"the" * 9]
    encoder = bpe.Encoder(RANKS, PAIRS, public_tokenizers.PATTERN)
    ids, sizes = bpe.replay(words, encoder.byte_ids, PAIRS, least_places, wave_symbols)
    for word, own in zip(words, np.split(ids, np.cumsum(sizes)[:-1])):
        assert own.tolist() == LIBRARY._encode_single_piece(word)


def test_encoder_equals_the_library_also_after_forgetting():
    for kept in (5, 10**6):
        encoder = bpe.Encoder(RANKS, PAIRS, public_tokenizers.PATTERN, kept_words=kept)
        for texts in (TEXTS, [None, *TEXTS[::-1]], []):
            ids, sizes = encoder.encode(texts)
            found = np.split(ids, np.cumsum(sizes)[:-1]) if texts else []
            assert [f.tolist() for f in found] == [LIBRARY.encode_ordinary(t or "") for t in texts]


def test_words_asked_for_often_stay():
    encoder = bpe.Encoder(RANKS, PAIRS, public_tokenizers.PATTERN, kept_words=40)
    for k in range(200):
        encoder.encode([f" often again word{k} {k}x"])
    assert {" often", " again"} <= set(encoder.number) and len(encoder.number) < 60
    assert list(encoder.number.values()) == list(range(len(encoder.size))) and len(encoder.uses) == len(encoder.size)


def test_fast_splitting_equals_the_pattern():
    fast, shy = bpe.fast_split(public_tokenizers.PATTERN)
    slow = bpe.Encoder(RANKS, PAIRS, public_tokenizers.PATTERN).slow
    for code in range(bpe.LATIN_END):
        text = f"a{chr(code)}b 1{chr(code)}2 {chr(code)}{chr(code)}  {chr(code)} x"
        assert shy.search(text) or fast.findall(text) == slow.findall(text)
    assert bpe.fast_split(r"\p{Han}+") is None


def test_spark_round_trip(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(99, None), (None, "x y"), (0, TEXTS[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    encoded = bpe.encode(df, RANKS, public_tokenizers.PATTERN, slice_bytes=100)
    found = encoded.withColumn("back", bpe.decoder(spark, RANKS, slice_ids=50)(F.col("ids"))).collect()
    want = sorted((str(i), LIBRARY.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert sorted((str(r["doc_id"]), list(r["ids"]), bytes(r["back"])) for r in found) == want
    assert bpe.encode(df.where("false"), RANKS, public_tokenizers.PATTERN).count() == 0
