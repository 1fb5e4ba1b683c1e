"""Registered queries against their SQL; the pipeline against its stages done plainly."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from conftest import SF_SMALL
from curbline.llm import bpe, simhash
from curbline.llm.common import table
from curbline.llm.queries import ORACLES, QUERIES
from oracle_compare import compare, duckdb_connection


@pytest.mark.parametrize("name,folder", [(n, SF_SMALL) for n in sorted(ORACLES)] + [("op6_lm_scoring", "/root/testdata/sf0.01")])
def test_query_matches_sql(spark, name, folder):
    r = compare(QUERIES[name](spark, folder), duckdb_connection(folder), ORACLES[name])
    assert r["cols_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["rows"][0] == r["rows"][1] and r["hash_match"]


def test_all_thirteen_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF_SMALL, "documents").collect()}
    items = [r["text"] for r in table(spark, SF_SMALL, "benchmark").collect()]
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_SMALL, "labels").collect()}
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert 0 < len(found) < len(docs) and set(found) <= set(docs)
    leaks = {d for d, t in docs.items() if any(i in t for i in items)}
    assert not leaks & set(found)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    prints = {}
    for d, r in found.items():
        assert list(r["ids"]) == library.encode_ordinary(docs[d])
        prints[d] = simhash.fingerprint(docs[d].encode())
    kept = np.array(list(prints.values()), dtype=np.uint64)
    near = np.bitwise_count(kept[:, None] ^ kept[None, :]) <= 3
    assert near.sum() == len(kept)  # no two kept documents are near duplicates
    good = {d for d, q in labels.items() if q == 1 and d not in leaks}
    every = np.array([simhash.fingerprint(t.encode()) for t in docs.values()], dtype=np.uint64)
    alone = {d for d, p in zip(docs, every) if (np.bitwise_count(every ^ p) <= 3).sum() == 1}
    assert len(good & alone & set(found)) >= 0.97 * len(good & alone)
    bad = {d for d, q in labels.items() if q == 0}
    assert len(bad & set(found)) <= 0.05 * max(1, len(bad))


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "decontamination", "encoding"]
    assert corpus_pipeline.ORACLE_SQL is None
