"""From raw documents to token ids: quality, language, near-duplicates, benchmark decontamination, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)``, calls one operator of ``curbline.llm`` on all that the stage before it
kept and returns the columns of documents; the last returns the encoded documents. ``run`` writes what a stage keeps
as Parquet in the shared folder and reads it back for the next, so that a lost executor costs one stage's tasks.

Null or empty texts have no letters and go in the language stage. A row whose id is null teaches no model, and stands for
its group of near-duplicates only where no row of it has an id; rows that repeat an id are judged by their texts. Extra
columns of ``documents`` pass through to the last stage. Empty tables give an empty result. What a stage kept is deleted
once the next one's result is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm import decontam, langid, quality, simhash
from curbline.llm.common import discarded, held_out, stored, table
from curbline.llm.queries import ACCEPTED, bpe_digests

#: A text whose n-grams are this far from every learned language belongs to none of them.
LEAST_CLOSENESS = 0.15


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the quality classifier accepts; it learns from labels outside the held-out fold."""
    machine = quality.learn(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    scored = quality.with_score(docs, machine, name="_quality")
    return scored.where(F.col("_quality") >= ACCEPTED).drop("_quality")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in one of the languages that the documents outside the held-out fold are marked with."""
    profiles = langid.learn(docs, ~held_out(F.col("doc_id")))
    judged = langid.with_language(docs, profiles, name="_language")
    known = (F.col("_language.lang") != langid.UNDETERMINED) & (F.col("_language.score") >= LEAST_CLOSENESS)
    return judged.where(known).drop("_language")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of SimHash near-duplicates."""
    return simhash.one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item."""
    return decontam.without_contamination(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the bytes decoded from them."""
    return bpe_digests(docs, with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]

#: SQL can't express the trained models, SimHash components or byte-pair merges: the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    read = None
    for name, stage in STAGES[:-1]:
        docs, before = stored(stage(spark, docs, sf_dir), f"pipeline-{name}"), read
        read = docs
        if before is not None:
            discarded(before)
    return STAGES[-1][1](spark, docs, sf_dir)
