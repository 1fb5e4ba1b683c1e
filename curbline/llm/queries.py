"""The registered queries of the training-data operators: thin digests of what each operator returns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm import align, backoff, bpe, decontam, html_main, langid, quality, repeats, simhash, topk, urls, warc, whiten
from curbline.llm.common import held_out, scratch_path, table
from curbline.llm.labelled_urls import labelled_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back through the verified chain of records."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                  "refers_to")


ORACLES["op1_warc"] = """
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN strlen(h) >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(h) >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
      FROM pages)
"""


def bpe_digests(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """Digests of the ids and of the decoded bytes of each text, on request with the ids."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    decoded = bpe.decoder(docs.sparkSession, ranks)(F.col("ids"))
    return encoded.select("doc_id", *["ids"] * with_ids, F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2(decoded, 256).alias("decoded_sha256"))


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the 50k rank file, and the bytes decoded from them."""
    return bpe_digests(table(spark, sf_dir, "documents"))


def learned_quality(spark: SparkSession, sf_dir: str) -> quality.Machine:
    """The quality model of the labelled documents outside the held-out fold."""
    return quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))


ACCEPTED = 0.3  # scores from here on count as good


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a model that has not seen the held-out fold's labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    found = quality.with_score(docs, learned_quality(spark, sf_dir))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, links at 3 bits or fewer."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


URL_RULES = [  # fixed values: verdict, host, path
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or model verdict on the url of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urls.judge(pages, urls.learn(labelled_urls(spark)), URL_RULES)
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict",
                         "judged.block_score")


@query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document by the counts of the whole corpus."""
    found = backoff.whole_scores(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"),
                        F.round(F.col("log_score") / F.greatest("n_words", F.lit(1)), 6).alias("mean_log_score"))


ORACLES["op6_lm_scoring"] = """
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\x0B\\f\\r]+') AS words
  FROM documents
), u AS (SELECT doc_id, generate_subscripts(words, 1) AS k, unnest(words) AS w FROM t),
c AS (SELECT w, count(*) AS n FROM u GROUP BY w),
total AS (SELECT sum(n) AS n FROM c),
m AS (SELECT u.doc_id, u.k, u.w, c.n FROM u JOIN c ON u.w = c.w),
p AS (SELECT b.doc_id, b.w, b.n, CASE WHEN b.k = 1 THEN '<begin mark> ' ELSE a.w END AS before_w,
             CASE WHEN b.k = 1 THEN (SELECT count(*) FROM t WHERE len(words) > 0) ELSE a.n END AS before_n
      FROM m b LEFT JOIN m a ON a.doc_id = b.doc_id AND a.k = b.k - 1),
g AS (SELECT *, count(*) OVER (PARTITION BY before_w, w) AS together FROM p),
s AS (SELECT doc_id, count(*) AS n_words,
             sum(CASE WHEN together >= 2 THEN ln(CAST(together AS DOUBLE) / before_n)
                      ELSE ln(0.4 * CAST(n AS DOUBLE) / (SELECT n FROM total)) END) AS log_score
      FROM g GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, round(coalesce(log_score, 0.0), 4) AS log_score,
       round(coalesce(log_score / n_words, 0.0), 6) AS mean_log_score
FROM (SELECT DISTINCT doc_id FROM t) t LEFT JOIN s ON s.doc_id = t.doc_id
"""


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or edited in at most a fifth of its words, with the stretch."""
    return decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors of every vector whose id is divisible by 50, by inner product of floor(256 x)."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


ORACLES["op8_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, x FROM v) q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.x) = len(q.x)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def learned_languages(spark: SparkSession, sf_dir: str) -> dict:
    """Language profiles of the documents outside the held-out fold."""
    return langid.learn(table(spark, sf_dir, "documents"), ~held_out(F.col("doc_id")))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; profiles come from all labelled documents outside the held-out fold."""
    found = langid.predict(table(spark, sf_dir, "documents"), learned_languages(spark, sf_dir))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by its site's style tree."""
    found = html_main.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document between the byte-level and the sentence-piece vocabulary."""
    files = align.Tokenizers.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
                                  public_tokenizers.path("piece_bpe_32k.model"))
    return align.alignment_scores(table(spark, sf_dir, "documents"), files).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that are left without the passages of 50 words that a smaller id has too."""
    return repeats.kept_digests(table(spark, sf_dir, "documents"), least=50)


ORACLES["op12_substring_dedup"] = """
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS words
  FROM documents
), w AS (
  SELECT r, doc_id, k, sha256(array_to_string(list_slice(words, k, k + 49), ' ')) AS h
  FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 48)) AS k FROM t WHERE len(words) >= 50)
), f AS (SELECT h, min(doc_id) AS first_id FROM w GROUP BY h),
again AS (SELECT w.r, w.k FROM w JOIN f USING (h) WHERE w.doc_id > f.first_id OR (w.doc_id IS NULL AND f.first_id IS NOT NULL)),
gone AS (SELECT DISTINCT r, unnest(range(k, k + 50)) AS k FROM again),
listed AS (SELECT r, list(k) AS ks, count(*) AS n FROM gone GROUP BY r)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN words
              ELSE list_transform(list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(ks, i)),
                                  lambda i: words[i]) END, ' ')) AS kept_sha256
FROM t LEFT JOIN listed USING (r)
"""


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every usable vector, with the fit's figures."""
    found, model = whiten.whiten(table(spark, sf_dir, "embeddings"), components=32)
    each = found.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    shares = F.array(*[F.lit(float(v)) for v in (model.explained if model else [])]).cast("array<double>")
    return each.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
                       "deviation", "whitened", F.get(shares, F.col("place")).alias("explained"),
                       F.lit(model.identity_error if model else 0.0).alias("identity_error"))
