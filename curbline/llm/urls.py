"""URL verdicts: host and path rules, and for the rest a logistic regression on hashed character n-grams.

The host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path goes on
from there up to ``?``, ``#`` or the end. Both are empty for a null url or one without ``://``. A rule (verdict, host,
path) fits its host and all subdomains where the url's path starts with the rule's path; the longest rule wins (host
and path together, then the longer host). Where no rule fits, the model decides: the sum of the weights of the
distinct n-grams of host and path (told apart), as a probability of ``block``.

The model is trained on the driver from a small labelled table, at most ``max_train`` rows of it; its size is fixed by
``buckets``. Rules are few: they become one expression each. Each url is judged on its own, nothing is shuffled; a url
that fills a third of all rows costs no task more than its rows. Without labelled rows the model allows all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import ship_package

BUCKETS = 1 << 15
SIZES = (3, 4, 5)
MAX_TRAIN = 20_000


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def winning_rule(rules: Iterable[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits."""
    order = sorted(rules, key=lambda r: (len(r.host) + len(r.path), len(r.host)), reverse=True)
    pick = [reduce(lambda chain, rule: chain.when(rule.fits(host, path), F.lit(value(rule))), order, F)
            if order else F.lit(None).cast("string")
            for value in (lambda r: r.host + r.path, lambda r: r.verdict)]
    return pick[0], pick[1]


def grams(host: str, path: str, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of the distinct n-grams of ``^host$`` and ``^path$``; the two parts never share an n-gram."""
    found = set()
    for part, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in SIZES:
            found.update(part + text[k:k + n] for k in range(len(text) - n + 1))
    return np.unique(np.fromiter((zlib.crc32(g.encode("utf-8")) % buckets for g in found), np.int64, len(found)))


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def block(self, host: str, path: str) -> float:
        """Probability of ``block``."""
        some = grams(host, path, len(self.weights))
        logit = self.bias + float(self.weights[some].sum()) / max(1.0, len(some)) ** 0.5
        return 1 / (1 + np.exp(-min(30.0, max(-30.0, logit))))


def fit(rows: list[tuple[str, str, int]], buckets: int = BUCKETS, epochs: int = 300, rate: float = 0.5,
        decay: float = 1e-4) -> Model:
    """Logistic regression (1: block) by gradient descent over all rows, each n-gram weighted 1/sqrt(n-grams)."""
    weights, bias = np.zeros(buckets), 0.0
    if not rows:
        return Model(weights, -30.0)
    some = [grams(host, path, buckets) for host, path, _ in rows]
    labels = np.array([label for _, _, label in rows], dtype=np.float64)
    index, sizes = np.concatenate(some), np.array([len(s) for s in some])
    scale = np.repeat(1 / np.sqrt(sizes), sizes)
    starts = np.cumsum(sizes) - sizes
    share = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))  # both labels alike
    for _ in range(epochs):
        logit = bias + np.add.reduceat(weights[index] * scale, starts)
        wrong = (1 / (1 + np.exp(-logit)) - labels) * share * 10
        weights -= rate * (np.bincount(index, np.repeat(wrong, sizes) * scale, buckets) + decay * weights)
        bias -= rate * 0.1 * float(wrong.sum())
    return Model(weights, bias)


def learn(labelled: DataFrame, max_train: int = MAX_TRAIN, buckets: int = BUCKETS) -> Model:
    """A model from columns ``url`` and ``verdict`` (``block`` or ``allow``); other and null verdicts teach nothing."""
    rows = (labelled.where(F.col("url").isNotNull() & F.col("verdict").isin("block", "allow"))
            .select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                    (F.col("verdict") == "block").cast("int").alias("label"))
            # which rows of a larger table teach is left to a hash, not to the alphabet
            .orderBy(F.xxhash64("host", "path", "label"), "host", "path", "label")
            .limit(max_train).collect())  # at most max_train rows
    return fit([tuple(row) for row in rows], buckets)


def judge(pages: DataFrame, model: Model, rules: Iterable[Rule] = (), url_col: str = "url",
          threshold: float = 0.5) -> DataFrame:
    """All columns of ``pages`` and the struct ``judged``: ``host``, ``path``, ``rule``, ``verdict``, ``block_score``."""
    ship_package(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for host, path in batches:
            yield pa.array([sent.value.block(h, p) for h, p in zip(host.to_pylist(), path.to_pylist())], pa.float64())

    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rule, verdict = winning_rule(list(rules), host, path)
    by_model = score(host, path)
    return pages.withColumn("judged", F.struct(
        host.alias("host"), path.alias("path"), rule.alias("rule"),
        F.coalesce(verdict, F.when(by_model >= threshold, "block").otherwise("allow")).alias("verdict"),
        by_model.alias("block_score")))
