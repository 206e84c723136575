"""Quality classifier with hierarchical empirical Bayes.

1. A logistic regression over counts of a whole text (shares of kinds of characters, word lengths, repetition) is fitted
   on a bounded sample of labelled documents (``max_labelled``, by a hash of the id). Its log-likelihood ratio is
   a document's own evidence.
2. Grouped sums over all documents give each host and each path of a host its share of good documents. Beta priors
   fitted by moments shrink paths toward their host and hosts toward the whole corpus: the fewer documents, the more.
3. A document's posterior adds its evidence to the log-odds of its path, from which the document itself is left out.

Defined results: null and empty texts have evidence 0 and follow their path; a null host or path is a site of its own.
Repeated rows are judged alike. Without labels of both kinds all evidence is 0. Labels of unknown documents and null
labels count for nothing; of several labels for one id the mean counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, packed, row_key, small, text_batches, unpacked

#: Labelled documents that the classifier is fitted on, at most.
MAX_LABELLED = 20_000
#: A document is kept from this posterior on.
KEEP = 0.5
#: Prior documents of a site, at least and at most.
STRENGTH = 2.0, 1e6
#: Copies of each site's row, among which the documents of a hot site are dealt.
SALT = 16

FEATURES = ("upper", "digit", "symbol", "mark", "space", "other", "word_length", "words", "distinct", "repeated", "long")


def _kinds() -> np.ndarray:
    """The kind of each character up to U+024F: 0 lower case, then the first six features; the rest is lower case."""
    kinds = np.zeros(0x251, np.uint8)
    for code in range(0x250):
        c = chr(code)
        kinds[code] = (
            1 if c.isupper() else 2 if c.isdigit() else 5 if c.isspace() else 0 if c.isalpha()
            else 4 if c in ".,;:'\"-()?" else 3 if c.isprintable() else 6
        )
    return kinds


KINDS = _kinds()


def features(text: str) -> list[float]:
    """See FEATURES. Shares enter by their square roots, so that small ones tell."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.bincount(KINDS[np.minimum(codes, 0x250)], minlength=7)[1:7] / max(1, len(codes))
    words = text.split()
    n = max(1, len(words))
    length = (len(codes) - counts[4] * len(codes)) / n
    repeated = sum(map(eq, words, words[1:])) / n
    longest = max(map(len, words), default=0)
    # how many distinct words a text of this length has, against a square-root law
    distinct = len(set(words)) / n
    return [*np.sqrt(counts).tolist(), np.log1p(length), np.log1p(n), distinct, repeated**0.5, np.log1p(longest)]


@dataclass(frozen=True)
class Model:
    """Standardised logistic regression; ``base`` is the log-odds of good among the labelled documents."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float
    base: float

    def evidence(self, rows: np.ndarray) -> np.ndarray:
        z = (rows - np.array(self.mean)) / np.array(self.scale)
        return np.clip(expanded(z) @ np.array(self.weights) + self.bias - self.base, -12, 12)


def expanded(z: np.ndarray) -> np.ndarray:
    """The features and their squares: bad is what lies far out on either side."""
    z = np.clip(z, -6, 6)
    return np.hstack([z, z * z])


def fit(rows: np.ndarray, good: np.ndarray, ridge: float = 1.0, steps: int = 30) -> Model | None:
    """Newton steps on the penalised likelihood; None if only one class is there."""
    if not len(rows) or good.min() == good.max():
        return None
    mean, scale = rows.mean(0), rows.std(0) + 1e-6
    x = np.hstack([np.ones((len(rows), 1)), expanded((rows - mean) / scale)])
    w = np.zeros(x.shape[1])
    penalty = np.eye(x.shape[1]) * ridge
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (good - p) - penalty @ w)
        w = w + step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    share = good.mean()
    return Model(tuple(mean), tuple(scale), tuple(w[1:]), float(w[0]), float(np.log(share / (1 - share))))


def feature_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def make(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t or ""))

    return make(text)


def evidence_column(text: Column, model: Model | None) -> Column:
    """The log-likelihood ratio of good against bad for each text."""
    if model is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        rows = np.array([features(t or "") for t in texts], float).reshape(-1, len(FEATURES))
        known = np.array([bool(t) for t in texts], bool)
        return pd.Series(np.where(known, model.evidence(rows), 0.0))

    return score(text)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_labelled: int = MAX_LABELLED,
) -> Model | None:
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id"))
    known = known.agg((F.avg(label_col) >= 0.5).cast("double").alias("__good"))
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(max_labelled)  # bounded, so it can be broadcast
    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("__text")).filter("__text != ''")
    rows = texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))
    once = rows.select("__id", "__good", feature_column(F.col("__text")).alias("__x")).dropDuplicates(["__id"])
    got = once.orderBy("__id").limit(max_labelled).toPandas()
    return fit(np.array(got["__x"].tolist(), float).reshape(-1, len(FEATURES)), got["__good"].to_numpy(float))


def logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def strength(groups: DataFrame, mean: Column) -> float:
    """Prior documents (a + b of the Beta prior) by moments: how far the groups' shares spread beyond chance."""
    n, s = F.col("n").cast("double"), F.col("good")
    got = groups.agg(
        F.sum(n).alias("n"), F.sum(n * n).alias("nn"), F.count("*").alias("k"),
        F.sum(n * F.pow(s / n - mean, 2)).alias("spread"), F.sum(n * mean * (1 - mean)).alias("chance"),
    ).first()
    if not got["n"] or got["k"] < 2:
        return STRENGTH[1]
    variance = got["chance"] / got["n"]
    between = (got["spread"] - (got["k"] - 1) * variance) / max(got["n"] - got["nn"] / got["n"], 1e-9)
    return float(min(max(variance / between - 1, STRENGTH[0]), STRENGTH[1])) if between > 0 else STRENGTH[1]


def site_priors(scored: DataFrame) -> DataFrame:
    """One row per (host, path): n, good (sum of the documents' own probabilities), the prior and its strength."""
    paths = cut(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("own").alias("good")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    whole = hosts.agg(F.sum("good") / F.sum("n")).first()[0]
    whole = 0.5 if whole is None else float(whole)
    k = strength(hosts, F.lit(whole))
    hosts = hosts.select(
        F.col("host").alias("__host"), ((F.col("good") + k * whole) / (F.col("n") + k)).alias("host_prior")
    )
    # a hot host has many paths, but each path has one row here
    joined = paths.join(small(hosts), F.col("host").eqNullSafe(F.col("__host"))).drop("__host")
    k = strength(joined, F.col("host_prior"))
    return joined.withColumn("strength", F.lit(k))


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    path_cols: Sequence[str] = ("lang",), label_col: str = "quality", max_labelled: int = MAX_LABELLED,
    keep: float = KEEP,
) -> DataFrame:
    """Per row: doc_id, host, path, evidence, prior, posterior, kept and two key columns that name the row."""
    text_batches(docs.sparkSession)
    model = train(docs, labels, id_col, text_col, label_col, max_labelled)
    path = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in path_cols])
    host = F.col(host_col).cast("string")
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), host.alias("host"), path.alias("path"),
        *row_key(F.col(id_col), host, path, F.col(text_col)), evidence_column(F.col(text_col), model).alias("evidence"),
    )
    own = 1 / (1 + F.exp(-(F.col("evidence") + (model.base if model else 0.0))))
    scored = cut(narrow.withColumn("own", own))  # one narrow row for each document: the texts are scored once
    salted = site_priors(scored).select(
        F.col("host").alias("__host"), F.col("path").alias("__path"), "n", "good", "host_prior", "strength",
        F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("__salt"),
    )
    salt = F.pmod(F.col("__key1"), F.lit(SALT))
    at = (F.col("path") == F.col("__path")) & F.col("host").eqNullSafe(F.col("__host")) & (salt == F.col("__salt"))
    known = scored.join(small(salted), at)
    prior = (F.col("good") - F.col("own") + F.col("strength") * F.col("host_prior")) / (F.col("n") - 1 + F.col("strength"))
    known = known.withColumn("prior", prior)
    posterior = 1 / (1 + F.exp(-(F.col("evidence") + logit(F.col("prior")))))
    known = known.withColumn("posterior", posterior).withColumn("kept", F.col("posterior") >= keep)
    return known.select("doc_id", "host", "path", "evidence", "prior", "posterior", "kept", "__key1", "__key2")


def keep_good(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with their columns."""
    id_col, text_col = how.get("id_col", "doc_id"), how.get("text_col", "text")
    rejected = judge(docs, labels, **how).filter(~F.col("kept")).select("__key1", "__key2").distinct()
    path = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in how.get("path_cols", ("lang",))])
    host = F.col(how.get("host_col", "source")).cast("string")
    keyed = docs.select(packed(docs), *row_key(F.col(id_col), host, path, F.col(text_col)))
    return unpacked(keyed.join(small(rejected), ["__key1", "__key2"], "left_anti"), docs.columns)
