"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Statistics are computed once over every whole text in the JVM and written; class means and covariances are sums over all
labelled rows made by one aggregation (no sample). Each class covariance is shrunk towards the pooled one and towards a
multiple of the identity, factored once by Cholesky, and the inverse factors are kept in the model. A score is the
logistic of the difference of the two Mahalanobis log densities plus the log prior ratio, as plain column arithmetic.

Defined results: null and empty texts have statistics of an empty text and get a score like any other; labels that are
null, not 0 or 1, or that contradict each other for a document are left out; without rows of both classes the score is
the share of ones (one half with no labels at all); repeated rows are scored alike; an empty table gives an empty result.
Only ``text`` is an input of a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, crc_bucket, materialise, table, words

FOLDS = 5
THRESHOLD = 0.3
UPPER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


#: A share is smoothed by so many words (or characters) of ordinary prose, so that a text of few words, which shows
#: little, comes out near ordinary prose and not at an extreme.
PRIOR_WORDS, PRIOR_CHARS = 30.0, 180.0


def _share(part: Column, of: Column, usual: float, prior: float) -> Column:
    """Log of the smoothed share; ``usual`` is that of ordinary prose."""
    return F.log(F.lit(1e-3) + (part.cast("double") + F.lit(prior * usual)) / (of.cast("double") + F.lit(prior)))


def statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """The input's rows without its text, with the transformed statistics f0, f1, ... of it; and their names."""
    t = F.coalesce(F.col(text), F.lit(""))
    keep = [c for c in docs.columns if c != text]
    raw = docs.select(*keep, t.alias("_t"), words(F.col(text)).alias("_w"))
    gone = lambda chars: F.length("_t") - F.length(F.translate("_t", chars, ""))
    raw = raw.select(
        *keep,
        F.size("_w").cast("double").alias("_n"), F.length("_t").cast("double").alias("_c"), F.length(F.translate("_t", BLANKS, "")).alias("_k"),
        F.size(F.array_distinct("_w")).alias("_u"), F.expr("size(filter(_w, x -> length(x) <= 3))").alias("_s"),
        gone("#*$%&|<>^~=+_\\").alias("_y"), gone(UPPER).alias("_up"), gone(DIGITS).alias("_dg"), gone(".,;:").alias("_pt"), gone("!?").alias("_ex"), gone("\n").alias("_nl"),
        F.expr("transform(array(split(_t, '\\n')), l -> size(l) - size(array_distinct(l)))[0]").alias("_dl"),
    )
    n, c = F.col("_n"), F.col("_c")
    stats = [
        (F.col("_k") + F.lit(PRIOR_WORDS * 5.0)) / (n + F.lit(PRIOR_WORDS)),
        _share(F.col("_u"), n, 0.85, PRIOR_WORDS),
        _share(F.col("_s"), n, 0.4, PRIOR_WORDS),
        _share(F.col("_y"), c, 0.0005, PRIOR_CHARS),
        _share(F.col("_up"), c, 0.02, PRIOR_CHARS),
        _share(F.col("_dg"), c, 0.002, PRIOR_CHARS),
        _share(F.col("_pt"), c, 0.025, PRIOR_CHARS),
        _share(F.col("_ex"), c, 0.0005, PRIOR_CHARS),
        _share(F.col("_nl"), n, 0.03, PRIOR_WORDS),
        _share(F.col("_dl"), F.col("_nl") + 1, 0.02, 10.0),
    ]
    names = [f"f{i}" for i in range(len(stats))]
    return raw.select(*keep, *[s.alias(f) for s, f in zip(stats, names)]), names


@dataclass
class Discriminant:
    """Standardisation, class means, inverse Cholesky factors and constants of the two densities."""

    names: list[str]
    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    inverse_factors: list[np.ndarray]
    constants: list[float]
    fallback: float | None = None

    def log_density(self, k: int) -> Column:
        z = [(F.col(f) - float(m)) / float(s) for f, m, s in zip(self.names, self.centre, self.scale)]
        total = F.lit(self.constants[k])
        for i, row in enumerate(self.inverse_factors[k]):
            y = F.lit(0.0)
            for j in range(i + 1):
                y = y + (z[j] - float(self.means[k][j])) * float(row[j])
            total = total - y * y * 0.5
        return total

    def score(self) -> Column:
        if self.fallback is not None:
            return F.lit(self.fallback)
        odds = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), self.log_density(1) - self.log_density(0)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fit(stats: DataFrame, names: list[str], label: str = "label", to_pooled: float = 0.1, to_identity: float = 0.02) -> Discriminant:
    """``stats`` has the statistics and a label of 0 or 1. to_pooled, to_identity: shares of the shrinkage."""
    d = len(names)
    sums = [F.count(F.lit(1)).alias("n")] + [F.sum(f).alias(f"s{i}") for i, f in enumerate(names)]
    sums += [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"q{i}_{j}") for i in range(d) for j in range(i + 1)]
    rows = {r["_y"]: r for r in stats.groupBy(F.col(label).cast("int").alias("_y")).agg(*sums).collect()}  # two rows
    n = [rows[k].n if k in rows else 0 for k in (0, 1)]
    if min(n) < 2:
        return Discriminant(names, np.zeros(d), np.ones(d), [], [], [], n[1] / sum(n) if sum(n) else 0.5)
    s = [np.array([rows[k][f"s{i}"] for i in range(d)]) for k in (0, 1)]
    q = [np.array([[rows[k][f"q{max(i, j)}_{min(i, j)}"] for j in range(d)] for i in range(d)]) for k in (0, 1)]
    centre = (s[0] + s[1]) / sum(n)
    scale = np.sqrt(np.maximum(np.diag(q[0] + q[1]) / sum(n) - centre**2, 1e-6))
    means, covs = [], []
    for k in (0, 1):
        m = s[k] / n[k]
        covs.append((q[k] / n[k] - np.outer(m, m)) / np.outer(scale, scale))
        means.append((m - centre) / scale)
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / sum(n)
    inverse, constants = [], []
    for k in (0, 1):
        c = (1 - to_pooled) * covs[k] + to_pooled * pooled
        c = (1 - to_identity) * c + to_identity * max(np.trace(c) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(c)
        inverse.append(np.linalg.solve(factor, np.eye(d)))
        constants.append(float(math.log(n[k] / sum(n)) - np.log(np.diag(factor)).sum()))
    return Discriminant(names, centre, scale, means, inverse, constants)


def clean_labels(labels: DataFrame, column: str = "quality") -> DataFrame:
    """One row (doc_id, label) for each document with one agreed label."""
    ok = labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull())
    per = ok.groupBy("doc_id").agg(F.min(column).alias("label"), F.max(column).alias("_hi"))
    return per.where("label = _hi").select("doc_id", "label")


def classify(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted); learns from labelled documents outside the held-out fold."""
    stats, names = statistics(docs.select("doc_id", "text"))
    stats = materialise(stats, "quality-stats")
    known = stats.join(clean_labels(labels), "doc_id").where(crc_bucket(F.col("doc_id"), folds) != 0)
    model = fit(known, names)
    out = stats.select("doc_id", (crc_bucket(F.col("doc_id"), folds) == 0).alias("held_out"), model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The input rows whose text scores at least ``threshold``; all columns as they came.

    Texts are measured once; the rows to keep are found by key and text hash.
    """
    tag = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    stats, names = statistics(docs.select("doc_id", "text", tag.alias("_tag")))
    stats = materialise(stats, "quality-stats")
    model = fit(stats.join(clean_labels(labels), "doc_id"), names)
    good = stats.where(model.score() >= threshold).select(F.col("doc_id").alias("_id"), F.col("_tag").alias("_kept")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_key"), tag.alias("_tag"))
    rows = rows.join(good, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_tag") == F.col("_kept")), "left_semi")
    return rows.select("_row.*")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
