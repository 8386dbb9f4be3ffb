"""Quality classifier: document evidence combined with host and path posteriors by hierarchical empirical Bayes.

A logistic model on byte and word statistics gives each document's evidence. Grouped aggregation sums
the evidence by path and host; a path is shrunk toward its host and a host toward the global rate, by
prior strengths that the method of moments takes from the groups themselves. A document's score is its
own log odds plus the shift of its path's posterior from the global rate, where the sums of its path and
host leave the document itself out, so that its evidence counts once.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import small_batches, small_side, trimmed, written

#: Labelled rows on which the document model is fitted: those of the smallest hashes of their ids.
SAMPLE = 6_000
#: Least and greatest prior strength, in documents.
STRENGTH = (5.0, 1000.0)
ADDED = ("quality_evidence", "quality_shift", "quality_score")
PUNCTUATION = np.frombuffer(string.punctuation.encode(), np.uint8)


def features(text: bytes) -> np.ndarray:
    """Statistics of a whole UTF-8 text; an empty one has zeros."""
    count, n = np.bincount(np.frombuffer(text, np.uint8), minlength=256), max(1, len(text))
    words, lines = text.split(), text.split(b"\n")
    upper, lower, high = count[65:91].sum(), count[97:123].sum(), count[128:].sum()
    head = [upper / max(1, upper + lower), lower / n, high / n, count[48:58].sum() / n, count[32] / n, count[10] / n, np.log1p(len(words)), len(text) / max(1, len(words)) / 10, len(set(words)) / max(1, len(words)), 1 - len(set(lines)) / len(lines)]
    return np.r_[head, np.log1p(1000 * count[PUNCTUATION] / n) / 3]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale @ self.weight + self.bias, -12, 12)


def fit(rows: np.ndarray, good: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> Model:
    """Ridge logistic regression by Newton steps; with one class only, a constant."""
    if not len(rows) or good.min() == good.max():
        return Model(np.zeros(rows.shape[1] if rows.ndim == 2 else 42), np.ones(rows.shape[1] if rows.ndim == 2 else 42), np.zeros(rows.shape[1] if rows.ndim == 2 else 42), 0.0 if not len(rows) else (4.0 if good[0] else -4.0))
    mean, scale = rows.mean(0), rows.std(0) + 1e-6
    x = np.c_[(rows - mean) / scale, np.ones(len(rows))]
    w, keep = np.zeros(x.shape[1]), np.r_[np.full(rows.shape[1], ridge), 1e-6]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep), x.T @ (good - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Model(mean, scale, w[:-1], float(w[-1]))


@F.arrow_udf(ArrayType(DoubleType()))
def _features(text: pa.Array) -> pa.Array:
    return pa.array([features(t.as_py() or b"").tolist() for t in text.cast(pa.binary())], pa.list_(pa.float64()))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """The document model, from `sample` rows of labels (doc_id, quality) with their texts. Null labels and texts without a label are left out; of repeated labels of a document the smaller holds."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("of")).agg(F.min("quality").alias("good"))
    picked = F.broadcast(known.orderBy(F.xxhash64("of"), "of").limit(sample))  # a bounded number of ids and flags
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).join(picked, F.col("id") == F.col("of")).select("id", "good", _features("t").alias("f"))
    got = rows.orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()
    return fit(np.array(got["f"].to_list()).reshape(len(got), -1) if len(got) else np.zeros((0, 42)), got["good"].to_numpy(np.float64))


def evidence(text: Column, model: Model) -> Column:
    """Log odds of good quality, from the text alone."""

    @F.arrow_udf("double")
    def score(t: pa.Array) -> pa.Array:
        rows = [features(x.as_py() or b"") for x in t.cast(pa.binary())]
        found = pa.array(model.log_odds(np.stack(rows)) if rows else [], pa.float64())
        trimmed()
        return found

    return score(text.cast("string"))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


@dataclass
class Sites:
    """(host, path, n, s, n_host, s_host): documents and summed probabilities of each path and its host; the prior strengths and the global rate."""

    paths: DataFrame
    rate: float
    k_host: float
    k_path: float

    def shift(self, own: Column | float = 0.0, one: int = 0) -> Column:
        """A path's posterior log odds less the global ones; own probability and 1 leave a document out of the sums."""
        host = (F.greatest(F.col("s_host") - own, F.lit(0.0)) + self.k_host * self.rate) / (F.col("n_host") - one + self.k_host)
        post = (F.greatest(F.col("s") - own, F.lit(0.0)) + self.k_path * host) / (F.col("n") - one + self.k_path)
        return _logit(post) - float(np.log(self.rate / (1 - self.rate)))


def sites(scored: DataFrame) -> Sites:
    """From (host, path, log_odds) of all documents.

    Sums have map-side combining, so a host with a third of all rows is no hot group; strengths come from a few sums.
    """
    paths = written(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(_probability(F.col("log_odds"))).alias("s")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n_host"), F.sum("s").alias("s_host"))
    n, s = paths.agg(F.sum("n"), F.sum("s")).first()
    rate = min(max((s or 0.0) / (n or 1), 0.01), 0.99)

    def strength(groups: DataFrame, n: str, s: str, centre: Column) -> float:
        """Of a beta prior: from the spread of group means beyond that of sampling, weighted by size."""
        spread, expected = groups.agg(F.sum(F.col(n) * (F.col(s) / F.col(n) - centre) ** 2), F.sum(centre * (1 - centre))).first()
        between = ((spread or 0.0) - (expected or 0.0)) / max(1.0, float(groups.agg(F.sum(n)).first()[0] or 1))
        return float(np.clip(rate * (1 - rate) / between - 1 if between > 0 else STRENGTH[1], *STRENGTH))

    k_host = strength(hosts, "n_host", "s_host", F.lit(rate))
    both = paths.withColumnRenamed("host", "h").join(hosts, F.col("h").eqNullSafe(F.col("host"))).select("host", "path", "n", "s", "n_host", "s_host")
    prior = (F.col("s_host") + k_host * rate) / (F.col("n_host") + k_host)
    return Sites(both, rate, k_host, strength(both, "n", "s", prior))


def score(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """docs (of them the named columns, or all) with quality_evidence, quality_shift and quality_score (their sum, in log odds); a score below 0 rejects.

    One row per row of docs, whose own columns stay; one called like an added column is replaced. Null hosts
    and paths are groups of their own, null texts are empty ones. Without labels every document's evidence
    is 0. The text model runs once over docs, unless the texts are asked for: a second run of it costs less
    than a second copy of all texts in the shared folder.
    """
    small_batches(docs.sparkSession)
    model = train(docs, labels, id_col, text_col)
    keep = [c for c in (docs.columns if columns is None else columns) if c.lower() not in ADDED]
    # the columns of docs travel in one struct, so that none of them can clash
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in keep)).alias("doc"), host.alias("host"), path.alias("path"), evidence(docs[f"`{text_col}`"], model).alias("evidence"))
    once = written(rows if text_col not in keep else rows.drop("doc"), "quality-rows")
    rows = once if text_col not in keep else rows
    found = sites(once.select("host", "path", F.col("evidence").alias("log_odds")))
    side = small_side(written(found.paths.withColumnsRenamed({"host": "of_host", "path": "of_path"}), "quality-sites"))
    both = rows.join(side, F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path")))
    both = both.withColumn("shift", found.shift(_probability(F.col("evidence")), 1))
    return both.select("doc.*", F.col("evidence").alias(ADDED[0]), F.col("shift").alias(ADDED[1]), (F.col("evidence") + F.col("shift")).alias(ADDED[2]))
