"""Quality classifier (operator 4): document evidence and site posteriors by hierarchical
empirical Bayes.

A logistic classifier (numpy, a dozen figures of a text) gives each document a probability of
good quality. Its sums over hosts and over paths of hosts come from grouped aggregation. Two
beta priors are fitted by moments: hosts around the global mean, paths around their host.
A path's posterior shrinks to its host's, a host's to the global mean, the more the fewer
documents it has (the document itself left out, so it does not vouch for itself). The result
adds the path's log odds over the global ones to the document's own.

Defined results: a null text counts as empty; a null host or path is the site ''; an id with
several labels is good only if all say so; without labels of both kinds every document has
probability 0.5; repeated rows each give their own row (and are one training row); an empty
table gives an empty result; further columns are ignored. Memory: one Arrow batch a task; the
training sample's figures (``sample`` rows of 12 numbers, twice as many at most) on the driver.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.llm.common import map_batches, stored, whole_text
from featuremill.llm.samples import drawn, hashed_rows, labelled_rows, texts_of
from featuremill.operators.skew import salted_left_join

#: Labelled documents that the classifier is fitted on, at most twice as many.
SAMPLE = 8000
SYMBOLS = re.compile(r"[#*$%&|<>{}\[\]\\^~=@_]")
SHOUTS = re.compile(r"[!?]")


def figures(text: str) -> np.ndarray:
    """Figures of a text, all of them small numbers."""
    n = max(1, len(text))
    words = text.split()
    m = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(str.isalpha, text))
    return np.array([
        np.log1p(len(words)), len(text) / m, letters / n, sum(map(str.isupper, text)) / max(1, letters),
        sum(map(str.isdigit, text)) / n, 10 * len(SYMBOLS.findall(text)) / n, 10 * len(SHOUTS.findall(text)) / n,
        len(set(words)) / m, 1 - len(set(lines)) / max(1, len(lines)), m / max(1, len(lines)) / 100,
        sum(len(w) > 25 for w in words) / m, float(len(words) < 10)])


class Logistic:
    """Ridge logistic regression on standardised figures, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25):
        both = len(y) and 0 < y.mean() < 1
        self.mean = x.mean(axis=0) if both else 0.0
        self.scale = x.std(axis=0) + 1e-6 if both else 1.0
        self.weights = np.zeros(x.shape[1] + 1)
        if not both:
            return
        z = self._design(x)
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(steps):
            p = self._logistic(z @ self.weights)
            gradient = z.T @ (p - y) + penalty * self.weights
            curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
            move = np.linalg.solve(curve, gradient)
            self.weights -= move / max(1.0, np.abs(move).max() / 2)
        self.weights = np.clip(self.weights, -50, 50)

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([z, np.ones((len(z), 1))])

    @staticmethod
    def _logistic(f: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(f, -40, 40)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._logistic(self._design(x) @ self.weights), 1e-6, 1 - 1e-6)


def train(df: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Logistic:
    """The classifier from the texts of ``df`` (doc_id, text) and ``labels`` (doc_id, quality)."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label")))
    rows = hashed_rows(df)
    told = labelled_rows(rows, known)
    chosen = told.where(drawn(told.count(), sample, "quality"))
    texts = texts_of(rows, chosen, 2 * sample).select("doc_id", "text_hash", "text", "label")

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [figures(t).tobytes() for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), batch.column("label"), pa.array(own, pa.binary())],
            names=["doc_id", "text_hash", "label", "figures"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = (map_batches(texts, measure, f"doc_id {id_type}, text_hash long, label int, figures binary")
             .groupBy("doc_id", "text_hash").agg(F.first("label").alias("label"), F.first("figures").alias("figures"))
             .collect())
    got = sorted((bytes(r.figures), r.label) for r in found)  # sums of floats depend on the order
    x = np.array([np.frombuffer(f) for f, _ in got]).reshape(-1, len(figures("")))
    return Logistic(x, np.array([y for _, y in got], float))


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z]+://([^/?#:]+)", 1)


def url_path(url: Column) -> Column:
    """The first part of a URL's path."""
    return F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]+/([^/?#]*)", 1)


def evidence(df: DataFrame, model: Logistic, host: Column, path: Column, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``df``: doc_id, host, path and p, the classifier's probability."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    own = df.select(F.col(id_col).alias("doc_id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"),
                    F.coalesce(path.cast("string"), F.lit("")).alias("path"), whole_text().alias("text"))

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([figures(t) for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "host", "path")), pa.array(shared.value.probability(x))],
            names=["doc_id", "host", "path", "p"])

    id_type = df.schema[id_col].dataType.simpleString()
    return map_batches(own, measure, f"doc_id {id_type}, host string, path string, p double")


def _strength(spread: float, mean: float) -> float:
    """Documents that a beta prior with this mean and variance is worth."""
    return float(np.clip(mean * (1 - mean) / max(spread, 1e-6) - 1, 2.0, 10_000.0))


def site_posteriors(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per row of ``scored`` (doc_id, host, path, p): doc_id, host, path, p, host_posterior,
    path_posterior, posterior, kept."""
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    # moments of the means of sites with two documents or more, in one row each
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s")).first()
    mean = min(1 - 1e-6, max(1e-6, total.s / total.n)) if total.n else 0.5
    off = (F.col("host_s") / F.col("host_n") - F.lit(mean)) ** 2
    host_spread = hosts.where("host_n > 1").agg(F.avg(off).alias("v")).first().v
    in_host = paths.join(hosts, "host")
    off = (F.col("s") / F.col("n") - F.col("host_s") / F.col("host_n")) ** 2
    path_spread = in_host.where("n > 1").agg(F.avg(off).alias("v")).first().v
    k_host = _strength(host_spread if host_spread is not None else 0.0, mean)
    k_path = _strength(path_spread if path_spread is not None else 0.0, mean)
    sites = in_host.select("host", "path", "n", "s", "host_n", "host_s")
    joined = salted_left_join(scored, sites, ["host", "path"], ["doc_id", "p"])
    host_post = (F.lit(k_host * mean) + F.col("host_s") - F.col("p")) / (F.lit(k_host) + F.col("host_n") - 1)
    path_post = ((F.lit(k_path) * F.col("host_posterior") + F.col("s") - F.col("p"))
                 / (F.lit(k_path) + F.col("n") - 1))
    odds = lambda c: F.log(c / (1 - c))
    inside = lambda c: F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-9), c))
    return (joined.withColumn("host_posterior", inside(host_post))
            .withColumn("path_posterior", inside(path_post))
            .withColumn("posterior", 1 / (1 + F.exp(-(odds(F.col("p")) + odds(F.col("path_posterior"))
                                                      - F.lit(float(np.log(mean / (1 - mean))))))))
            .withColumn("kept", F.col("posterior") >= threshold)
            .select("doc_id", "host", "path", "p", "host_posterior", "path_posterior", "posterior", "kept"))


def classify(df: DataFrame, labels: DataFrame, host: Column, path: Column, sample: int = SAMPLE) -> DataFrame:
    """Training, evidence and posteriors for ``df`` (doc_id, text and what host and path need)."""
    return site_posteriors(stored(evidence(df, train(df, labels, sample), host, path), "evidence"))
