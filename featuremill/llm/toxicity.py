"""Toxicity (operator 8): non-negative positive-unlabelled learning.

Confirmed toxic examples (P) and unlabelled text (U, a mix of both kinds) train a logistic
model in numpy by the non-negative risk estimator: with the class prior p,
``p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)])``; when the part in the maximum falls
below zero, the step undoes it, so the model cannot drive the risk of the negatives below
what they can have. The prior is the share of toxic rows among the labelled training rows.

The candidates for features are what the toxic examples hold more often than the unlabelled ones
of the samples; how often each occurs is counted over all documents by a Spark aggregate, and those clearly more frequent among the toxic
examples are kept. The gradient steps read two bounded samples of the labelled training rows
(about ``positives`` toxic ones, and about ``unlabelled`` ones of both kinds whose labels the
risk does not see, so the prior is theirs), drawn by a hash of id and text and bounded in rows.
The sparsity is chosen by folds inside these rows. The model scores every whole text. Labels of
held-out rows (crc32 of the id as text, modulo 4, is 2) are never read, in no choice. Features
are words, beginnings of words, and beginnings that several different words of the text share;
language, source and id are not features.

Defined results: a null text counts as empty and gets the model's bias as score; a null id
is not held out and has no label; an id with several labels is toxic if one of them says
so; without any toxic training label every score is 0; repeated rows each give their own
row; an empty table gives an empty result; further columns are ignored (``keep_clean``
returns them unchanged). Memory: one Arrow batch and a bounded memo table per task; on the
driver the samples' feature hashes and the candidates' counts.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.llm.common import id_and_text, map_batches, whole_text
from featuremill.llm.features import KnownFeatures, LinearScorer, SparseRows, text_features
from featuremill.llm.samples import drawn, hashed_rows, labelled_rows, texts_of

POSITIVES, UNLABELLED = 3000, 6000
THRESHOLD = 0.3
STEPS = 600
#: Features that may get a weight.
FEATURES = 4000
#: How strongly weights may be held at zero; the folds and the steps by which one is chosen.
SPARSITIES = (0.05, 0.02, 0.01)
FOLDS, FOLD_STEPS = 3, 200


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row's label is kept for testing (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def candidate_features(positive: list[np.ndarray], mixed: list[np.ndarray] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features that two or more toxic texts have, and a larger share of them than of the
    unlabelled sample; and how many toxic texts have each."""
    hashes, n = np.unique(np.concatenate([*positive, np.empty(0, np.uint32)]), return_counts=True)
    other, m = np.unique(np.concatenate([*mixed, np.empty(0, np.uint32)]), return_counts=True)
    share = np.zeros(len(hashes))
    _, at, of = np.intersect1d(hashes, other, assume_unique=True, return_indices=True)
    share[at] = m[of] / max(1, len(mixed))
    kept = (n > 1) & (n / max(1, len(positive)) > share)
    return hashes[kept], n[kept]


def corpus_counts(df: DataFrame, hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many rows of ``df`` (text) each of the features occurs, and the number of rows."""
    shared = _shared(df, KnownFeatures(hashes))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [h for t in batch.column("text").to_pylist() for h in shared.value.found(t)]
        own, n = np.unique(np.array(found, np.int64), return_counts=True)
        # the row without a feature holds the number of rows
        return pa.RecordBatch.from_arrays(
            [pa.array([None, *own.tolist()], pa.int64()), pa.array([batch.num_rows, *n.tolist()], pa.int64())],
            names=["feature", "n"])

    got = (map_batches(df.select(whole_text().alias("text")), count, "feature long, n long")
           .groupBy("feature").agg(F.sum("n").alias("n")).toArrow())
    n = dict(zip(*(c.to_pylist() for c in got.columns)))
    return np.array([n.get(h, 0) for h in hashes.tolist()], float), n.get(None, 0)


def select_features(hashes: np.ndarray, toxic: np.ndarray, n_toxic: int, in_all: np.ndarray, n_all: int,
                    most: int = FEATURES, least_z: float = 3.0) -> np.ndarray:
    """Hashes of the features that occur significantly more often in toxic texts than in all
    (two-proportion z value), the ``most`` clearest of them."""
    n, m = n_toxic, max(1, n_all)
    pooled = (toxic + in_all) / (n + m)
    z = (toxic / n - in_all / m) / np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / n + 1 / m))
    kept = np.flatnonzero(z >= least_z)
    kept = kept[np.argsort(-z[kept], kind="stable")[:most]]
    return np.sort(hashes[kept])


def pu_risk(x: np.ndarray, p: SparseRows, u: SparseRows, prior: float) -> tuple[float, float]:
    """The two parts of the risk of weights and bias ``x``: the positives' and, before it is held
    at zero, the negatives'. l(f) = softplus(-f) for "toxic", l(-f) = softplus(f) for "not toxic"."""
    softplus = lambda f: np.logaddexp(0, f)
    fp, fu = p.times(x[:-1]) + x[-1], u.times(x[:-1]) + x[-1]
    return (prior * softplus(-fp).mean(),
            (softplus(fu).mean() if u.n else 0.0) - prior * softplus(fp).mean())


def pu_gradient(x: np.ndarray, p: SparseRows, u: SparseRows, prior: float) -> np.ndarray:
    """The direction of a step up: of the risk, or, where the negatives' part is below zero, away
    from it."""
    sigmoid = lambda f: 1 / (1 + np.exp(-np.clip(f, -40, 40)))

    def gradient(rows: SparseRows, slope: np.ndarray) -> np.ndarray:
        slope = slope / max(1, rows.n)
        return np.append(rows.back(slope), slope.sum())

    fp, fu = p.times(x[:-1]) + x[-1], u.times(x[:-1]) + x[-1]
    of_negative = gradient(u, sigmoid(fu)) - prior * gradient(p, sigmoid(fp))
    if pu_risk(x, p, u, prior)[1] < 0:
        return -of_negative
    return prior * gradient(p, -sigmoid(-fp)) + of_negative


def fit_non_negative_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
                        vocabulary: np.ndarray, steps: int = STEPS, sparsity: float = SPARSITIES[-1]) -> LinearScorer:
    """A scorer from the feature hashes of positive and of unlabelled texts, by accelerated
    proximal gradient steps on the non-negative risk with an absolute-value penalty."""
    if not positive:
        return LinearScorer(np.empty(0, np.uint32), np.empty(0), -50.0)
    p, u = SparseRows(positive, vocabulary), SparseRows(unlabelled, vocabulary)

    def times(rows: SparseRows, v: np.ndarray) -> np.ndarray:
        f = (rows.times(v[:-1]) + v[-1]) / max(1, rows.n)
        return np.append(rows.back(f), f.sum())

    v = np.ones(len(vocabulary) + 1)  # the largest curvature, for the step width
    for _ in range(20):
        v /= np.linalg.norm(v)
        curve = (prior * times(p, v) + times(u, v)) / 4
        v, top = curve, np.linalg.norm(curve)
    width = 1 / max(top, 1e-9)
    x = np.append(np.zeros(len(vocabulary)), np.log(prior / (1 - prior)))
    y, t = x, 1.0
    shrink = width * sparsity * prior / np.sqrt(len(positive))
    for _ in range(steps):
        new = y - width * pu_gradient(y, p, u, prior)
        new[:-1] = np.maximum(0, new[:-1] - shrink)  # selected features only ever speak for "toxic"
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    kept = x[:-1] > 1e-3
    return LinearScorer(vocabulary[kept], x[:-1][kept], float(x[-1]))


def choose_sparsity(rows: list[tuple[np.ndarray, bool, bool, bool]], prior: float, vocabulary: np.ndarray) -> float:
    """The sparsity with the smallest logistic loss on rows that the fit did not see, by folds of the
    sample's rows (hashes, toxic, positive, unlabelled); equal feature sets share a fold."""
    fold = [crc32(r[0].tobytes()) % FOLDS for r in rows]
    loss = dict.fromkeys(SPARSITIES, 0.0)
    for k in range(FOLDS):
        inside = [r for r, f in zip(rows, fold) if f != k]
        outside = [r for r, f in zip(rows, fold) if f == k and r[3]]
        held, toxic = SparseRows([r[0] for r in outside], vocabulary), np.array([r[1] for r in outside], bool)
        for sparsity in SPARSITIES:
            own = fit_non_negative_pu([r[0] for r in inside if r[2]], [r[0] for r in inside if r[3]], prior, vocabulary,
                                      FOLD_STEPS, sparsity)
            f = held.times(np.array([own.weight.get(h, 0.0) for h in vocabulary.tolist()])) + own.bias
            loss[sparsity] += float(np.logaddexp(0, np.where(toxic, -f, f)).sum())
    return min(SPARSITIES, key=loss.__getitem__)


def training_rows(df: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED):
    """(rows, prior): the samples as (feature hashes, toxic, positive, unlabelled), in an order that
    does not depend on the tasks that made them (sums of floats, and so the model, would), and the
    toxic share of the labelled training rows."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("label")))
    rows = hashed_rows(df)
    told = labelled_rows(rows, known).withColumn("toxic", F.col("label") > 0)
    count = told.agg(F.count(F.lit(1)).alias("n"), F.count_if("toxic").alias("toxic")).first()
    if not count.toxic:
        return [], 0.0
    sample = (told.select("doc_id", "text_hash", "toxic",
                          (F.col("toxic") & drawn(count.toxic, positives, "positive")).alias("positive"),
                          drawn(count.n, unlabelled, "unlabelled").alias("unlabelled"))
              .where("positive or unlabelled"))

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes = pa.array([text_features(t).tobytes() for t in batch.column("text").to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in flags), hashes], names=[*flags, "hashes"])

    flags = ["doc_id", "text_hash", "toxic", "positive", "unlabelled"]
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = (map_batches(texts_of(rows, sample, 2 * (positives + unlabelled)).select(*flags, "text"), scan,
                         f"doc_id {id_type}, text_hash long, toxic boolean, positive boolean, unlabelled boolean, "
                         "hashes binary")
             .groupBy("doc_id", "text_hash").agg(*[F.first(c).alias(c) for c in (*flags[2:], "hashes")]).collect())
    got = sorted((bytes(r.hashes), r.toxic, r.positive, r.unlabelled) for r in found)
    return ([(np.frombuffer(h, np.uint32), *told) for h, *told in got],
            min(0.9, max(1e-4, count.toxic / count.n)))


def train(df: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          steps: int = STEPS) -> LinearScorer:
    """The scorer learned from the texts of ``df`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    rows, prior = training_rows(df, labels, positives, unlabelled)
    positive, mixed = [r[0] for r in rows if r[2]], [r[0] for r in rows if r[3]]
    if not positive:
        return fit_non_negative_pu([], [], 0.5, np.empty(0, np.uint32))
    hashes, toxic = candidate_features(positive, mixed)
    in_all, n_all = corpus_counts(df, hashes)
    vocabulary = select_features(hashes, toxic, len(positive), in_all, n_all)
    sparsity = choose_sparsity(rows, prior, vocabulary)
    return fit_non_negative_pu(positive, mixed, prior, vocabulary, steps, sparsity)


def _shared(df: DataFrame, scorer: LinearScorer):
    return df.sparkSession.sparkContext.broadcast(scorer)


def score_documents(df: DataFrame, scorer: LinearScorer, threshold: float = THRESHOLD,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id, score and predicted (1 if the score reaches the threshold)."""
    shared = _shared(df, scorer)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = np.array([shared.value.score(t) for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
            names=["doc_id", "score", "predicted"])

    id_type = df.schema[id_col].dataType.simpleString()
    return map_batches(id_and_text(df, id_col, text_col), scan, f"doc_id {id_type}, score double, predicted int")


def keep_clean(df: DataFrame, scorer: LinearScorer, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` below the threshold, with all their columns."""
    shared = _shared(df, scorer)
    at = df.columns.index(text_col)

    def passing(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([shared.value.score(t or "") < threshold for t in batch.column(at).to_pylist()]))

    return map_batches(df, passing, df.schema)
