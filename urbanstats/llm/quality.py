"""Quality classifier learned from trusted positives and unlabelled text.

The model is a logistic one over text statistics. Its loss is the non-negative
unbiased risk of positive-unlabelled learning (Kiryo and others, 2017): with prior
``p`` of the good class, the risk of calling a text bad is estimated from unlabelled
text less ``p`` times that on the positives, and kept from falling below zero.

The unlabelled part of risk and gradient is summed over all documents, in one pass over
their stored statistics per round. Between rounds a bounded sample stands in for them,
corrected by a linear term so that risk and gradient equal the whole's where the round began.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from urbanstats.llm.common import stored, text_table

# Positives that the model is fitted on, and unlabelled rows that stand in for all between
# two rounds, at most. The rows with the smallest hashes are taken, so the same rows come
# out at every partitioning.
FIT_ROWS = 8000
# Passes over all documents, and steps after each.
ROUNDS, STEPS = 5, 80
# Sums over all documents are made of multiples of this, so that they are exact.
GRAIN = 2.0**-32

# Characters that have a class of their own in the statistics.
MARKS = "!?.,;:'\"|*#$%&-_/\\()[]{}<>=+@~^`"

_CLASSES = 8 + len(MARKS)
FEATURES = 2 * _CLASSES + 36 + 7


def _class_table():
    table = np.full(256, 1, np.uint8)  # other control characters
    table[ord("a") : ord("z") + 1] = 2
    table[ord("A") : ord("Z") + 1] = 3
    table[ord("0") : ord("9") + 1] = 4
    table[[9, 11, 12, 13, 32]] = 5
    table[10] = 6
    table[128:] = 7
    for i, mark in enumerate(MARKS):
        table[ord(mark)] = 8 + i
    return table


_TABLE = _class_table()
# Coarse classes for pairs: letters of either case, digits, space, marks, the rest.
_COARSE = np.array([0, 0, 1, 2, 3, 4, 4, 1] + [5] * len(MARKS), np.int64)


def text_features(text):
    """Statistics of a whole text, all between 0 and about 2; any text has them."""
    out = np.zeros(FEATURES, np.float32)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if not len(raw):
        return out
    kinds = _TABLE[raw]
    share = np.bincount(kinds, minlength=_CLASSES) / len(raw)
    out[:_CLASSES] = np.sqrt(share)
    out[_CLASSES : 2 * _CLASSES] = share > 0.01
    coarse = _COARSE[kinds]
    pairs = np.bincount(coarse[:-1] * 6 + coarse[1:], minlength=36) / len(raw)
    at = 2 * _CLASSES
    out[at : at + 36] = np.sqrt(pairs)
    words = text.split()
    lines = text.split("\n")
    n = max(1, len(words))
    same = sum(map(str.__eq__, words, words[1:]))
    out[at + 36 :] = (
        len(set(words)) / n,
        np.sqrt(same / n),
        np.log1p(n) / 12,
        min(2.0, len(raw) / n / 16),
        len(set(lines)) / len(lines),
        np.sqrt(min(1.0, len(lines) / n)),
        1.0,
    )
    return out


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _loss_of_bad(z):
    sure = _logistic(z)
    # Log loss: -log s for good, -log(1 - s) for bad.
    return -np.log1p(-np.minimum(sure, 1 - 1e-12)), sure


def unlabelled_terms(x, w, bias):
    """Of each row of ``x``: the loss of calling it bad, its gradient, and that of the bias."""
    loss, sure = _loss_of_bad(x @ w + bias)
    return np.column_stack((loss, sure[:, None] * x, sure))


def unlabelled_sums(x, w, bias):
    """The sums of ``unlabelled_terms`` over all rows."""
    loss, sure = _loss_of_bad(x @ w + bias)
    return np.concatenate(([loss.sum()], sure @ x, [sure.sum()]))


def fit_pu(positive, sample, prior, whole=None, scale=None, rounds=ROUNDS, steps=STEPS, rate=0.05, decay=1e-4):
    """Weights that minimise the non-negative risk, by Adam on full batches.

    ``whole`` gives for weights and a bias the mean over all unlabelled rows of what
    ``unlabelled_terms`` gives; ``scale`` is their centre and spread. Without these the
    sample is the whole. Where the estimated risk on the bad class is negative, the step
    goes the other way on that part alone, as the method says.
    """
    centre, spread = scale or (sample.mean(0), sample.std(0) + 0.02)
    p, u = (positive - centre) / spread, (sample - centre) / spread
    n = p.shape[1]

    def of_whole(w, bias):
        if whole is None:
            return unlabelled_sums(u, w, bias) / len(u)
        plain = w / spread
        found = whole(plain, bias - float(centre @ plain))
        found[1:-1] = (found[1:-1] - centre * found[-1]) / spread
        return found

    at = np.zeros(n + 1)  # weights, then the bias
    at[n] = np.log(prior / (1 - prior))
    m, v, t = np.zeros(n + 1), np.zeros(n + 1), 0
    for _ in range(rounds):
        start = at.copy()
        lack = of_whole(at[:n], at[n]) - unlabelled_sums(u, at[:n], at[n]) / len(u)
        for _ in range(steps):
            t += 1
            sums = unlabelled_sums(u, at[:n], at[n]) / len(u) + lack
            sums[0] += lack[1:] @ (at - start)
            good = unlabelled_sums(p, at[:n], at[n]) / len(p)
            bad = sums - prior * good
            grad = bad[1:].copy()
            if bad[0] >= 0:
                grad -= prior * (np.append(p.mean(0), 1.0) - good[1:])
            else:
                grad = -grad
            grad[:n] += decay * at[:n]
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            at = at - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    w = at[:n] / spread
    return w, float(at[n] - centre @ w)


def held_out(doc_id):
    """Whether a document is kept out of the fit: crc32 of its id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _smallest(rows, limit):
    """At most ``limit`` rows: those with the smallest hashes.

    In a large table most rows are left out by their hash before they are put in order,
    as each task would else send ``limit`` of them to one.
    """
    n, names = rows.count(), rows.columns
    ranked = rows.withColumn("_hash", F.xxhash64(*names))
    if n > 4 * limit:
        ranked = ranked.filter(F.col("_hash") < (1 << 65) * limit // n - (1 << 63))
    return ranked.orderBy("_hash", *names).limit(limit).select(*names)


def _matrix(rows):
    values = rows.toPandas()["f"]
    return np.array(values.tolist(), np.float64).reshape(len(values), FEATURES)


def feature_table(texts):
    """The statistics of every text, stored: doc_id, f."""

    @F.pandas_udf("array<float>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([text_features(t) for t in texts])

    return stored(texts.select("doc_id", features("text").alias("f")), "quality_features")


def sums_of(table, terms):
    """The sums over all rows of ``table`` of the columns that ``terms`` gives for a matrix of them.

    Each value is rounded to whole grains and counted as a whole number, so a sum does not
    depend on order or partitions. A batch sends one array.
    """

    def add(batches):
        for batch in batches:
            if len(batch):
                grains = np.rint(terms(np.stack(batch["f"]).astype(np.float64)) / GRAIN)
                yield pd.DataFrame({"sums": [grains.sum(0).astype(np.int64)]})

    parts = table.select("f").mapInPandas(add, "sums array<bigint>").select(F.posexplode("sums"))
    found = parts.groupBy("pos").agg(F.sum(F.col("col").cast("decimal(28,0)")).alias("total"))
    return np.array([float(r["total"]) * GRAIN for r in found.orderBy("pos").collect()])


class QualityModel:
    """A fitted model: weights, bias, and the prior it was fitted with."""

    def __init__(self, weights, bias, prior):
        self.weights, self.bias, self.prior = weights, bias, prior

    def score(self, text):
        """Column: how likely a text is good, 0 to 1; a NULL text counts as empty."""
        weights, bias = self.weights, self.bias

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                z = [float(text_features(t or "") @ weights) + bias for t in texts]
                yield pd.Series(_logistic(np.array(z, float)))

        return score(text)


def fit_quality(docs, labels, prior=None, fit_rows=FIT_ROWS):
    """Fit on documents that are not held out; see the module's text for the method.

    Trusted positives are documents whose every label row has quality 1. The unlabelled
    text is any document, labelled or not. ``prior`` is the share of good documents; by
    default it is estimated as the share of positives among all labelled documents that
    are not held out, kept within 0.05 and 0.95. At most ``fit_rows`` positives are used;
    the prior counts all labels, and centre, spread and unlabelled risk take in all
    documents. Of several rows with one id each counts as unlabelled text, and the one
    with the smallest statistics as a positive.

    NULL labels and ids take no part. Without a positive or any text nothing can be
    learned: the model then gives every text the prior (0.5 if that is unknown).
    """
    texts = text_table(docs).filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    if prior is None:
        prior = marks.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
        prior = 0.5 if prior is None else prior
    prior = min(0.95, max(0.05, prior))
    table = feature_table(texts)
    good = marks.filter(F.col("quality") == 1).select("doc_id").join(table.select("doc_id"), "doc_id", "left_semi")
    trusted = table.join(F.broadcast(_smallest(good, fit_rows)), "doc_id", "left_semi")
    positive = _matrix(trusted.groupBy("doc_id").agg(F.min("f").alias("f")).orderBy("doc_id"))
    n = table.count()
    if not len(positive) or not n:
        return QualityModel(np.zeros(FEATURES), float(np.log(prior / (1 - prior))), prior)
    mean, square = np.split(sums_of(table, lambda x: np.column_stack((x, x * x))) / n, 2)
    scale = mean, np.sqrt(np.maximum(square - mean * mean, 0)) + 0.02

    def whole(w, bias):
        return sums_of(table, lambda x: unlabelled_terms(x, w, bias)) / n

    sample = _matrix(_smallest(table, fit_rows).select("f"))
    weights, bias = fit_pu(positive, sample, prior, whole, scale)
    return QualityModel(weights, bias, prior)


def score_quality(docs, model, threshold=0.7):
    """One row per document: doc_id, held_out, score, predicted.

    Every row gets a score, also one with a NULL id, a NULL or an empty text, and each
    of several rows with the same id. Other columns are ignored. Texts of any length are
    read whole. An empty table gives an empty result.
    """
    texts = text_table(docs)
    return texts.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs, model, threshold=0.7):
    """The rows of ``docs`` that the model scores at ``threshold`` or more; same columns.

    Each row is judged by its text alone: rows that repeat an id or a whole row too, and
    those with a NULL id. NULL and empty texts are scored as empty. Texts of any length are
    read whole. An empty table gives an empty one.
    """
    return docs.filter(model.score(F.col("text")) >= threshold)
