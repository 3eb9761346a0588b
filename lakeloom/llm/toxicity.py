"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents and unlabelled ones train a linear classifier in
numpy.  Its risk is ``pi R_P(+) + max(0, R_U(-) - pi R_P(-))`` with the logistic
loss: where the unlabelled part, corrected for the class prior ``pi``, falls
below zero it is held there, and the step undoes the overfit instead.

Features are hashed words and word stems, punctuation removed and letters
folded; each is 0 or 1 and says that a text has the word at all, more than
once, thrice or more, or at some rate a word (``LEVELS``), so a few toxic words
count alike in texts of any length.  Only features whose share among the toxic
examples is far from that among the unlabelled ones are weighted (``screen``).  The class prior
is the largest that the features' shares in the two samples allow: only toxic labels are ever used.

Both samples are bounded and of labelled rows: ``max_positive`` toxic ones, and as
unlabelled text ``max_unlabelled`` rows whatever their label says, the least by a hash
of their id (equal hashes by id).  Everything else, texts and scores, covers all
documents, whole texts of any length.  Null and empty texts get the score of no features; without any
confirmed toxic example all scores are 0; repeated rows are scored alike; an
empty table gives an empty result; other columns, whatever their names, are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.kernel import LETTERS, SPACES, U, Alphabet, blocks, trimmed, word_stems
from lakeloom.plans.storage import materialize

BITS, STEMS = 20, (5, 6, 7)
#: Least occurrences and least occurrences in 256 words of each level of a feature.
LEVELS = ((1, 0), (2, 0), (3, 0), (1, 2), (1, 6), (2, 12))


def _folded() -> Alphabet:
    """Letters without ASCII punctuation; the accented Latin capitals' second bytes stand for the small ones'."""
    a = Alphabet(SPACES)
    a.sep, a.code = LETTERS.sep.copy(), LETTERS.code.copy()
    a.code[0x80:0x9F] = a.code[0xA0:0xBF]
    return a


FOLDED = _folded()


def features(column: pa.Array, wanted: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row of each feature, feature); ``wanted`` marks the buckets to look at."""
    for first, end, data, offsets in blocks(column):
        rows, found, n = [], [], None
        for h, row in word_stems(data, offsets, FOLDED, STEMS):
            if n is None:
                n = np.bincount(row, minlength=end - first)
            bucket = (h >> U(64 - BITS)).astype(np.int64)
            if wanted is not None:
                keep = wanted[bucket]
                row, bucket = row[keep], bucket[keep]
            rows.append(row), found.append(bucket)
        both, times = np.unique(np.concatenate(rows) << BITS | np.concatenate(found), return_counts=True)
        row, bucket = both >> BITS, both & ((1 << BITS) - 1)
        has = [(times >= c) & (256 * times >= r * n[row]) for c, r in LEVELS]
        yield first, end, np.concatenate([row[x] for x in has]), np.concatenate([bucket[x] * len(LEVELS) + j for j, x in enumerate(has)])


def _rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse counts of documents by class and feature."""
    counts = np.zeros((2, len(LEVELS) << BITS), np.int32)
    for batch in batches:
        toxic = np.array(batch.column(0).to_pylist(), np.int64)
        for first, _, row, f in features(batch.column(1)):
            np.add.at(counts, (toxic[first + row], f), 1)
    for c in (0, 1):
        used = np.flatnonzero(counts[c])
        yield pa.RecordBatch.from_arrays([pa.array([c] * len(used), pa.int32()), pa.array(used), pa.array(counts[c][used].astype(np.int64))], ["toxic", "feature", "n"])


def _rows_of(chosen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.sort(chosen.value)
        wanted = np.zeros(1 << BITS, bool)
        wanted[known // len(LEVELS)] = True
        for batch in batches:
            toxic = batch.column(0)
            for first, end, row, f in features(batch.column(1), wanted):
                at = np.searchsorted(known, f)
                keep = known[np.minimum(at, len(known) - 1)] == f
                row, at = row[keep], at[keep]
                order = np.argsort(row, kind="stable")
                cut = np.searchsorted(row[order], np.arange(end - first + 1))
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(at[order].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([toxic.slice(first, end - first), lists], ["toxic", "features"])

    return run


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], n_features: int, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights, the last the intercept, that minimise the non-negative risk by Adam on all examples at once."""
    w = np.zeros(n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    flat = [(np.concatenate(x) if x else np.zeros(0, int), np.repeat(np.arange(len(x)), [len(r) for r in x]), len(x)) for x in (positive, unlabelled)]

    def score(x):
        at, row, n = x
        return np.bincount(row, w[at], minlength=n) + w[-1]

    def grad(x, g):
        at, row, _ = x
        return np.append(np.bincount(at, g[row], minlength=n_features), g.sum())

    soft = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    for t in range(1, steps + 1):
        p, u = soft(score(flat[0])), soft(score(flat[1]))
        n_p, n_u = max(1, flat[0][2]), max(1, flat[1][2])
        negative = -np.log1p(-np.clip(u, 0, 1 - 1e-12)).sum() / n_u + prior * np.log1p(-np.clip(p, 0, 1 - 1e-12)).sum() / n_p
        g_neg = grad(flat[1], u / n_u) - prior * grad(flat[0], p / n_p)
        g = grad(flat[0], prior * (p - 1) / n_p) + g_neg if negative >= 0 else -g_neg
        g = g + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, intercept = model.value
        wanted = np.zeros(1 << BITS, bool)
        wanted[known // len(LEVELS)] = True
        for batch in batches:
            out = np.full(batch.num_rows, intercept)
            for first, end, row, f in features(batch.column(batch.num_columns - 1), wanted):
                if len(known):
                    at = np.minimum(np.searchsorted(known, f), len(known) - 1)
                    out[first:end] += np.bincount(row, np.where(known[at] == f, weights[at], 0.0), minlength=end - first)
            score = 1 / (1 + np.exp(-np.clip(out, -50, 50)))
            columns = [*batch.columns[:-1], pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "score"])

    return run


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, max_positive: int = 4000, max_unlabelled: int = 12_000, max_features: int = 8192, screen: float = 5.0, keep: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, held_out, the columns ``keep`` and score of every document; labels of the held-out fold are never read.

    ``max_positive`` and ``max_unlabelled``: rows of the labels that train the classifier; ``max_features``: weights of the
    classifier, those with the largest deviation between the two samples, of the features that deviate by ``screen`` or more.
    """
    spark = docs.sparkSession
    fold = lambda c: F.coalesce(F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))
    kept = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), *kept, F.col(text_col).cast("string").alias("text"))
    known = labels.where("doc_id is not null and toxic is not null").where(~fold("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = docs.where("doc_id is not null").where(~fold("doc_id")).select("doc_id")
    positive = known.where("toxic = 1").select("doc_id").join(ids.distinct(), "doc_id", "left_semi").orderBy(*order).limit(max_positive)
    some = known.select("doc_id").join(ids.distinct(), "doc_id", "left_semi").orderBy(*order).limit(max_unlabelled)  # their labels are not used
    wanted = positive.select("doc_id", F.lit(1).alias("toxic")).unionByName(some.select("doc_id", F.lit(0).alias("toxic")))
    # At most max_positive + max_unlabelled ids of 12 bytes: bounded by the parameters.
    sample = materialize(docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").select("toxic", "text").repartition(8), "toxic-sample")
    rates = sample.mapInArrow(trimmed(_rates), "toxic int, feature long, n long").groupBy("feature").agg(*[F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)])
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_p, n_u = size.get(1, 0), size.get(0, 0)
    known, weights, intercept = np.zeros(0, np.int64), np.zeros(0), -50.0
    if n_p and n_u:
        all_rate = (F.col("n1") + F.col("n0")) / F.lit(n_p + n_u)
        z = (F.col("n1") / n_p - F.col("n0") / n_u) / F.sqrt(all_rate * (1 - all_rate) * F.lit(1 / n_p + 1 / n_u) + 1e-12)
        chosen = rates.where(F.abs(z) > screen).orderBy(F.desc(F.abs(z)), "feature").limit(max_features).select("feature").collect()
        known = np.sort(np.array([r["feature"] for r in chosen], np.int64))
        rows = sample.mapInArrow(trimmed(_rows_of(spark.sparkContext.broadcast(known))), "toxic int, features array<int>").collect() if len(known) else []
        part = lambda c: [np.array(r["features"], np.int64) for r in rows if r["toxic"] == c]
        # Unlabelled text is a mixture that holds the toxic one with weight pi, so no feature's share there is below pi
        # times its share among the toxic examples.  The least such bound is the prior: no confirmed negative is needed.
        least = rates.where(F.col("n1") >= max(10, n_p // 20)).agg(F.min((F.col("n0") + F.sqrt("n0")) / n_u / (F.col("n1") / n_p))).first()[0]
        w = fit_nnpu(part(1), part(0), len(known), min(max(least or n_p / (n_p + n_u), 1e-4), 0.5))
        weights, intercept = w[:-1], float(w[-1])
    model = spark.sparkContext.broadcast((known, weights, intercept))
    ready = docs.select("doc_id", fold("doc_id").alias("held_out"), *[f"kept_{i}" for i in range(len(keep))], "text")
    scored = ready.mapInArrow(trimmed(_score(model)), ready.drop("text").withColumn("score", F.lit(0.0)).schema)
    return scored.select("doc_id", "held_out", *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)], "score")
