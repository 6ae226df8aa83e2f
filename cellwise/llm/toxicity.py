"""Toxicity: cumulative-link ordinal regression over sparse text features.

Grades are the sorted distinct labels, 0 the mildest. P(grade <= k) = sigmoid(threshold_k - w.x):
one weight per feature, shared by all thresholds. Features are the presence of words that tell
the grades apart in a bounded training sample. The output is the expected severity, the sum over
thresholds of P(grade > k), which lies between 0 and the number of grades less one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"[^\W\d_]+")
# Rows of each grade, and bytes of all of them, that the fit reads at most, in expectation.
ROWS_PER_GRADE = 8_000
TRAINING_BYTES = 64 << 20
FEATURES = 4_096
# A feature is in at least so many training texts, and this sure to differ between grades.
LEAST_TEXTS = 3
LEAST_GAIN = 8.5
PENALTY = 0.01
REJECT_AT = 0.5


def words_in(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


class Model:
    """Weights of words, ascending thresholds, and the grades they lie between."""

    def __init__(self, weights: dict[str, float], thresholds: np.ndarray, grades: list[int]) -> None:
        self.weights, self.thresholds, self.grades = weights, thresholds, grades

    def severity(self, text: str | None) -> float:
        weights = self.weights
        # Summed in sorted order, so that equal sets give equal sums.
        total = sum(sorted(weights[w] for w in words_in(text).intersection(weights)))
        return float(sum(1 / (1 + np.exp(np.clip(self.thresholds - total, -30, 30)))))


def train(
    rows: list[list[int]],
    grades: np.ndarray,
    n_features: int,
    n_grades: int,
    shares: np.ndarray,
    rounds: int = 400,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient descent with momentum on the penalised likelihood.

    ``shares`` are the grades' shares in the population; rows are weighted to match them.
    """
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids = np.array([f for r in rows for f in r], np.int64)
    seen = np.bincount(grades, minlength=n_grades)
    row_weight = (shares / np.maximum(1, seen))[grades]
    upto = np.cumsum(shares)[:-1].clip(1e-6, 1 - 1e-6)
    thresholds = np.log(upto / (1 - upto))
    weights = np.zeros(n_features)
    v_w, v_t = np.zeros_like(weights), np.zeros_like(thresholds)
    padded_at = np.arange(len(rows))
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    # Features differ in how many rows have them: each steps by its own curvature.
    curvature = np.bincount(ids, row_weight[of], n_features) * 0.25 + PENALTY * row_weight.max()
    for _ in range(rounds):
        total = np.bincount(of, weights[ids], len(rows))
        inner = sigmoid(thresholds[None, :] - total[:, None])
        below = np.pad(inner, ((0, 0), (1, 1)), constant_values=((0, 0), (0, 1)))
        high, low = below[padded_at, grades + 1], below[padded_at, grades]
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high), low * (1 - low)
        g_total = row_weight * (d_high - d_low) / p
        g_w = np.bincount(ids, g_total[of], n_features) + PENALTY * row_weight.max() * weights
        g_t = np.zeros(n_grades + 1)
        np.add.at(g_t, grades + 1, -row_weight * d_high / p)
        np.add.at(g_t, grades, row_weight * d_low / p)
        v_w = 0.8 * v_w - 0.1 * g_w / curvature
        v_t = 0.8 * v_t - 0.2 * g_t[1:-1]
        weights += v_w
        thresholds = np.sort(thresholds + v_t)
    return weights, thresholds


def fit(
    docs: DataFrame,
    labels: DataFrame,
    grade: str = "toxic",
    sample_key: Column | None = None,
    rows_per_grade: int = ROWS_PER_GRADE,
    training_bytes: int = TRAINING_BYTES,
) -> Model:
    """Fit on a bounded sample of the labelled ``docs``.

    A document with several grades has the highest. Null ids and grades teach nothing. With fewer
    than two grades in the sample nothing is told apart and every text has severity 0.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(grade).isNotNull()).groupBy("doc_id").agg(F.max(grade).alias("grade"))
    sizes = {r.grade: r.n for r in known.groupBy("grade").agg(F.count("*").alias("n")).collect()}  # one row per grade
    grades = sorted(sizes)
    nothing = Model({}, np.zeros(0), grades)
    if len(grades) < 2:
        return nothing
    part = F.lit(0.0)
    for value, n in sizes.items():
        part = F.when(F.col("grade") == value, F.lit(min(1.0, rows_per_grade / n))).otherwise(part)
    key = F.xxhash64("doc_id") if sample_key is None else sample_key
    chosen = known.filter(F.pmod(key, F.lit(1 << 20)) < part * (1 << 20))
    # Some grades * rows_per_grade ids: broadcast, so that the texts are filtered as they are read.
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    size = sample.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fair = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(min(1.0, training_bytes / max(1, size)) * (1 << 20))
    found = F.pandas_udf(lambda texts: texts.map(lambda t: sorted(words_in(t))), T.ArrayType(T.StringType()))
    worded = sample.filter(fair).select("doc_id", F.xxhash64("text").alias("row"), "grade", found("text").alias("words")).persist()
    counts = {r.grade: r.n for r in worded.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        worded.unpersist()
        return nothing
    # Gain of a word: the log likelihood its grades gain over the grades of all texts.
    in_grade = [F.sum((F.col("grade") == g).cast("double")) for g in sorted(counts)]
    by_word = worded.select("grade", F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("n"), F.array(*in_grade).alias("by")
    ).filter(F.col("n") >= LEAST_TEXTS)
    rows_in_all = sum(counts.values())
    gain = F.lit(0.0)
    for i, g in enumerate(sorted(counts)):
        due = F.col("n") * (counts[g] / rows_in_all)
        gain = gain + F.get("by", i) * F.ln((F.get("by", i) + 1e-9) / due)
    best = by_word.withColumn("gain", gain).filter(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "word").limit(FEATURES)
    vocabulary = sorted(r.word for r in best.select("word").collect())
    number = {w: i for i, w in enumerate(vocabulary)}
    chosen_words = F.array(*[F.lit(w) for w in vocabulary]) if vocabulary else F.expr("array()").cast("array<string>")
    sparse = worded.select("doc_id", "row", "grade", F.array_intersect("words", chosen_words).alias("words")).collect()
    worded.unpersist()
    sparse.sort(key=lambda r: (r.doc_id, r.row, r.grade))
    kinds = sorted(counts)
    rows = [sorted(number[w] for w in r.words) for r in sparse]
    y = np.array([kinds.index(r.grade) for r in sparse])
    shares = np.array([sizes[g] for g in kinds], float)
    weights, thresholds = train(rows, y, len(vocabulary), len(kinds), shares / shares.sum())
    return Model({w: float(weights[i]) for w, i in number.items()}, thresholds, kinds)


def severities(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    reject_at: float = REJECT_AT,
) -> DataFrame:
    """``keep`` columns, ``severity``, ``grade`` (nearest) and ``toxic`` for every row of ``docs``.

    Null, empty and wordless texts have no feature: their severity is that of the thresholds
    alone, and they are never toxic. Repeated rows are judged alike; texts are read whole.
    """
    score = _score(docs, model)(F.col(text))
    out = docs.select(*keep, score.alias("severity"), _worded(text).alias("_worded"))
    return out.select(
        *keep,
        "severity",
        F.round("severity").cast("int").alias("grade"),
        ((F.col("severity") >= reject_at) & F.col("_worded")).alias("toxic"),
    )


def _worded(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).rlike(r"\p{L}")


def _score(docs: DataFrame, model: Model):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shared.value.severity(t) for t in batch.tolist()], dtype="float64")

    return F.pandas_udf(judged, "double")


def without_toxic(docs: DataFrame, model: Model, reject_at: float = REJECT_AT) -> DataFrame:
    """``docs`` without the documents that ``severities`` calls toxic; all columns stay."""
    return docs.filter(~_worded("text") | (_score(docs, model)(F.col("text")) < reject_at))
