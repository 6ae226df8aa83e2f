"""Quality classifier: supervised subword embeddings, trained by numpy stochastic gradient descent.

A text is the mean of learned vectors of its words, of their character n-grams and of a mark for
words that repeat the one before, all hashed into one table; a softmax over the two labels sits on it. Fitting reads a bounded sample. Once
fitted, a bucket's vector matters only through the difference of the two labels' outputs, so
scoring a text is a mean of one number per bucket, taken inside the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.llm.text import boundary_array, chunked, ngram_buckets, word_starts

BUCKETS = 1 << 16
DIMENSIONS = 8
ORDERS = (1, 3, 4, 5)
# The bucket of a repeated word, and how many times it counts beside the word's own n-grams.
REPEATED = 0
REPEAT_WEIGHT = 4
# Rows of each label and bytes of all of them that the fit reads at most, in expectation.
ROWS_PER_LABEL = 1_500
TRAINING_BYTES = 24 << 20
EPOCHS = 12
BATCH = 32
RATE = 0.5
THRESHOLD = 0.3

_SPACE = np.ones(0x110000, bool)
for _c in (0, *range(0x09, 0x0E), 0x20, 0x85, 0xA0):
    _SPACE[_c] = False


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, number of the text) of all words and n-grams, in parts."""
    array, text_of = boundary_array(texts, _SPACE)
    starts = word_starts(array)
    if not len(starts):
        return
    place = np.repeat(text_of, np.diff(np.append(starts, len(array) - 1)))
    for buckets, valid in ngram_buckets(array, ORDERS, BUCKETS):
        at = np.flatnonzero(valid[: len(place)])
        yield buckets[at], place[at]
    # Whole words: a sum over their letters, each multiplied by its place in the word.
    position = np.arange(len(place)) - np.repeat(starts, np.diff(np.append(starts, len(array) - 1)))
    by_place = position.astype(np.uint64) * np.uint64(0x9E3779B1) + np.uint64(0x85EBCA77)
    letters = (array[:-1].astype(np.uint64) + np.uint64(7)) * by_place
    sums = np.add.reduceat(letters * (letters >> np.uint64(15) | np.uint64(1)), starts)
    yield ((sums * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.int64) % BUCKETS, text_of
    # A word that its neighbour repeats is one more feature, the same for all words.
    again = np.flatnonzero((sums[1:] == sums[:-1]) & (text_of[1:] == text_of[:-1]))
    if len(again):
        yield np.full(len(again) * REPEAT_WEIGHT, REPEATED), np.repeat(text_of[again], REPEAT_WEIGHT)


def _means(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its buckets and their shares."""
    found = []
    for text in texts:
        parts = [buckets for buckets, _ in features([text])]
        if not parts:
            found.append((np.zeros(0, np.int32), np.zeros(0, np.float32)))
            continue
        buckets, n = np.unique(np.concatenate(parts), return_counts=True)
        found.append((buckets.astype(np.int32), (n / n.sum()).astype(np.float32)))
    return found


class Model:
    """``weight`` of each bucket and ``bias``: the log odds of label 1 are their mean plus bias."""

    def __init__(self, weight: np.ndarray, bias: float) -> None:
        self.weight, self.bias = weight, bias

    def score(self, texts: list[str]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for buckets, text in features(texts):
            total += np.bincount(text, weights=self.weight[buckets], minlength=len(texts))
            count += np.bincount(text, minlength=len(texts))
        odds = total / np.maximum(1, count) + self.bias
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def train(
    texts: list[str],
    labels: np.ndarray,
    epochs: int = EPOCHS,
    rate: float = RATE,
    seed: int = 7,
    prior: float | None = None,
) -> Model:
    """Fit embeddings and softmax to ``texts``; the same texts in the same order give the same.

    ``prior`` is the share of label 1 in the population, if the sample has another: the bias is
    moved by the difference of log odds.
    """
    random = np.random.default_rng(seed)
    table = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.zeros(2, np.float32)
    rows = _means(texts)
    steps = epochs * ((len(rows) + BATCH - 1) // BATCH)
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for begin in range(0, len(order), BATCH):
            now = rate * (1 - step / max(1, steps))
            step += 1
            batch = order[begin : begin + BATCH]
            ids = np.concatenate([rows[i][0] for i in batch])
            shares = np.concatenate([rows[i][1] for i in batch])
            of = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
            hidden = np.stack([np.bincount(of, table[ids, d] * shares, len(batch)) for d in range(DIMENSIONS)], axis=1)
            logits = hidden @ output + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), labels[batch]] -= 1
            back = (p @ output.T)[of] * shares[:, None]
            output -= now * (hidden.T @ p).astype(np.float32) / len(batch) * 8
            bias -= now * p.mean(axis=0).astype(np.float32)
            # Shares are small, so steps on the table are scaled to a text's typical bucket count.
            for d in range(DIMENSIONS):
                table[:, d] -= (now * 16 * np.bincount(ids, back[:, d], BUCKETS)).astype(np.float32)
    weight = table @ (output[:, 1] - output[:, 0])
    odds = float(bias[1] - bias[0])
    share = float(np.mean(labels)) if len(labels) else 0.5
    if prior is not None and 0 < share < 1 and 0 < prior < 1:
        odds += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return Model(weight.astype(np.float32), odds)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample_key: Column | None = None,
    label: str = "quality",
    rows_per_label: int = ROWS_PER_LABEL,
    training_bytes: int = TRAINING_BYTES,
) -> Model:
    """Fit on a bounded sample of the labelled ``docs``.

    ``labels`` has doc_id and ``label`` (0 or 1; other labels and nulls teach nothing). Without
    rows of both labels every text scores the share of label 1, or a half without any.
    """
    key = F.xxhash64("doc_id") if sample_key is None else sample_key
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    if len(sizes) < 2:
        share = sizes.get(1, 0) / total if total else 0.5
        odds = np.log((share + 1e-9) / (1 - share + 1e-9))
        return Model(np.zeros(BUCKETS, np.float32), float(np.clip(odds, -30, 30)))
    part = F.when(F.col("label") == 1, min(1.0, rows_per_label / sizes[1])).otherwise(min(1.0, rows_per_label / sizes[0]))
    chosen = known.filter(F.pmod(key, F.lit(1 << 20)) < part * (1 << 20)).distinct()
    # Some 2 * rows_per_label ids: broadcast, so that the texts are filtered as they are read.
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    size = sample.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fair = int(min(1.0, training_bytes / max(1, size)) * (1 << 20))
    thinned = sample.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < fair)
    rows = sorted((r.doc_id, r.text, r.label) for r in thinned.collect())
    if len({r[2] for r in rows}) < 2:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(sizes[1] / sizes[0])))
    return train([r[1] for r in rows], np.array([r[2] for r in rows]), prior=sizes[1] / total)


def scored(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``keep`` columns, ``score`` (likelihood of label 1) and ``predicted`` for every row.

    Null and empty texts score the bias alone; texts are read whole; repeated rows score alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            parts = [shared.value.score(texts) for texts in chunked([t or "" for t in batch.tolist()])]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.select(*keep, F.pandas_udf(of, "double")(F.col(text)).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
