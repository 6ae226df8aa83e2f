"""Language identification of mixed text: scripts, word scores, and Viterbi over the words.

A word's script narrows the languages it may belong to (those that use the script in the training
texts). Each language scores the word by a smoothed multinomial over hashed character n-grams.
Viterbi then labels the words of a text, paying a penalty for every switch, which gives spans;
the language of a text is the one with most letters.

Most texts have one language only: if in no run of words another language gains more than the
penalty over the text's best one, no switch can pay, and the path is that one label. The others
go through the recurrence.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.llm.text import boundary_array, chunked, ngram_buckets, word_starts

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 15
# Rows of the training set per language, and bytes of all of them: what the fit reads at most,
# in expectation, however large the table is.
ROWS_PER_LANGUAGE = 3_000
TRAINING_BYTES = 64 << 20
SWITCH = 14.0
SMOOTHING = 0.1
# Share of a language's letters that a script needs for the language to use it.
SCRIPT_SHARE = 0.005
NO_LANGUAGE = "und"
IMPOSSIBLE = -1e3

# Code point ranges of scripts (first, last, name); unlisted letters have none.
SCRIPTS = (
    (0x0041, 0x005A, "latin"), (0x0061, 0x007A, "latin"), (0x00AA, 0x00AA, "latin"),
    (0x00BA, 0x00BA, "latin"), (0x00C0, 0x024F, "latin"), (0x0250, 0x02AF, "latin"),
    (0x0370, 0x03FF, "greek"), (0x0400, 0x052F, "cyrillic"), (0x0531, 0x058F, "armenian"),
    (0x0591, 0x05F4, "hebrew"), (0x0600, 0x06FF, "arabic"), (0x0750, 0x077F, "arabic"),
    (0x0900, 0x097F, "devanagari"), (0x0980, 0x09FF, "bengali"), (0x0A00, 0x0A7F, "gurmukhi"),
    (0x0A80, 0x0AFF, "gujarati"), (0x0B80, 0x0BFF, "tamil"), (0x0C00, 0x0C7F, "telugu"),
    (0x0C80, 0x0CFF, "kannada"), (0x0D00, 0x0D7F, "malayalam"), (0x0E00, 0x0E7F, "thai"),
    (0x0E80, 0x0EFF, "lao"), (0x1000, 0x109F, "myanmar"), (0x10A0, 0x10FF, "georgian"),
    (0x1100, 0x11FF, "hangul"), (0x1200, 0x137F, "ethiopic"), (0x1780, 0x17FF, "khmer"),
    (0x1E00, 0x1EFF, "latin"), (0x1F00, 0x1FFF, "greek"), (0x3040, 0x309F, "kana"),
    (0x30A0, 0x30FF, "kana"), (0x3400, 0x4DBF, "han"), (0x4E00, 0x9FFF, "han"),
    (0xAC00, 0xD7AF, "hangul"), (0xF900, 0xFAFF, "han"), (0x20000, 0x2FA1F, "han"),
)
SCRIPT_NAMES = ("none", *sorted({name for _, _, name in SCRIPTS}))
# Written without blanks: every letter is a word of its own.
UNSPACED = ("han", "kana", "thai", "lao", "khmer", "myanmar")


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and the number of its script."""
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    script = np.zeros(0x110000, np.int8)
    for first, last, name in SCRIPTS:
        script[first : last + 1] = SCRIPT_NAMES.index(name)
    return letter, script


@lru_cache(maxsize=1)
def _in_words() -> np.ndarray:
    """Code points of words: letters, and the marks of listed scripts, which carry words on."""
    letter, script = _letters()
    inside = letter.copy()
    for i in np.flatnonzero((script > 0) & ~letter):
        inside[i] = unicodedata.category(chr(i)).startswith("M")
    return inside


class Words:
    """The words of some texts in one array, with the buckets of their n-grams."""

    def __init__(self, texts: list[str]) -> None:
        is_letter, script = _letters()
        lowered = [t.lower() for t in texts]
        unspaced = [SCRIPT_NAMES.index(s) for s in UNSPACED]
        self.array, self.text_of = boundary_array(lowered, _in_words(), lambda cp: np.isin(script[cp], unspaced))
        self.starts = word_starts(self.array)
        self.script = script[self.array[self.starts + 1]] if len(self.starts) else np.zeros(0, np.int8)
        counted = np.add.reduceat(is_letter[self.array], self.starts) if len(self.starts) else np.zeros(0)
        self.letters = counted.astype(np.int64)

    def buckets(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return ngram_buckets(self.array, ORDERS, BUCKETS)


class Model:
    """Log probabilities of n-gram buckets by language, and which languages use which script."""

    def __init__(self, languages: list[str], table: np.ndarray, uses: np.ndarray, switch: float) -> None:
        self.languages, self.table, self.uses, self.switch = languages, table, uses, switch

    def emissions(self, words: Words) -> np.ndarray:
        """Score of each word under each language; a language without the script is ruled out."""
        count = len(self.languages)
        total = np.zeros((len(words.array), count), np.float32)
        for buckets, valid in words.buckets():
            at = np.flatnonzero(valid)
            total[at] += self.table[buckets[at]]
        if not len(words.starts):
            return np.zeros((0, count))
        scores = np.add.reduceat(total, words.starts, axis=0).astype(np.float64) / len(ORDERS)
        may = self.uses[words.script]
        may |= ~may.any(axis=1, keepdims=True)  # a script nobody uses rules nobody out
        return np.where(may, scores, scores.min(axis=1, keepdims=True) + IMPOSSIBLE)

    def label(self, texts: list[str]) -> list[tuple[str, float, list[tuple[str, int]]]]:
        """For each text: its language, that language's share of the letters, and the spans."""
        out: list = [(NO_LANGUAGE, 0.0, [])] * len(texts)
        words = Words(texts)
        if not len(words.starts) or not self.languages:
            return out
        scores = self.emissions(words)
        edges = np.flatnonzero(np.diff(words.text_of, prepend=-1))
        which, ends = words.text_of[edges], np.append(edges[1:], len(words.text_of))
        best = np.add.reduceat(scores, edges, axis=0).argmax(axis=1)
        n_words = ends - edges
        gains = scores - scores[np.arange(len(scores)), np.repeat(best, n_words)][:, None]
        # Largest gain of any run: prefix sum less the least prefix before it, within each text.
        run = np.cumsum(gains, axis=0)
        span = np.abs(gains).sum(axis=0).max() + 1.0
        apart = np.repeat(np.arange(len(edges)), n_words)[:, None] * (2 * span)
        prefix = run - gains
        lowest = np.minimum.accumulate(prefix - apart, axis=0) + apart
        largest = np.maximum.reduceat(run - lowest, edges, axis=0).max(axis=1)
        lettered = np.add.reduceat(words.letters, edges) > 0
        for i, text in enumerate(which.tolist()):
            if not lettered[i]:
                continue
            name = self.languages[best[i]]
            # A path with m runs in other languages gains at most m * largest and switches m - 1
            # times or more, and one run of all words gains nothing; rounding goes to the recurrence.
            if 2 * largest[i] < self.switch - 1e-6:
                out[text] = (name, 1.0, [(name, int(n_words[i]))])
                continue
            path = viterbi(scores[edges[i] : ends[i]], self.switch)
            cuts = np.flatnonzero(np.diff(path, prepend=-1))
            spans = [(self.languages[path[c]], int(n)) for c, n in zip(cuts, np.diff(np.append(cuts, len(path))))]
            weight = np.bincount(path, weights=words.letters[edges[i] : ends[i]], minlength=len(self.languages))
            top = int(weight.argmax())
            out[text] = (self.languages[top], float(weight[top] / weight.sum()), spans)
        return out


def viterbi(scores: np.ndarray, switch: float) -> np.ndarray:
    """The labels with the greatest sum of scores less ``switch`` for every change of label.

    Among equals a path stays, and starts with the first language.
    """
    rows = scores.tolist()
    value = rows[0]
    came: list[list[int] | int] = []
    states = range(len(value))
    for row in rows[1:]:
        top = max(value)
        at = value.index(top)
        top -= switch
        if top > min(value):
            came.append([at if top > v else k for k, v in enumerate(value)])
            value = [(top if top > v else v) + s for v, s in zip(value, row)]
        else:
            came.append(-1)
            value = [v + s for v, s in zip(value, row)]
    state = max(states, key=value.__getitem__)
    path = [state]
    for back in reversed(came):
        if back != -1:
            state = back[state]
        path.append(state)
    return np.array(path[::-1])


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    sample_key: Column | None = None,
    rows_per_language: int = ROWS_PER_LANGUAGE,
    training_bytes: int = TRAINING_BYTES,
    switch: float = SWITCH,
) -> Model:
    """A model of the languages of ``labelled``, fitted on a bounded sample of it.

    ``sample_key`` decides evenly which rows are read (default: hash of the text). Rows without
    text or language teach nothing; without any row the model knows no language.
    """
    known = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    sizes = known.groupBy(lang).agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("bytes")).collect()
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool), switch)
    share = F.lit(0.0)
    for row in sizes:  # one row per language
        part = min(1.0, rows_per_language / row["n"], training_bytes / len(sizes) / max(1, row["bytes"]))
        share = F.when(F.col(lang) == row[lang], F.lit(part)).otherwise(share)
    key = F.xxhash64(F.col(text)) if sample_key is None else sample_key
    sample = known.filter(F.pmod(key, F.lit(1 << 20)) < share * (1 << 20))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, group in batch.groupby("lang"):
                grams, scripts = np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPT_NAMES), np.int64)
                for texts in chunked(group["text"].tolist()):
                    words = Words(texts)
                    for buckets, valid in words.buckets():
                        grams += np.bincount(buckets[valid], minlength=BUCKETS)
                    scripts += np.bincount(words.script, weights=words.letters, minlength=len(SCRIPT_NAMES)).astype(np.int64)
                for kind, values in (("gram", grams), ("script", scripts)):
                    at = np.flatnonzero(values)
                    if not len(at):
                        continue
                    yield pd.DataFrame({"lang": name, "kind": kind, "at": at, "n": values[at]})

    counts = (
        sample.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
        .mapInPandas(counted, "lang string, kind string, at long, n long")
        .groupBy("lang", "kind", "at")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most languages * (buckets + scripts) rows
    )
    languages = sorted(r[lang] for r in sizes)
    grams, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((len(SCRIPT_NAMES), len(languages)))
    column = counts["lang"].map({name: i for i, name in enumerate(languages)})
    for kind, into in (("gram", grams), ("script", scripts)):
        rows = counts["kind"] == kind
        into[counts["at"][rows], column[rows]] = counts["n"][rows]
    table = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * BUCKETS))
    uses = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=0))
    return Model(languages, table.astype(np.float32), uses & (scripts > 0), switch)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score`` and ``spans`` for every row of ``docs``.

    ``score`` is the share of letters in spans of ``lang_pred``; ``spans`` lists (lang, words) in
    order. Null texts and texts without a letter are ``und`` with score 0 and no span. Ties go to
    the first language by name. Very long texts are one text, not cut.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    result = "lang_pred string, score double, spans array<struct<lang:string,words:int>>"

    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: list = []
            for texts in chunked([t or "" for t in batch.tolist()], (1 << 21) // max(4, len(shared.value.languages))):
                found += shared.value.label(texts)
            yield pd.DataFrame(
                {
                    "lang_pred": [x[0] for x in found],
                    "score": [x[1] for x in found],
                    "spans": [[{"lang": name, "words": n} for name, n in x[2]] for x in found],
                }
            )

    return docs.select(*keep, F.pandas_udf(labelled, result)(F.col(text)).alias("_found")).select(*keep, "_found.*")
