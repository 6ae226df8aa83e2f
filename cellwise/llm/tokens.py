"""Token counts: batch encoding in Arrow functions that return lengths only.

Rows are dealt by bytes, so no task gets most of the text, and each text is split where the
tokenizer surely splits it too. A piece is encoded once per batch of distinct pieces; its length
is kept in a bounded memory of the task and added up per text.

Null text counts as empty: no bytes, no tokens. Empty tables give no rows; repeated rows and
clashing extra columns are kept as they are, for only the two named columns are read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space that may surround a cut. A text with any other kind is cut nowhere near it.
CUT = " \t\n\r"
PIECE = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# A cut for texts with other white space: both neighbours of the blank are plain ASCII marks.
SAFE = re.compile(r"(?<=[!-~])(?= [!-~])")
REMEMBERED = 400_000
BATCH_BYTES = 1 << 18


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=4)
def _encoder(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pieces(text: str) -> list[str]:
    """``text`` in pieces that encode on their own as they do within it.

    The tokenizer's pattern never joins a mark and the white space after it, so a cut there is
    safe; no piece is cut inside a run of white space.
    """
    return SAFE.split(text) if OTHER_SPACE.search(text) else PIECE.findall(text)


class Lengths:
    """Token counts of texts, with a bounded memory of pieces seen in this task."""

    def __init__(self, path: str) -> None:
        self.encoder = _encoder(path)
        self.known: dict[str, int] = {}

    def learn(self, new: list[str]) -> None:
        batch: list[str] = []
        size = 0
        for piece in new:
            batch.append(piece)
            size += len(piece)
            if size >= BATCH_BYTES:
                self._encode(batch)
                batch, size = [], 0
        if batch:
            self._encode(batch)

    def _encode(self, batch: list[str]) -> None:
        encoded = self.encoder.encode_batch_fast(batch, add_special_tokens=False)
        self.known.update(zip(batch, map(len, encoded)))

    def of(self, texts: list[str]) -> Iterator[int]:
        for text in texts:
            if len(self.known) > REMEMBERED:
                self.known = {}
            found = pieces(text)
            known = self.known
            try:
                yield sum(map(known.__getitem__, found))
            except KeyError:
                self.learn(list({p for p in found if p not in known}))
                yield sum(map(self.known.__getitem__, found))


def token_counts(
    docs: DataFrame,
    text: str = "text",
    tokenizer: str | None = None,
    keep: tuple[str, ...] = ("doc_id",),
    limit: int = 512,
) -> DataFrame:
    """``keep`` columns, ``n_bytes``, ``n_tokens`` and ``over_limit`` for every row of ``docs``."""
    path = tokenizer or default_tokenizer()

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = Lengths(path)
        for texts in batches:
            yield pd.Series(list(lengths.of(texts.tolist())), dtype="int64")

    counted = F.pandas_udf(count, "long")
    whole: Column = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return (
        by_bytes(docs.select(*keep, whole.alias("_text")))
        .select(
            *keep,
            F.octet_length("_text").cast("long").alias("n_bytes"),
            counted("_text").alias("n_tokens"),
        )
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


def by_bytes(docs: DataFrame) -> DataFrame:
    """Even out bytes between tasks: AQE splits and merges partitions of this exchange by size."""
    return docs.hint("rebalance")
