"""Texts are hashed many at once, and each as if it were alone."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from cellwise.llm import passages


def pieces(texts):
    columns = [pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts, pa.string())]
    batch = pa.RecordBatch.from_arrays(columns, names=["doc", "row", "text"])
    made = [r for b in passages._pieces(iter([batch])) for r in b.to_pylist()]
    return sorted(made, key=lambda r: (r["doc"], r["bands"] is None, r["start"], r["end"]))


def test_texts_are_hashed_at_once(monkeypatch):
    rng = random.Random(9)
    line = lambda n: " ".join(rng.choices("abcdefghijk", k=n))
    texts = [None, "", "a", "a " * 39, "a " * 40, "a " * 300]
    texts += ["\n".join(line(rng.randrange(60)) for _ in range(rng.randrange(1, 12))) for _ in range(200)]
    alone = [r | {"doc": i, "row": i} for i, t in enumerate(texts) for r in pieces([t])]
    made = []

    class Counted(passages.Words):
        def __init__(self, *given):
            made.append(len(given))
            super().__init__(*given)

    monkeypatch.setattr(passages, "Words", Counted)
    together = pieces(texts)
    assert together == alone and len(together) > 500
    assert len(made) == 1 and made[0] > 100


def test_shingles_and_bands_of_lines():
    words = passages.Words("a b c d e f g h", "e f g h a b c d e f g a b c d e f g", "x y")
    start, end = np.array([0, 8, 15, 26]), np.array([8, 26, 26, 28])
    sets, at = words.shingles(start, end)
    each = [sets[i:j] for i, j in zip(at, at[1:])]
    for found, s, e in zip(each, start, end):
        n = min(passages.SHINGLE, e - s)
        first = np.arange(s, e - n + 1)
        assert found.tolist() == sorted(set(words.runs(first, first + n).tolist()))
    own = passages.bands(sets, at)
    for i, found in enumerate(each):
        assert (passages.bands(found, np.array([0, len(found)]))[0] == own[i]).all()
