"""What language labelling says without Viterbi is what Viterbi says."""

from __future__ import annotations

import random

import numpy as np

from cellwise.llm import language


def test_shortcut_is_the_best_path(monkeypatch):
    rng = np.random.default_rng(47)
    model = language.Model(["a", "b", "c"], np.zeros((1, 3)), np.zeros((1, 3), bool), 14.0)
    count = random.Random(47)
    texts, wrong = [" ".join("xy" * count.randrange(1, 4) for _ in range(count.randrange(1, 12))) for _ in range(3000)], 0
    words = language.Words(texts)
    scores = rng.normal(size=(len(words.starts), 3)) * rng.choice([1.0, 3.0, 6.0], (len(words.starts), 1))
    monkeypatch.setattr(language.Model, "emissions", lambda self, words: scores)
    for i, (_, _, spans) in enumerate(model.label(texts)):
        path = language.viterbi(scores[words.text_of == i], model.switch).tolist()
        wrong += [model.languages.index(n) for n, k in spans for _ in range(k)] != path
    assert wrong == 0, f"{wrong} of {len(texts)} texts"
