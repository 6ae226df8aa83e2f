"""Edited copies of paragraphs that are wrapped over several lines, or made of short ones."""

from __future__ import annotations

import random

from cellwise.llm import passages
from tests.llm.test_operators import docs_of, sentence


def wrapped(words, rng):
    lines = []
    while words:
        n = rng.randrange(10, 20)
        lines.append(" ".join(words[:n]))
        words = words[n:]
    return "\n".join(lines)


def test_edited_wrapped_paragraphs_are_cut(spark):
    rng = random.Random(53)
    texts, edits = [], []
    for n in (60, 200) * 5:
        words = sentence(rng, n, 3000).split()
        texts.append(sentence(rng, 30, 3000) + "\n\n" + wrapped(words, rng) + "\n\n" + sentence(rng, 30, 3000))
        for at in range(30, n, 100):
            words[at] = f"edit{rng.random()}"
        edits.append(sentence(rng, 30, 3000) + "\n\n" + wrapped(words, rng) + "\n\n" + sentence(rng, 30, 3000))
    rows = {r.doc_id: r for r in passages.cleaned(docs_of(spark, texts + edits)).collect()}
    whole = [i for i in range(10) if rows[10 + i].n_removed >= (60, 200)[i % 2]]
    assert len(whole) == 10, f"{len(whole)} of 10 are cut whole"
    assert all(rows[i].n_removed == 0 and rows[10 + i].n_words - rows[10 + i].n_removed >= 50 for i in range(10))


def test_units_of_short_lines():
    rng = random.Random(59)
    short = [sentence(rng, rng.randrange(4, 12), 3000) for _ in range(60)]
    spans = lambda t: [" ".join(t.split()[s:e]) for s, e in passages.lines_of(t)]
    apart = spans("\n\n".join(short))
    assert len(apart) >= 2 and all(len(s.split()) >= passages.PASSAGE for s in apart)
    # Cuts move with the content: other lines before and after leave inner windows as they are.
    moved = spans("\n\n".join([sentence(rng, 9, 3000) for _ in range(5)] + short + [sentence(rng, 9, 3000)] * 2))
    assert set(apart[1:-1]) <= set(moved) and apart[1:-1]
    block = spans("\n".join(short))
    assert block[0] == " ".join(short) and len(block) > 1
    assert spans("\n".join(short[:2])) == [] and spans(" ".join(short)) == [" ".join(short)]
