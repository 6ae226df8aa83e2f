"""Line-first quality rules against plain Python, and on odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from cellwise.llm import rules

FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
PROSE = [
    "The river rose in the night and the old bridge held for one more year, as everybody had hoped it would.",
    "Her uncle kept bees behind a wall of stones that nobody had moved since his father came home.",
    "When trains were late, people on this platform told each other what they knew about distant weather.",
    "A map without names hung over my desk until someone asked which sea was painted green.",
]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def figures(text):
    text = text or ""
    words = words_of(text)
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(runs)
    covered = {i + k for i, run in enumerate(runs) if seen[run] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if words_of(line)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def judged(spark, texts, **options):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, _lines string")
    return {r.doc_id: r for r in rules.line_cleaned(docs, **options).collect()}


def test_figures(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "b", "é", "😀#", " ", " ", "\t", "\n", "\r\n", " ", "\x0b"]) for _ in range(rng.randrange(90))) for _ in range(300)]
    got = judged(spark, texts)
    for i, text in enumerate(texts):
        assert tuple(got[i][c] for c in FIGURES) == figures(text), text


@pytest.mark.parametrize(
    "line, passes",
    [
        ("A plain sentence ends here.", True),
        ("„Nein“, sagte er, „nicht heute.”", True),
        ("First sentence. And then a tail without an end", True),
        ("no end at all", False),
        ("SHOUT!! EVERY!! SINGLE!! WORD!!.", False),
        ("What?! Really!", False),
        ("one### two&&& three*** four$$$ five.", False),
        ("home | news | sport | about | contact.", False),
        ("Read more.", False),
        ("  Next!", False),
        ("All rights reserved.", False),
        ("This site uses cookies.", False),
        ("Nobody was surprised when the lawyer read the terms of use aloud to all the guests who had come to the wedding that day.", True),
        ("", False),
        (" \t", False),
    ],
)
def test_lines(spark, line, passes):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(rules.passes(df.line)).first()[0] is passes


def test_verdicts(spark):
    good = PROSE
    junk = "click | here | now | and | then | there"
    texts = [
        "\n".join(good),
        "\n".join([*good, "", junk, "Next"]),
        "\n".join([*good, *[" | ".join(f"entry{i}{k}" for k in range(6)) for i in range(9)]]),
        "\n".join(good[:2]),
        "\n".join([good[0]] * 4),
    ]
    got = judged(spark, texts)
    assert [got[i].kept for i in range(5)] == [True, True, False, False, False]
    assert [got[i].base_failed for i in range(5)] == [False, False, False, True, True]
    assert got[0].cleaned == got[1].cleaned == got[2].cleaned == texts[0]
    assert got[4].cleaned == good[0] and got[4].n_dup_lines == 3
    assert got[1].n_left == got[0].n_words
    lenient = judged(spark, texts, max_lost=90, min_words=1)
    assert lenient[2].kept and lenient[3].kept


def test_odd_rows(spark, odd_docs, no_docs):
    got = rules.line_cleaned(odd_docs, keep=("text", "source"))
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert tuple(r[c] for c in FIGURES) == figures(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept) and r.cleaned is not None
    assert rules.line_cleaned(no_docs).count() == 0


def test_no_shuffle_and_no_python(spark, odd_docs):
    plan = rules.line_cleaned(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
