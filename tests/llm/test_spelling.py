"""Spelling variants against all pairs of words, and on odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from cellwise.llm import spelling

NAMES = ["word", "form", "root", "n", "n_near", "form_n"]


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    form, found = {}, {}
    for w, n in counts.items():
        near = sorted((-m, x) for x, m in counts.items() if is_near(w, x))
        best = near[0] if near and -near[0][0] >= 2 * n else None
        form[w] = best[1] if best else None
        found[w] = (n, len(near), -best[0] if best else None)
    rows = []
    for w, (n, n_near, form_n) in found.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, n_near, form_n))
    return sorted(rows)


def answers(spark, counts):
    rows = [(w, n, "x", "y") for w, n in counts.items()]
    got = spelling.variants(spark.createDataFrame(rows, "word string, n long, prefix string, best string"))
    assert got.columns == NAMES
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    letters = "abé"  # few letters: rows of equal letters, and words with many neighbours
    counts = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 7))): rng.choice([1, 1, 2, 3, 5, 8, 20]) for _ in range(220)}
    assert answers(spark, counts) == brute(counts)


def test_forms_follow_each_other(spark):
    counts = {"abcdef"[:k] + "x" * (9 - k): 3 * 4**k for k in range(7)}
    rows = answers(spark, counts)
    assert rows == brute(counts)
    assert {r[2] for r in rows} == {"abcdefxxx"}


def test_ties_go_to_the_smallest_word(spark):
    assert answers(spark, {"zebra": 1, "zebro": 9, "zebre": 9, "ébène": 2}) == brute({"zebra": 1, "zebro": 9, "zebre": 9, "ébène": 2})


def test_one_pattern_with_every_letter(spark):
    counts = {f"pa{chr(c)}tern": 1 + c % 5 for c in [*range(97, 123), *range(0xDF, 0x100)]}
    assert answers(spark, counts) == brute(counts)


def expected_counts(rows, one_in=97):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


@pytest.mark.parametrize("errors", [1, 3, 97])
def test_counts(spark, odd_docs, errors):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    rows += [(i, f"Straße, ÀÉÎ×÷xyz: {'Longest words ' * 5}{chr(105 + i % 3)}nterest-KELVINKelvin") for i in range(40)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, word string")
    got = {r.word: r.n for r in spelling.word_counts(docs, errors=errors).collect()}
    assert got == expected_counts(rows, errors) != {}


def test_whole_query_on_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = spelling.variants(spelling.word_counts(odd_docs))
    assert sorted(tuple(r) for r in got.collect()) == brute(expected_counts(rows))
    empty = spelling.variants(spelling.word_counts(no_docs))
    assert empty.columns == NAMES and empty.count() == 0


def test_repeated_and_null_words(spark):
    words = spark.createDataFrame([("house", 2), ("house", 3), ("mouse", 1), (None, 9)], "word string, n long")
    assert sorted(tuple(r) for r in spelling.variants(words).collect()) == brute({"house": 5, "mouse": 1})


def test_a_low_ratio_is_refused(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([("house", 2)], "word string, n long"), ratio=1)
