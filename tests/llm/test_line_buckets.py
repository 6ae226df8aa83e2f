"""Similar lines within one large bucket, against brute force."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from cellwise.llm import passages
from tests.llm.test_operators import docs_of, sentence, union_find


def test_small_clusters_of_a_templated_bucket(spark):
    """Lines of one template that agree in every band: pairs within them are found."""
    rng = random.Random(41)
    template = sentence(rng, 60, 3000)
    lines = [f"{template} {sentence(rng, 40, 3000)}" for _ in range(300)]
    for base in lines[:30]:
        lines.append(" ".join([*base.split()[:-3], f"edit{rng.random()}", *base.split()[-2:]]))
    docs = docs_of(spark, lines).select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("row"), "text")
    schema = "doc long, row long, start int, end int, hash long, bands array<long>, windows array<long>"
    same = F.transform(F.sequence(F.lit(1), F.lit(passages.BANDS)), lambda i: i.cast("long"))
    rows = docs.mapInArrow(passages._pieces, schema).filter("bands is not null").withColumn("bands", same).persist()
    of = {r["hash"]: r.doc for r in rows.collect()}
    pairs = [(of[r.x], of[r.y]) for r in passages.similar_lines(docs, rows).collect()]
    grams = [{tuple(w[i : i + 5]) for i in range(96)} for w in map(str.split, lines)]
    true = [(i, j) for i in range(330) for j in range(i) if len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])]
    lost = set(true) - {(max(p), min(p)) for p in pairs}
    assert len(true) == 30 and not lost, f"{len(lost)} of {len(true)} pairs are lost"
    assert union_find(pairs) == union_find(true)


def test_a_template_makes_few_pairs(spark):
    """Lines that share three words in four, and rare shingles only in pairs: sketches part them."""
    rng = random.Random(43)
    template = sentence(rng, 60, 3000).split()
    halves = [sentence(rng, 14, 3000).split() for _ in range(40)]
    rows, clusters = [], []
    for i in range(1200):
        words = [*template, *halves[i % 40], *sentence(rng, 26, 3000).split()]
        rows.append(words)
    for i in range(0, 60, 2):
        rows.append([*rows[i][:-2], "edit", f"no{i}"])
        clusters.append((len(rows) - 1, i))
    grams = [sorted({hash(tuple(w[i : i + 5])) for i in range(len(w) - 4)}) for w in rows]
    sets = [(i, i, g, *passages.sketch(np.array(g, np.int64).view(np.uint64)).tolist()) for i, g in enumerate(grams)]
    schema = "hash long, component long, shingles array<long>, " + ", ".join(f"{c} long" for c in passages.SKETCH)
    met = {(r.x, r.y) for r in passages.shared_prefixes(spark.createDataFrame(sets, schema)).collect()}
    of = [set(g) for g in grams]
    true = {p for i in range(len(of)) for j in range(i) for p in [(i, j)] if len(of[i] & of[j]) >= 0.8 * len(of[i] | of[j])}
    assert true == set(clusters)
    assert not true - {(max(p), min(p)) for p in met}
    assert len(met) <= 2 * len(rows)


def compared_pairs(spark, monkeypatch, lines: list[str]) -> int:
    """Pairs that ``similar_lines`` compares; its groups must be those of brute force."""
    docs = docs_of(spark, lines).select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("row"), "text")
    schema = "doc long, row long, start int, end int, hash long, bands array<long>, windows array<long>"
    rows = docs.mapInArrow(passages._pieces, schema).filter("bands is not null").persist()
    of = {r["hash"]: r.doc for r in rows.collect()}
    compared, similar = [], passages._similar

    def counted(pairs, sets):
        compared.append(pairs.count())
        return similar(pairs, sets)

    monkeypatch.setattr(passages, "_similar", counted)
    pairs = [(of[r.x], of[r.y]) for r in passages.similar_lines(docs, rows).collect()]
    grams = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, lines)]
    true = [(i, j) for i in range(len(lines)) for j in range(i) if len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])]
    assert union_find(pairs) == union_find(true)
    return sum(compared)


def test_near_copies_ask_about_one_representative_each(spark, monkeypatch):
    """A large group of near copies, among pairs and lines alone."""
    rng = random.Random(59)
    base = sentence(rng, 100, 3000).split()
    lines = [" ".join([*base[:at], f"edit{i}", *base[at + 1 :]]) for i in range(400) for at in [rng.randrange(100)]]
    for i in range(40):
        other = sentence(rng, 80, 3000)
        lines += [other, f"{other} once{i}"]
    assert compared_pairs(spark, monkeypatch, lines) <= 1.5 * len(lines)


def test_near_copies_with_several_edits_meet_in_the_middle(spark, monkeypatch):
    """Copies of which few are similar to each other, as most have several edits.

    Both stages before the last make at most one pair a line and band.
    """
    rng = random.Random(61)
    base = sentence(rng, 100, 3000).split()
    lines = []
    for i in range(500):
        words = list(base)
        for at in rng.sample(range(100), 1 + i % 5):
            words[at] = f"edit{rng.random()}"
        lines.append(" ".join(words))
    assert compared_pairs(spark, monkeypatch, lines) <= (2 * passages.BANDS + 1) * len(lines)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 2**63, rng.integers(0, 300), dtype=np.uint64)) for _ in range(2))
        b = np.union1d(b[:5], a[: rng.integers(0, len(a) + 1)])
        bits = sum(int(x).bit_count() for x in (passages.sketch(a) ^ passages.sketch(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))


def test_stitched_text_is_not_cut(spark):
    """Words of two earlier documents, neither of which has enough of them."""
    rng = random.Random(47)
    earlier = [sentence(rng, 300, 100_000) for _ in range(120)]
    third = []
    for i in range(60):
        a, b = earlier[i].split(), earlier[60 + i].split()
        at, to = rng.randrange(260), rng.randrange(260)
        third.append(" ".join([sentence(rng, 50, 100_000), *a[at : at + 35], *b[to : to + 32], sentence(rng, 50, 100_000)]))
    whole = [f"{sentence(rng, 50, 100_000)} {' '.join(earlier[i].split()[100:152])} {sentence(rng, 50, 100_000)}" for i in range(60)]
    rows = {r.doc_id: r for r in passages.cleaned(docs_of(spark, earlier + third + whole)).collect()}
    assert all(rows[i].text == text for i, text in enumerate(earlier + third))
    caught = [rows[180 + i].n_removed for i in range(60)]
    assert all(n <= 52 for n in caught)
    assert sum(n >= passages.PASSAGE for n in caught) >= 58


def test_every_holder_is_asked(spark):
    """A passage goes though a phrase of it stands in a still earlier document."""
    rng = random.Random(53)
    passage = sentence(rng, 70, 100_000).split()
    texts = [f"{sentence(rng, 60, 100_000)} {' '.join(passage[20:45])} {sentence(rng, 60, 100_000)}"]
    texts += [f"{sentence(rng, 60, 100_000)} {' '.join(passage)} {sentence(rng, 60, 100_000)}" for _ in range(3)]
    rows = {r.doc_id: r for r in passages.cleaned(docs_of(spark, texts)).collect()}
    assert [rows[i].n_removed for i in (0, 1)] == [0, 0]
    assert all(70 - 2 * passages.STEP < rows[i].n_removed <= 70 for i in (2, 3))
