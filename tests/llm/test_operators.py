"""Each operator against a brute-force version, and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwise.llm import (
    components,
    decontamination,
    html,
    language,
    mixing,
    neighbours,
    passages,
    quality,
    simhash,
    text,
    tokens,
    toxicity,
)
from tests.llm.conftest import LONG, ODD_ROWS


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def docs_of(spark, texts, **columns):
    rows = [(i, t, *[c[i] for c in columns.values()]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ["doc_id", "text", *columns])


# Shared helpers


def test_boundary_array_and_ngrams():
    inside = np.array([chr(i).isalpha() for i in range(0x110000)])
    array, of = text.boundary_array(["ab c", "", "d1e"], inside)
    assert [chr(c) if c else "_" for c in array] == list("_ab_c_d_e_")
    assert of.tolist() == [0, 0, 2, 2]
    grams = {n: v.sum() for n, (_, v) in zip((1, 2, 3), text.ngram_buckets(array, (1, 2, 3), 64))}
    # 5 letters; pairs _a ab b_ _c c_ _d d_ _e e_; triples _ab ab_ _c_ _d_ _e_.
    assert grams == {1: 5, 2: 9, 3: 5}


def test_texts_do_not_run_together():
    inside = np.array([chr(i).isalpha() for i in range(0x110000)])
    array, of = text.boundary_array(["ab", "cd"], inside)
    assert [chr(c) if c else "_" for c in array] == list("_ab_cd_")
    assert of.tolist() == [0, 1]


def test_chunks_keep_order_and_whole_texts():
    texts = ["a" * n for n in (3, 4, 0, 9, 1)]
    parts = list(text.chunked(texts, 7))
    assert [t for p in parts for t in p] == texts
    assert parts == [["aaa", "aaaa", ""], ["a" * 9], ["a"]]


def union_find(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in list(parent)}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]
    pairs += [(200, 201 + i) for i in range(30)] + [(300 + i, 301 + i) for i in range(20)]
    df = spark.createDataFrame([*pairs, (None, 3), (9, 9)], "a long, b long")
    found = {r.node: r.component for r in components.components(df, "a", "b").collect()}
    assert found == {k: v for k, v in union_find(p for p in pairs if p[0] != p[1]).items()}


def test_components_of_nothing(spark):
    df = spark.createDataFrame([], "a long, b long")
    assert components.components(df, "a", "b").count() == 0


# 1 language


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_is_the_best_path(seed):
    scores = np.random.default_rng(seed).normal(size=(6, 3)) * 3
    paths = itertools.product(range(3), repeat=6)
    value = lambda p: sum(scores[i, s] for i, s in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
    best = max(value(p) for p in paths)
    assert math.isclose(value(language.viterbi(scores, 2.0).tolist()), best)


def trained(spark):
    rng = random.Random(3)
    words = {"en": "the and with from that house green water".split(), "de": "der und mit von dass haus wasser grün".split(), "ru": "это дом вода зелёный или когда".split()}
    rows = [(" ".join(rng.choice(w) for _ in range(60)), name) for name, w in words.items() for _ in range(40)]
    df = spark.createDataFrame([*rows, (None, "en"), ("x", None)], "text string, lang string")
    return language.fit(df, switch=8.0)


def test_language_spans_and_skipped_recurrence(spark):
    model = trained(spark)
    mixed = "the house and the water with that green " * 3 + "der und mit von dass wasser haus " * 3
    (name, score, spans), = model.label([mixed])
    assert [s[0] for s in spans] == ["en", "de"] and name == "en" and 0.4 < score < 0.7
    assert abs(spans[0][1] - 24) <= 1 and sum(n for _, n in spans) == 45
    # What the shortcut says is what the recurrence says.
    for t in ("the house", "wasser haus der water the", mixed, "дом the дом"):
        words = language.Words([t])
        path = language.viterbi(model.emissions(words), model.switch)
        spans = model.label([t])[0][2]
        assert [model.languages.index(n) for n, k in spans for _ in range(k)] == path.tolist()


def test_language_scripts_narrow(spark):
    model = trained(spark)
    assert model.label(["дом"])[0][0] == "ru"
    assert model.label(["漢字 漢字"])[0][0] in model.languages
    # Signs and marks alone are no letters.
    assert [x[0] for x in model.label(["× ÷", "\u0301", "3 \u0967", "хата́"])] == ["und", "und", "und", "ru"]


def test_language_odd_rows(spark, odd_docs, no_docs):
    model = trained(spark)
    rows = language.identify(odd_docs, model).collect()
    assert len(rows) == len(ODD_ROWS)
    got = [(r.doc_id, r.lang_pred, r.score) for r in rows]
    assert got[0] == got[1] and all(0 <= s <= 1 for _, _, s in got)
    assert {i for i, name, _ in got if name == "und"} == {2, 3, 4, 5, None}
    assert language.identify(no_docs, model).count() == 0
    nobody = language.fit(no_docs)
    assert {r.lang_pred for r in language.identify(odd_docs, nobody).collect()} == {"und"}


# 2 mixing


def test_targets_are_water_levels(spark):
    sizes = spark.createDataFrame([("b", 100), ("a", 10), (None, 1000), ("c", 300)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    # Weights a 5, b 2, c 1, null 5 of 2115 words; a and b are capped.
    left = 1.5 * 1410 - 20 - 200
    assert got["a"] == 20 and got["b"] == 200
    assert math.isclose(got["c"], left / 6) and math.isclose(got[None], left * 5 / 6)


def test_mix_near_targets_and_reruns(spark):
    rng = random.Random(5)
    texts = [sentence(rng, rng.randrange(1, 60)) for _ in range(600)]
    docs = docs_of(spark, texts, source=[rng.choice(["x", "y", "z", None]) for _ in texts])
    rows = mixing.mix(docs).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=str)
    by = defaultdict(list)
    for r in rows:
        assert r.taken % max(1, r["size"]) == 0 and r.taken <= 2 * r["size"]
        by[r.source].append(r)
    for own in by.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= 30
        # Complete epochs precede the fractional one.
        epochs = {r.taken // r["size"] for r in own}
        assert max(epochs) - min(epochs) <= 1


def test_mix_prefers_weight(spark):
    docs = docs_of(spark, ["a b c d"] * 4000, source=["s" if i % 2 else "t" for i in range(4000)])
    heavy = docs.filter("doc_id % 4 = 1").select(F.col("doc_id").alias("id"), F.lit(5.0).alias("weight"))
    rows = mixing.mix(docs, weights=(1,), share=0.5, quality=heavy).collect()
    share = lambda keep: np.mean([r.taken for r in rows if r.source == "s" and keep(r.doc_id % 4 == 1)])
    assert share(lambda h: h) > share(lambda h: not h)


def test_mix_odd_rows(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == len(ODD_ROWS)
    assert {r["size"] for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert all(r.taken == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(no_docs).count() == 0


# 3 decontamination


def brute_contamination(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans(decontamination.UPPER, decontamination.LOWER)
    words = lambda t: word.findall((t or "").translate(lower))
    runs = defaultdict(set)
    for item, t in items:
        w = words(t)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            runs[tuple(w[i : i + n])].add(item)
    out = []
    for doc, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in {len(r) for r in runs}:
            for i in range(len(w) - n + 1):
                if run := runs.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= run
        names = sorted(str(x) for x in found if x is not None)
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(names), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_contamination(spark):
    rng = random.Random(7)
    items = [(i, sentence(rng, rng.choice([20, 40]))) for i in range(12)]
    items += [(12, sentence(rng, 13)), (13, "É short ITEM"), (14, "lonely"), (15, "..."), (16, None), (3, "another text of item three")]
    items += [(None, sentence(rng, 20)), (17, "x"), (17, "x"), (18, sentence(rng, 3) + " x y z")]
    docs = [(i, sentence(rng, 80)) for i in range(20)]
    for i in range(20, 60):
        item = rng.choice(items)[1] or ""
        w = item.split()
        a = rng.randrange(max(1, len(w) - 5))
        docs.append((i, f"{sentence(rng, 30)}, {' '.join(w[a : a + rng.choice([5, 12, 13, 14, 30])]).upper()}! {sentence(rng, 10)} {rng.choice(['', 'Lonely.', 'x', 'é short item', 'É SHORT item'])}"))
    docs += [(60, None), (61, ""), (62, "..."), (63, LONG), (63, LONG), (None, items[0][1]), (64, items[0][1] * 2)]
    got = decontamination.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_contamination(docs, items)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan


def test_contamination_without_items(spark, odd_docs, no_docs):
    items = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontamination.contamination(odd_docs, items).collect()} == {0}
    items = spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string")
    assert decontamination.contamination(no_docs, items).count() == 0
    kept = decontamination.clean(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == len(ODD_ROWS) - 2


# 4 nearest


def brute_nearest(vectors, k):
    good = [(i, v) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    dim = Counter(len(v) for _, v in good).most_common(1)[0][0]
    good = [(i, np.array(v)) for i, v in good if len(v) == dim]
    out = {}
    for q, v in good:
        if q % 20 == 0:
            ranked = sorted(((-float((v * w).sum()), i) for i, w in good if i != q))
            out[q] = [i for _, i in ranked[:k]]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(9)
    vectors = [(i, (rng.normal(size=8) * rng.choice([1, 3])).tolist()) for i in range(900)]
    vectors[100:400] = [(i, vectors[100][1]) for i in range(100, 400)]  # one vector of a third
    vectors += [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] * 8), (1003, [None] + [1.0] * 7), (1004, []), (1020, [1.0, 2.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    rows = neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect()
    got = defaultdict(dict)
    for r in rows:
        got[r.query_id][r.rank] = r.vec_id
    true = brute_nearest(vectors, 20)
    assert set(got) == set(true) and all(sorted(g) == list(range(1, 21)) for g in got.values())
    hits = [len(set(got[q].values()) & set(true[q])) / 20 for q in true]
    assert np.mean(hits) >= 0.9
    same = [q for q in true if 100 <= q < 400]
    assert all(list(got[q].values()) == true[q] for q in same)


def test_nearest_of_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    rows = [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect()]
    assert sorted(rows) == [(0, 1, 3, 1.0), (0, 2, 20, 0.0), (20, 1, 3, 1.0), (20, 2, 0, 0.0)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# 5 toxicity


def test_severity_of_three_grades(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(600):
        grade = rng.choice([0, 0, 1, 2])
        words = sentence(rng, 30).split() + {0: [], 1: ["rude"], 2: ["vile"]}[grade]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, grade))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int"))
    assert model.grades == [0, 1, 2] and np.all(np.diff(model.thresholds) >= 0)
    assert 0 < model.weights["rude"] < model.weights["vile"]
    got = {r.doc_id: r for r in toxicity.severities(docs, model).collect()}
    assert np.mean([got[i].grade == g for i, g in labels]) > 0.98
    assert model.severity("so vile") > model.severity("so rude") > model.severity("so kind")


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (6, 1)], "doc_id long, toxic int")
    model = toxicity.fit(odd_docs, labels)
    rows = toxicity.severities(odd_docs, model).collect()
    assert len(rows) == len(ODD_ROWS) and not any(r.toxic for r in rows if r.doc_id in (2, 3, 4, 5))
    assert toxicity.without_toxic(odd_docs, model).columns == odd_docs.columns
    none = toxicity.fit(odd_docs, labels.limit(0))
    assert toxicity.without_toxic(odd_docs, none).count() == len(ODD_ROWS)
    assert toxicity.severities(no_docs, model).count() == 0


# 6 HTML

PAGES = {
    "plain": ("just words\n here", "just words here"),
    "none": (None, ""),
    "empty": ("", ""),
    "no text": ("<html><body><img></body></html>", ""),
    "article": (
        "<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>"
        "<article><h1>A &amp; B</h1><p>One <b>bo</b>ld&nbsp;\n word.<p>Two<br>lines</article><footer>&copy; us</footer>",
        "A & B One bold word. Two lines",
    ),
    "advert inside": (
        "<body><article><p>Start.</p><div class='ad-box'>" + "buy now " * 60 + "</div><p>The end.</p></article></body>",
        "Start. The end.",
    ),
    "unmarked page": (
        "<body><div id=top-menu><a>a</a> <a>b</a></div><div id=content><h2>Head</h2><p>" + "text " * 30 + "</p><form>Name <input></form><p>More text here.</p></div>"
        "<div class=sidebar>Links and links</div><section id=comments><p>" + "nice post " * 40 + "</p></section><footer>end</footer></body>",
        "Head " + "text " * 30 + "More text here.",
    ),
    "wrapped": ("<div class='page nav-open'><main><p>Inside.</p><aside>no</aside></main></div>", "Inside."),
    "decoded once": ("<p>&amp;lt;b&amp;gt; &#x41;&lt;i&gt;</p>", "&lt;b&gt; A<i>"),
    "hidden": ("<article><p>Seen.</p><p hidden>Not.</p><div style='display: none'>Nor.</div><!-- no --><p>Also.</p></article>", "Seen. Also."),
    "remarks as articles": ("<article><p>Story text.</p></article><div class=comments><article><p>me too</p></article></div>", "Story text."),
    "quoted": ("<article><p title='a > b'>Fine.</p></article>", "Fine."),
}


@pytest.mark.parametrize("name", PAGES)
def test_extract(name):
    page, want = PAGES[name]
    learned = html.Weights.learn(Counter(plain=5000, p=90, h1=10), Counter(plain=60, marked=3000, links=50, li=300, nav=20, footer=20, div=30))
    for weights in (html.Weights.learn(Counter(), Counter()), learned):
        assert html.extract(page, weights) == want


@pytest.mark.parametrize("seed", range(4))
def test_best_run(seed):
    rng = random.Random(seed)
    scores = [rng.randint(-4, 3) + 0.0 for _ in range(25)]
    begin, end = html.best_run(scores)
    best = max(sum(scores[i:j]) for i in range(26) for j in range(i, 26))
    assert sum(scores[begin:end]) == max(0, best)


def test_main_text_rows(spark):
    rows = [(i, "u", p) for i, (p, _) in enumerate(PAGES.values())] * 2 + [(99, None, "<p>" + LONG + "</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = html.main_text(pages, html.fit(pages)).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert next(r.text for r in got if r.page_id == 99) == LONG
    assert html.main_text(pages.limit(0), html.fit(pages.limit(0))).count() == 0


# 7 SimHash


def plain_fingerprint(t):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts(seed):
    rng = random.Random(seed)
    texts = [sentence(rng, 120, 5000) for _ in range(60)]
    for base in texts[:20]:
        for _ in range(3):
            w = base.split()
            w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    return texts + texts[:5] + [None, "", "  ", "A b", "a B", "É", "é", LONG]


def test_near_duplicates(spark):
    texts = near_texts(13)
    prints = [plain_fingerprint(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    roots = union_find(pairs)
    want = {i: (f"{prints[i]:016x}", roots.get(i, i)) for i in range(len(texts))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    assert got == want
    kept = simhash.keep_first(docs_of(spark, texts)).collect()
    assert sorted(r.doc_id for r in kept) == sorted({c for _, c in want.values()})


@pytest.mark.parametrize("spread", [3, 64])
def test_tree_finds_every_link(spark, spread):
    """Small leaves, so that many pairs lie in different ones; dense and even fingerprints."""
    rng = np.random.default_rng(spread)
    centre = rng.integers(0, 2**63, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (3000, spread), dtype=np.uint64)) if spread < 64 else rng.integers(0, 2**63, (3000, 1), dtype=np.uint64)
    fps = np.unique(centre ^ np.bitwise_xor.reduce(flips, axis=1))
    fps = np.unique(np.concatenate([fps, fps[:500] ^ np.uint64(5), fps[:100] ^ np.uint64(1)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    links = [(r.x, r.y) for r in simhash.links(df, leaf=64).collect()]
    assert len(links) < 40 * len(fps)
    signed = fps.view(np.int64).tolist()
    close = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    pairs = [(signed[i], signed[j]) for i, j in zip(*np.nonzero(np.triu(close, 1)))]
    assert all((np.uint64(a & (2**64 - 1)) ^ np.uint64(b & (2**64 - 1))).bit_count() <= 2 for a, b in links)
    assert union_find(links) == union_find(pairs)


def test_simhash_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == len(ODD_ROWS)
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {2}
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in kept.collect())[1] == 1
    assert simhash.keep_first(no_docs).count() == 0


# 8 quality


def test_quality_learns_and_repeats(spark):
    rng = random.Random(17)
    good = [sentence(rng, 40) for _ in range(150)]
    bad = [" ".join(w + "%%%" for w in sentence(rng, 40).split()) for _ in range(60)]
    docs = docs_of(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(210)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels.filter("doc_id is null or doc_id % 5 != 0"))
    again = quality.fit(docs.repartition(3), labels.filter("doc_id is null or doc_id % 5 != 0"))
    assert np.array_equal(model.weight, again.weight) and model.bias == again.bias
    rows = quality.scored(docs, model).collect()
    assert all(r.predicted == int(r.doc_id < 150) == int(r.score >= 0.3) for r in rows)


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (6, 0), (8, 1)], "doc_id long, quality int")
    for model in (quality.fit(odd_docs, labels), quality.fit(odd_docs, labels.limit(0)), quality.fit(odd_docs, labels.filter("quality = 1"))):
        rows = quality.scored(odd_docs, model).collect()
        assert len(rows) == len(ODD_ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert quality.scored(no_docs, model).count() == 0


def test_text_with_zero_characters():
    model = quality.Model(np.ones(quality.BUCKETS, np.float32), 0.0)
    assert model.score(["a\0b", "\0"])[1] == 0.5


# 9 passages


def shared_runs(texts, least):
    """Documents that share a run of ``least`` words with an earlier one, by brute force."""
    first, late = {}, set()
    for i, t in enumerate(texts):
        w = (t or "").split()
        for j in range(len(w) - least + 1):
            run = tuple(w[j : j + least])
            if first.setdefault(run, i) != i:
                late.add(i)
    return late


def test_passages_are_cut_once(spark):
    rng = random.Random(19)
    texts = [sentence(rng, 200, 3000) for _ in range(80)]
    planted = [sentence(rng, n, 3000) for n in (60, 75, 120)]
    for i in range(20, 50):
        w = texts[i].split()
        at = rng.randrange(len(w))
        texts[i] = " ".join(w[:at] + [planted[i % 3]] + w[at:])
    short = sentence(rng, 25, 3000)
    for i in range(50, 70):
        texts[i] = texts[i] + "\n" + short
    rows = {r.doc_id: r for r in passages.cleaned(docs_of(spark, texts)).collect()}
    late = shared_runs(texts, 51)
    assert {i for i, r in rows.items() if r.n_removed} == late == set(range(23, 50))
    assert all(rows[i].text == texts[i] for i in rows if i not in late)
    assert not shared_runs([rows[i].text for i in range(80)], 51)
    for i in late:
        assert 20 + (i - 20) % 3 in rows[i].repeats_of
        assert rows[i].n_words - rows[i].n_removed == len(rows[i].text.split())
        size = len(planted[i % 3].split())
        assert size - 3 * passages.STEP < rows[i].n_removed <= size + 2


def test_similar_lines_are_cut(spark):
    rng = random.Random(23)
    base = [sentence(rng, 100, 3000) for _ in range(10)]
    texts = list(base)
    for i, b in enumerate(base):
        w = b.split()
        for _ in range(1 + 10 * (i >= 5)):
            w[rng.randrange(100)] = f"edit{rng.random()}"
        texts.append("intro words\n" + " ".join(w) + "\noutro words")
    rows = {r.doc_id: r for r in passages.cleaned(docs_of(spark, texts)).collect()}
    grams = lambda t: {tuple(t.split()[i : i + 5]) for i in range(96)}
    for i in range(10):
        a, b = grams(base[i]), grams(texts[10 + i].split("\n")[1])
        if len(a & b) / len(a | b) >= 0.8:
            # Repeated words that adjoin the line may go with it.
            assert rows[10 + i].n_removed >= 100 and set(rows[10 + i].text.split()) <= {"intro", "words", "outro"}
        assert rows[i].n_removed == 0


def test_copies_become_empty_and_go(spark):
    rng = random.Random(29)
    base = sentence(rng, 90, 3000)
    docs = docs_of(spark, [base, base, "short text", "short text", None, ""])
    assert [r.n_removed for r in passages.cleaned(docs).orderBy("doc_id").collect()] == [0, 90, 0, 0, 0, 0]
    assert [r.doc_id for r in passages.deduplicated(docs).orderBy("doc_id").collect()] == [0, 2, 3, 4, 5]


def test_run_hashes():
    words = passages.Words("a b c a b c d a b")
    starts, ends = np.array([0, 3, 7, 1]), np.array([2, 5, 9, 3])
    h = words.runs(starts, ends)
    assert h[0] == h[1] == h[2] != h[3]


def test_passages_odd_rows(odd_docs, no_docs):
    rows = passages.cleaned(odd_docs)
    assert rows.count() == len(ODD_ROWS)
    assert {r.text for r in rows.collect()} == {t for _, t, _, _ in ODD_ROWS}
    assert passages.deduplicated(odd_docs).columns == odd_docs.columns
    assert passages.deduplicated(odd_docs).count() == len(ODD_ROWS)
    assert passages.deduplicated(no_docs).count() == 0


# 10 tokens

TRICKY = [
    "a  b\n\n c\t\td   ",
    "<|endoftext|> and x<|endoftext|>y",
    "it's they'll don't  'twas",
    "   a    b c \x0b\x0c d \x1c e",
    "1234 abc123 ￼ 😀😀 漢字 é",
    " lead", "trail ", "\r\n\r\nx\r", "    four", "", "\n", "a​b c",
]


def test_token_counts_match_the_library(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_tokenizer())
    rng = random.Random(31)
    texts = TRICKY + ["".join(rng.choice(TRICKY + [" ", "\n", "x", "'s", "!"]) for _ in range(12)) for _ in range(300)] + [LONG]
    got = {r.doc_id: r for r in tokens.token_counts(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = len(plain.encode(t, add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (want, len(t.encode()), want > 512), t


def test_tokens_odd_rows(odd_docs, no_docs):
    rows = tokens.token_counts(odd_docs).collect()
    assert len(rows) == len(ODD_ROWS)
    assert {(r.n_bytes, r.n_tokens) for r in rows if r.doc_id in (2, 3)} == {(0, 0)}
    assert tokens.token_counts(no_docs).count() == 0


def test_tokens_forget(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    counted = tokens.Lengths(tokens.default_tokenizer())
    assert list(counted.of(["a b c d", "e f g h", "a b"])) == [4, 4, 2]


def test_repeated_words_are_passages_too(spark):
    rng = random.Random(37)
    junk = [f"{sentence(rng, 60, 3000)} {'so ' * n}{sentence(rng, 60, 3000)}" for n in (80, 70, 20)]
    rows = {r.doc_id: r for r in passages.cleaned(docs_of(spark, junk)).collect()}
    assert rows[0].n_removed == rows[2].n_removed == 0 and rows[1].n_removed >= 50
    assert not shared_runs([rows[i].text for i in range(3)], 51)
