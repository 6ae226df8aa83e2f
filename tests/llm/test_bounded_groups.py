"""Groups that grow with the data: rows without an id in the mix, leaves of the fingerprint tree."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cellwise.llm import mixing, simhash


def test_rows_without_an_id(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 40)), "s") for i in range(600)]
    rows += [(None, " ".join(["u"] * rng.randrange(1, 40)) + f" {i}", "s") for i in range(300)]
    rows += [(None, "the same seven words for all rows", "s")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, weights=(1,), share=0.5).collect()
    assert mixing.mix(docs).columns == ["doc_id", "size", "source_size", "target", "taken", "source"]
    assert len(got) == len(rows) and Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert abs(sum(r.taken for r in got) - got[0].target) <= 40
    # Rows without an id have draws of their own: some are taken, some are not.
    drawn = [r.taken > 0 for r in got if r.doc_id is None and r["size"] != 7]
    assert 0.3 < np.mean(drawn) < 0.7
    again = mixing.mix(docs.repartition(7), weights=(1,), share=0.5).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_copies_without_an_id_fill_a_budget(spark):
    rows = [(None, "a b c d e", "s")] * 101
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, weights=(1,), share=0.4).collect()
    # 202 of 505 words: 40 copies are 200, and a 41st would be farther off.
    assert Counter(r.taken for r in got) == {5: 40, 0: 61}


def test_slices_of_any_weight_are_thin(spark):
    keys = spark.range(200_000).selectExpr("-ln((id + 0.5) / 200000) as u")
    for weight in (1e-6, 0.5, 1.0, 2.0):
        cut = keys.selectExpr(f"floor(log2(u / {weight}) * {mixing.SLICES}) as slice").groupBy("slice").count()
        assert cut.agg({"count": "max"}).first()[0] <= 200_000 / 5_000


def components_of(fps, pairs):
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for x, y in pairs:
        a, b = sorted((root(x), root(y)))
        label[b] = a
    out = defaultdict(set)
    for f in fps:
        out[root(f)].add(f)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("leaf, most", [(64, 16), (1 << 20, 50), (64, 1 << 18)])
def test_leaves_in_blocks_lose_no_link(spark, leaf, most):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 62, 60, dtype=np.int64)
    fps = {int(b) for b in base}
    for b in base.tolist():
        at = b
        for _ in range(8):
            at ^= int(1 << rng.integers(0, 62)) | int(1 << rng.integers(0, 62))
            fps.add(int(at))
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = [(r.x, r.y) for r in simhash.links(df, leaf=leaf, most=most).collect()]
    true = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= simhash.DISTANCE]
    assert components_of(fps, found) == components_of(fps, true)
    assert all((x ^ y).bit_count() <= simhash.DISTANCE for x, y in found)
