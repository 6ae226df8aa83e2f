"""Near-duplicate removal keeps one row of each component, whatever the ids."""

from __future__ import annotations

import random
from collections import Counter

from cellwise.llm import simhash
from tests.llm.test_operators import sentence


def test_one_row_of_each_component(spark):
    rng = random.Random(43)
    a, b, c, d, e, f = (sentence(rng, 120, 5000) for _ in range(6))
    rows = [
        *[(None, t, "x") for t in (a, b, b, c)],  # null ids: three texts, one of them twice
        (1, d, "x"), (1, e, "x"),  # a shared id of two unrelated texts
        (0, f, "x"), (1, f, "x"),  # a copy of an earlier document under an id that stays elsewhere
        (None, d, "x"),  # a null id gives way to any other
        (2, "", "x"), (2, None, "x"), (2, None, "y"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text or "") for r in kept.collect())
    assert got == Counter([(None, a), (None, b), (None, c), (1, d), (1, e), (0, f), (2, "")])
