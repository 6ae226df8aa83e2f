"""Attribute values of any length, and quotes that are never closed."""

from __future__ import annotations

import time
from collections import Counter

import pytest

from cellwise.llm import html

WEIGHTS = html.Weights.learn(Counter(), Counter())


@pytest.mark.parametrize("size", [10, 3_000, 5_000, 100_000])
@pytest.mark.parametrize("quote", ["'", '"'])
def test_values_of_any_length(size, quote):
    inner = "'" if quote == '"' else '"'
    value = f"{{{inner}id{inner}: {inner}<b>menu</b> hidden{inner}}} " * (1 + size // 30)
    page = f"<body><article><div data-props={quote}{value}{quote} class=advert><p>no</p></div>"
    page += f"<div data-state={quote}{value}{quote}><p>Fine text.</p></div></article></body>"
    assert html.extract(page, WEIGHTS) == "Fine text."


def test_open_quotes():
    assert html.extract("<article><p title=it's>One.</p><p title=\"x>Two.</p></article>", WEIGHTS) == "One. Two."


def test_time_is_linear():
    for unit in ("<a x='", '<a x="', "<a x=\"<a y='", "<a x= ", "<a '\" "):
        began = time.perf_counter()
        html.parse(unit * 20_000)
        assert time.perf_counter() - began < 5
