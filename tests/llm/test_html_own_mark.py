"""Pages whose own mark is empty, on teasers only, or missing."""

from __future__ import annotations

from collections import Counter

import pytest

from cellwise.llm import html

WORDS = " ".join(["story text"] * 40)
STORY = f"<div><h2>Head</h2><p>{WORDS}</p></div>"
TEASER = "<article><h3>Other</h3><p>Read on there.</p></article>"
PAGES = {
    "empty main": (f"<body><nav><a>x</a></nav><main></main>{STORY}</body>", f"Head {WORDS}"),
    "teasers in an aside": (f"<body>{STORY}<aside>{TEASER * 3}</aside></body>", f"Head {WORDS}"),
    "teasers in a footer": (f"<body>{STORY}<footer>{TEASER * 3}</footer></body>", f"Head {WORDS}"),
    "no article": (f"<body><ul><li><a>x</a></ul>{STORY}</body>", f"Head {WORDS}"),
    "small article": (f"<body>{STORY}<article><a>x</a></article></body>", f"Head {WORDS}"),
    "article": (f"<body><div><p>Two words.</p></div><article>{STORY}</article></body>", f"Head {WORDS}"),
    "text between articles": (f"<article>{STORY}</article><p>More.</p><article>{STORY}</article>", f"Head {WORDS} More. Head {WORDS}"),
}


@pytest.mark.parametrize("name", PAGES)
def test_own_mark(name):
    page, want = PAGES[name]
    marked = html.Weights.learn(Counter(plain=90_000, p=900, h1=10), Counter(marked=8000, li=300, nav=20, footer=20, div=30))
    for weights in (html.Weights.learn(Counter(), Counter()), marked):
        assert html.extract(page, weights) == want
