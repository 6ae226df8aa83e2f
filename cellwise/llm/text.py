"""Texts as arrays of code points: words, their boundaries, and hashed n-grams within them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np

CHUNK = 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def chunked(texts: Sequence[str], size: int = CHUNK) -> Iterator[list[str]]:
    """Consecutive texts of at most ``size`` characters together; a longer one comes alone."""
    batch: list[str] = []
    held = 0
    for text in texts:
        if batch and held + len(text) > size:
            yield batch
            batch, held = [], 0
        batch.append(text)
        held += len(text)
    if batch:
        yield batch


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def boundary_array(
    texts: Sequence[str],
    inside: np.ndarray,
    alone: Callable[[np.ndarray], np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """The words of ``texts`` as code points, with one 0 before, between and after them.

    ``inside`` says for every code point whether it belongs to a word; ``alone`` which of them
    are words by themselves. Also gives the number of the text of each word.
    """
    points = code_points("".join(texts))
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    letter = inside[points]
    starts_word = letter & ~np.concatenate([[False], letter[:-1]])
    first = np.cumsum(lengths)[:-1]
    first = first[first < len(points)]
    starts_word[first] |= letter[first]  # a text's first letter starts a word
    if alone is not None and len(points) and points.max() > 0x0E00:
        single = alone(points) & letter
        starts_word |= single | (np.concatenate([[False], single[:-1]]) & letter)
    at = np.flatnonzero(letter)
    begins = starts_word[at]
    # Each word start moves what follows by one place, for the boundary before it.
    place = np.arange(len(at)) + np.cumsum(begins)
    array = np.zeros(len(at) + int(begins.sum()) + 1, np.uint32)
    array[place] = points[at]
    text_of = np.searchsorted(np.cumsum(lengths), at[begins], side="right")
    return array, text_of


def word_starts(array: np.ndarray) -> np.ndarray:
    """Places of the boundaries before the words."""
    return np.flatnonzero(array[:-1] == 0)


def ngram_buckets(array: np.ndarray, orders: Sequence[int], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of the n-gram at each place, and whether there is one.

    An n-gram may begin or end with a boundary, but has none inside and is none alone.
    """
    values = array.astype(np.uint64)
    is_boundary = array == 0
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    rolling = np.zeros(len(array), np.uint64)
    inner = np.zeros(len(array), bool)  # a boundary strictly inside the n-gram so far
    for n in range(1, max(orders) + 1):
        reach = len(array) - n + 1
        if reach <= 0:
            return
        if n > 2:
            inner = inner[:reach] | is_boundary[n - 2 : n - 2 + reach]
        else:
            inner = inner[:reach]
        rolling = rolling[:reach] * _STEP + values[n - 1 : n - 1 + reach] + np.uint64(n)
        if n in orders:
            mixed = (rolling ^ (rolling >> np.uint64(29))) * _MIX
            valid = ~inner
            if n == 1:
                valid = valid & ~is_boundary
            elif n == 2:
                valid = valid & ~(is_boundary[:reach] & is_boundary[1 : 1 + reach])
            yield (mixed >> shift).astype(np.int64), valid
