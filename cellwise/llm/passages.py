"""Substring dedup: paragraph MinHash banding, exact Jaccard, and removal by components.

A passage is removed from every document but the first that has it, by id. What may be one is found
in two ways:

* Lines of ``PASSAGE`` words or more, and paragraphs and windows of shorter lines, get a MinHash
  signature over their shingles of five words, cut into bands. Lines that agree in a band are
  compared with the band's representative, and where that leaves several components with each other,
  exactly, by Jaccard similarity; similar lines become components.
* Passages inside of other text: a document is cut into short paragraphs at words that their
  neighbourhood alone chooses, so a passage is cut alike wherever it stands. Cuts with equal
  neighbourhoods collide in a single band, the hash of those words. Around each such cut, windows of
  ``PASSAGE`` words are laid alike in every document that has it; a window goes where one earlier
  document holds it as a whole, word for word. So text put together from several earlier documents
  stays, unless a piece of it that is long enough stands in one of them.

What is cut is the union of such lines and windows. Exchanges carry hashes and places, never texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.llm.components import components
from cellwise.session import broadcast_rows, partitions, small, written

SHINGLE = 5
SIMILARITY = 0.8
# Bands of rows: at a similarity of 0.8 a pair collides with probability 1 - (1 - 0.8^2)^7 = 0.999.
BANDS, ROWS = 7, 2
# Shorter repeats stay.
PASSAGE = 40
# Windows begin at a cut, and so many words before it: a repeat of PASSAGE + STEP - 1 words or more
# that holds a cut with its neighbourhood holds one of its windows, and all but STEP - 1 words at
# each end are in some window.
STEP = 10
OFFSETS = range(0, PASSAGE + 1, STEP)
# Bits of a line's sketch, in words of 64.
SKETCH_BITS = 256
SKETCH = [f"bits{i}" for i in range(SKETCH_BITS // 64)]
# A paragraph begins at a word whose hash is the least among so many before and after it.
RADIUS = 8
LONGEST = 12
# Words that are hashed at once, but for the last text's.
AT_ONCE = 1 << 16
WORD = re.compile(r"\S+")
# The same words for Spark's regular expressions.
BLANK_FREE = r"(?U)[^\s\x1c-\x1f]+"
KEY = ["doc", "row"]
ODD = np.uint64(0x9E3779B97F4A7C15)
_PERMUTATIONS = (np.cumprod(np.full(BANDS * ROWS, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64) | np.uint64(1))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Hashes of the words of some texts, one text after the other, and of any run of words of a text.

    Numpy's calls cost more than their work on one short text, so a task hands over many at once.
    """

    def __init__(self, *texts: str | list[str]) -> None:
        from xxhash import xxh64_intdigest

        split = [t.split() if isinstance(t, str) else t for t in texts]
        # Where texts begin, and where the last one ends.
        self.bounds = np.cumsum([0, *map(len, split)])
        self.n = int(self.bounds[-1])
        self.h = np.fromiter(map(xxh64_intdigest, chain.from_iterable(split)), np.uint64, self.n)
        # Prefix sums of h[i] * ODD^i; a run's sum is shifted to start at power 0.
        powers = np.ones(self.n + 1, np.uint64)
        np.cumprod(np.full(self.n, ODD, np.uint64), out=powers[1:])
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(self.h * powers[:-1], out=self.sums[1:])
        self.inverse = np.ones(self.n + 1, np.uint64)
        np.cumprod(np.full(self.n, pow(int(ODD), -1, 1 << 64), np.uint64), out=self.inverse[1:])

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words start..end-1, for each pair; equal runs have equal hashes."""
        # Multiplying by the power that is missing brings all runs to the same one.
        lifted = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mixed(lifted + (end - start).astype(np.uint64))

    def text_of(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def cuts(self) -> np.ndarray:
        """First words of the paragraphs, every text's own first word included.

        Words that repeat at short distances, such as one word a hundred times, have no least
        one among them; there, every ``LONGEST`` words begin a paragraph.
        """
        h, n, text = self.h, self.n, self.text_of()
        chosen = np.ones(n, bool)
        for d in range(1, min(RADIUS, n - 1) + 1):
            less, apart = h[d:] < h[:-d], text[d:] != text[:-d]
            chosen[d:] &= less | apart
            chosen[:-d] &= ~less | apart
        chosen[self.bounds[:-1][np.diff(self.bounds) > 0]] = True
        first = np.flatnonzero(chosen)
        length = np.diff(np.append(first, n))
        parts = np.maximum(1, length // LONGEST)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        return np.repeat(first, parts) + nth * LONGEST

    def shingles(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of each line, sorted, one line after the other, and where lines begin
        and the last one ends; a line shorter than a shingle is one.
        """
        size = np.minimum(SHINGLE, end - start)
        several = end - start - size + 1
        at = np.cumsum(np.append(0, several))
        first = np.arange(at[-1]) + np.repeat(start - at[:-1], several)
        found = self.runs(first, first + np.repeat(size, several))
        for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
            found[i:j].sort()
        new = np.append(True, found[1:] != found[:-1])
        new[at[:-1]] = True
        return found[new], np.append(np.cumsum(new)[at[:-1]] - 1, new.sum())


def bands(shingled: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One hash per band of each line, of the least shingles under its permutations."""
    least = [np.minimum.reduceat(shingled * p, at[:-1]) for p in _PERMUTATIONS]
    out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(at) - 1, 1))
    for r in range(ROWS):
        out = mixed(out + np.stack(least[r::ROWS], axis=1))
    return out


def lines_of(text: str) -> Iterator[tuple[int, int]]:
    """First and last-but-one word of every line that is long enough, and of every paragraph of
    shorter lines.

    A paragraph is a block of lines without a blank one between them. Shorter blocks that follow
    each other, and blocks of over ``3 * PASSAGE`` words, are cut into windows of lines.
    """
    return _places(_split_lines(text))


def _split_lines(text: str) -> list[list[str]]:
    return [line.split() for line in text.split("\n")]


def _places(lines: list[list[str]]) -> Iterator[tuple[int, int]]:
    at = 0
    block: list[tuple[int, int, int]] = []
    several: list[tuple[int, int, int]] = []
    for line in [*lines, None]:
        words = line or []
        n = len(words)
        if 0 < n < PASSAGE:
            block.append((at, at + n, zlib.crc32(" ".join(words).encode("utf-8", "surrogatepass"))))
            at += n
            continue
        if block:
            first, last = block[0][0], block[-1][1]
            if last - first < PASSAGE:
                several += block
            else:
                yield first, last
                yield from _windows(several)
                several = []
                if last - first > 3 * PASSAGE:
                    yield from ((s, e) for s, e in _windows(block) if 2 * (e - s) <= last - first)
            block = []
        if n or line is None:
            yield from _windows(several)
            several = []
        if n:
            yield at, at + n
        at += n


def _windows(lines: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Consecutive lines (start, end, hash) cut at those of the least hash among all that begin
    within ``PASSAGE`` words, so the cuts move with the content and no window is shorter.

    What precedes the first cut is a window too, if it is long enough.
    """
    if not lines or lines[-1][1] - lines[0][0] < PASSAGE:
        return
    cuts = [lines[0][0]]
    low = 0
    for i, (start, _, own) in enumerate(lines):
        while start - lines[low][0] >= PASSAGE:
            low += 1
        if any(h <= own for _, _, h in lines[low:i]):
            continue
        high = i + 1
        while high < len(lines) and lines[high][0] - start < PASSAGE and lines[high][2] >= own:
            high += 1
        if (high == len(lines) or lines[high][0] - start >= PASSAGE) and start > cuts[-1]:
            cuts.append(start)
    cuts.append(lines[-1][1])
    yield from ((s, e) for s, e in zip(cuts, cuts[1:]) if e - s >= PASSAGE)


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def _taken(batch: pa.RecordBatch, index: np.ndarray) -> list[pa.Array]:
    at = pa.array(index, pa.int64())
    return [batch.column(c).take(at) for c in KEY]


def _lists(values: np.ndarray) -> pa.ListArray:
    """The rows of ``values`` as lists."""
    n, width = values.shape
    offsets = pa.array(np.arange(0, width * n + 1, width), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(_signed(values.ravel())))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each long line, with ``bands``, and for each paragraph, with ``windows`` (0: none).

    Both have their place and a hash: a line's of its shingles, a paragraph's of the words around the
    cut with which it begins.
    """
    for batch in batches:
        rows, texts, n = [], [], 0
        for begin in range(0, batch.num_rows, 256):
            for i, text in enumerate(batch.slice(begin, 256).column("text").to_pylist(), begin):
                lines = _split_lines(text or "")
                n_words = sum(map(len, lines))
                if n_words < PASSAGE:
                    continue
                rows.append(i)
                texts.append(lines)
                n += n_words
                if n >= AT_ONCE:
                    yield from _pieces_of(batch, np.array(rows), texts)
                    rows, texts, n = [], [], 0
        if rows:
            yield from _pieces_of(batch, np.array(rows), texts)


def _pieces_of(batch: pa.RecordBatch, rows: np.ndarray, texts: list[list[list[str]]]) -> Iterator[pa.RecordBatch]:
    """The pieces of ``texts``, split into lines and words, which stand in ``rows`` of the batch."""
    words = Words(*[list(chain.from_iterable(lines)) for lines in texts])
    begin = words.bounds[:-1]
    found = [np.array(list(_places(lines)), np.int64).reshape(-1, 2) for lines in texts]
    text = np.repeat(np.arange(len(texts)), [len(f) for f in found])
    places = np.concatenate(found)
    if len(places):
        sets, at = words.shingles(places[:, 0] + begin[text], places[:, 1] + begin[text])
        yield _piece_rows(batch, rows[text], places[:, 0], places[:, 1], _shingle_hashes(sets, at), "bands", bands(sets, at))
    start = words.cuts()
    end = np.append(start[1:], words.n)
    text = words.text_of()[start]
    low, high = begin[text], words.bounds[1:][text]
    first = start[:, None] - np.array(OFFSETS)
    there = (first >= low[:, None]) & (first + PASSAGE <= high[:, None])
    first = np.where(there, first, 0)
    laid = np.where(there, words.runs(first, np.where(there, first + PASSAGE, 0)), np.uint64(0))
    around = words.runs(np.maximum(start - RADIUS, low), np.minimum(start + RADIUS + 1, high))
    yield _piece_rows(batch, rows[text], start - low, end - low, around, "windows", laid)


def _piece_rows(
    batch: pa.RecordBatch, rows: np.ndarray, start: np.ndarray, end: np.ndarray, own: np.ndarray, name: str, listed: np.ndarray
) -> pa.RecordBatch:
    numbers = _lists(listed)
    both = {"bands": pa.nulls(len(numbers), numbers.type), "windows": pa.nulls(len(numbers), numbers.type)} | {name: numbers}
    columns = [*_taken(batch, rows), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(_signed(own))]
    return pa.RecordBatch.from_arrays([*columns, *both.values()], names=[*KEY, "start", "end", "hash", *both])


def _shingle_hashes(shingled: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of each line's set of shingles: lines with equal sets are one node."""
    return mixed(np.add.reduceat(mixed(shingled), at[:-1]) + np.diff(at).astype(np.uint64))


def sketch(shingled: np.ndarray) -> np.ndarray:
    """Bits that say for each remainder of hashes whether an odd number of them has it.

    Two sets differ in at least as many elements as their sketches in bits.
    """
    odd = np.bincount((shingled & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of the lines asked for, and their sketches."""
    for batch in batches:
        hashes, sets, bits = [], [], []
        for text, places in zip(batch.column("text").to_pylist(), batch.column("places").to_pylist()):
            start, end = (np.array([place[k] for place in places], np.int64) for k in ("start", "end"))
            shingled, at = Words(text).shingles(start, end)
            for place, i, j in zip(places, at[:-1], at[1:]):
                sets.append(_signed(shingled[i:j]).tolist())
                bits.append(sketch(shingled[i:j]))
                hashes.append(place["hash"])
        columns = [pa.array(hashes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
        columns += [pa.array(b) for b in np.array(bits, np.int64).reshape(-1, len(SKETCH)).T]
        yield pa.RecordBatch.from_arrays(columns, names=["hash", "shingles", *SKETCH])


def similar_lines(texts: DataFrame, lines: DataFrame) -> DataFrame:
    """Pairs (``x``, ``y``) of line hashes that lead from each line to all similar ones.

    Each is of a Jaccard similarity of ``SIMILARITY`` or more, or of two lines joined by such pairs.

    Within a bucket of a band all are compared with one representative, which joins large groups
    at the cost of one pair a line and band at most. Lines of buckets that are still of several
    components meet the line in the middle of the bucket, and what is of several components even then
    meets across these by ``shared_prefixes``, so no similar pair of a bucket stays apart.
    """
    nodes = lines.select("hash", F.posexplode("bands").alias("band", "value")).distinct()
    # The representative of a band differs from band to band, so most groups are joined by one.
    shared = nodes.groupBy("band", "value").agg(
        F.min_by("hash", F.xxhash64("hash", "value")).alias("y"),
        F.min("hash").alias("low"),
        F.max("hash").alias("high"),
        F.count("*").alias("size"),
    )
    shared = shared.filter("low != high").select("band", "value", "y", "size")
    members = nodes.join(shared, ["band", "value"]).select("band", "value", "hash", "y", "size")
    members = written(members, "line-members")
    wanted = members.select("hash").distinct()
    first = lines.join(wanted, "hash", "left_semi").groupBy("hash").agg(F.min(F.struct(*KEY, "start", "end")).alias("p"))
    places = first.groupBy("p.doc", "p.row").agg(F.collect_list(F.struct("hash", "p.start", "p.end")).alias("places"))
    places = written(places, "line-places")
    # A text has as many places as lines; each takes some 20 bytes.
    n_places = places.agg(F.sum(F.size("places") + 2)).first()[0] or 0
    found = texts.join(small(places, n_places), KEY).select("text", "places")
    schema = "hash long, shingles array<long>, " + ", ".join(f"{c} long" for c in SKETCH)
    sets = written(found.mapInArrow(_shingled, schema).dropDuplicates(["hash"]), "line-shingles")
    near = written(_similar_to_representatives(members, sets), "similar-lines")
    # A bucket of two has been compared whole.
    joined = written(components(near, "x", "y"), "line-components")
    # A bucket of two has been compared whole.
    members = members.filter("size > 2")
    mixed = several_components(members, joined)
    # What is empty starts no further jobs: each takes memory of the driver, however small its input.
    if not mixed.isEmpty():
        central = written(_similar(middle_pairs(mixed, sets), sets), "similar-central")
        if not central.isEmpty():
            stars = joined.select(F.col("node").alias("x"), F.col("component").alias("y"))
            joined = written(components(stars.union(central), "x", "y"), "line-components")
            mixed = several_components(members, joined)
    found = joined.filter("node != component").select(F.col("node").alias("x"), F.col("component").alias("y"))
    if mixed.isEmpty():
        return found
    apart = written(mixed.select("hash", "component").distinct(), "lines-apart")
    return found.union(_similar(shared_prefixes(sets.join(apart, "hash")), sets))


def several_components(members: DataFrame, joined: DataFrame) -> DataFrame:
    """``band``, ``value``, ``hash`` and ``component`` of the lines of buckets of several components."""
    named = members.join(joined, members["hash"] == joined["node"], "left")
    named = named.select("band", "value", "hash", F.coalesce("component", "hash").alias("component"))
    ends = named.groupBy("band", "value").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return written(named.join(ends.filter("low != high").select("band", "value"), ["band", "value"]), "mixed-buckets")


def middle_pairs(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Each line of a bucket with the line in the middle of that bucket, if of another component.

    In the middle is the line whose shingles most other lines have on average, which in a group of
    near copies is the one with the fewest edits. These pairs only spare others: lines that stay apart
    all the same are compared by ``shared_prefixes``.
    """
    each = sets.join(mixed.select("hash").distinct(), "hash").select("hash", F.explode("shingles").alias("s"))
    each = written(each, "mixed-shingles")
    common = each.groupBy("s").agg(F.count("*").alias("lines")).filter("lines > 1")
    n = sets.select("hash", F.size("shingles").alias("n"))
    central = each.join(common, "s").groupBy("hash").agg(F.sum("lines").alias("lines")).join(n, "hash")
    central = central.select("hash", (F.col("lines") / F.col("n")).alias("centrality"))
    named = written(mixed.join(central, "hash"), "central")
    most = F.max(F.struct("centrality", "hash", "component"))
    middle = named.groupBy("band", "value").agg(most.alias("m")).select(
        "band", "value", F.col("m.hash").alias("y"), F.col("m.component").alias("y_component")
    )
    met = named.join(middle, ["band", "value"]).filter("component != y_component")
    return met.select(F.col("hash").alias("x"), "y").distinct()


def _similar_to_representatives(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that lead from each line to the representatives of its bands that are similar to it.

    A line asks the representative of its largest bucket first, which does the same, so answers lead
    to ever larger buckets. A pair whose ends are led to one line would join nothing anew and is not
    compared; of a large group of near copies that leaves about one pair a line.
    """
    largest = F.max(F.struct("size", "y")).getField("y").alias("asked")
    asked = members.groupBy(F.col("hash").alias("x")).agg(largest, F.collect_set("y").alias("ys"))
    asked = written(asked, "first-asked")
    found = _similar(asked.filter("x != asked").select("x", F.col("asked").alias("y")), sets)
    found = written(found, "first-similar")
    led = written(asked.join(found, "x", "left").select("x", "asked", "ys", F.coalesce("y", "x").alias("x_led")), "led")
    for _ in range(2):
        further = led.select(F.col("x").alias("x_led"), F.col("x_led").alias("next"))
        led = written(led.join(further, "x_led").select("x", "asked", "ys", F.col("next").alias("x_led")), "led")
    others = F.filter("ys", lambda y: ~y.isin(F.col("x"), F.col("asked"), F.col("x_led")))
    rest = led.select("x", "x_led", F.explode(others).alias("y"))
    # Lines of a group ask the same few, so it is decided once for all of them who is still open.
    ends = rest.select("x_led", "y").distinct().join(led.select(F.col("x").alias("y"), F.col("x_led").alias("y_led")), "y")
    still = ends.filter("x_led != y_led").select("x_led", "y")
    return found.union(_similar(rest.join(still, ["x_led", "y"]).select("x", "y"), sets))


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose shingles are similar."""
    x, y = (sets.select(F.col("hash").alias(n), F.col("shingles").alias(f"{n}_set")) for n in ("x", "y"))
    both = pairs.join(x, "x").join(y, "y")
    common = F.size(F.array_intersect("x_set", "y_set"))
    return both.filter(common >= SIMILARITY * (F.size("x_set") + F.size("y_set") - common)).select("x", "y")


def shared_prefixes(sets: DataFrame) -> DataFrame:
    """Pairs (``x``, ``y``) that hold all similar ones of different ``component``, and few others.

    Two similar sets share an element among the rarest of each: a fifth of the larger one's and a
    ninth of the smaller one's (Xiao et al., 2008). Elements of one component only come first in
    that order and link nothing, so lines that share a template and no more meet nobody. Of those
    that meet, the sketches tell nearly all that differ too much, before a pair is made.
    """
    size = F.size("shingles").alias("n")
    own = ["hash", "component", "n", *SKETCH]
    each = written(sets.select("hash", "component", size, *SKETCH, F.explode("shingles").alias("s")), "shingle-rows")
    common = each.groupBy("s").agg(
        F.count("*").alias("lines"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    common = common.filter("low != high").select("s", "lines")
    # A line has at most as many of them as shingles.
    ranked = each.join(common, "s").groupBy(*own).agg(
        F.sort_array(F.collect_list(F.struct("lines", "s"))).alias("common")
    )

    def rarest(share: float) -> Column:
        needed = F.ceil(F.lit(share) * F.col("n") - F.lit(1e-9)).cast("int")
        return F.slice("common", F.lit(1), F.greatest(F.size("common") - needed + 1, F.lit(0)))

    both = 2 * SIMILARITY / (1 + SIMILARITY)
    ranked = ranked.select(*own, rarest(SIMILARITY).alias("larger"), rarest(both).alias("smaller"))
    ranked = written(ranked.filter(F.size("larger") > 0), "rarest-shingles")

    def side(name: str, prefix: str) -> DataFrame:
        rows = ranked.select("*", F.explode(prefix).alias("p"))
        return rows.select(F.col("p.s").alias("s"), *[F.col(c).alias(f"{name}_{c}") for c in own])

    met = side("x", "larger").join(side("y", "smaller"), "s")
    met = met.filter(f"x_component != y_component AND y_n <= x_n AND y_n >= {SIMILARITY} * x_n")
    differ = " + ".join(f"bit_count(x_{c} ^ y_{c})" for c in SKETCH)
    met = met.filter(f"({differ}) * {1 + SIMILARITY} <= {1 - SIMILARITY} * (x_n + y_n) + 1e-9")
    return met.select(F.col("x_hash").alias("x"), F.col("y_hash").alias("y")).distinct()


def dealt(df: DataFrame, n: int) -> DataFrame:
    """``df`` of ``n`` rows, which grow with the corpus: to be shuffled at any size, not broadcast."""
    spark = df.sparkSession
    return df.hint("shuffle_hash" if n / partitions(spark) <= broadcast_rows(spark) else "merge")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``doc``, ``row`` and ``runs`` (start, end, firsts) of what stands in an earlier document.

    ``texts`` has the columns doc, row (a hash of the text) and text. ``firsts`` are the documents
    in which the parts of a run stand first.
    """
    schema = texts.select(*KEY).schema
    typed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    made = f"{typed}, start int, end int, hash long, bands array<long>, windows array<long>"
    pieces = written(texts.mapInArrow(_pieces, made), "pieces")
    lines = pieces.filter("bands IS NOT NULL").drop("windows")
    # Lines: nodes by content, components by similarity, all but the first document give way.
    alike = components(similar_lines(texts, lines), "x", "y")
    named = lines.join(alike, lines["hash"] == alike["node"], "left").select(
        *KEY, "start", "end", F.coalesce("component", "hash").alias("component")
    )
    named = written(named, "named-lines")
    owners = named.groupBy("component").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    # Stored, so that a component of very many lines meets them in a plain join, which AQE splits.
    owners = written(owners.filter("first != last").select("component", "first"), "owners")
    later = named.join(small(owners, owners.count()), "component").filter("doc is null or doc != first")
    line_spans = later.select(*KEY, "start", "end", "first")

    # Most cuts stand in one document: two numbers of each tell, and only the others go on.
    parts = pieces.filter("windows IS NOT NULL").select(*KEY, "start", "hash", "windows")
    ends = parts.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    twice = written(ends.filter("first != last").select("hash"), "repeated")
    again = parts.join(dealt(twice, twice.count()), "hash").select(*KEY, "start", F.posexplode("windows").alias("nth", "window"))
    again = again.filter("window != 0").select(*KEY, (F.col("start") - F.col("nth") * STEP).alias("start"), "window")
    again = written(again, "windows")
    held = again.groupBy("window").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    held = written(held.filter("first != last").select("window", "first"), "repeated-windows")
    part_spans = again.join(dealt(held, held.count()), "window").filter("doc is null or doc != first").select(
        *KEY, "start", (F.col("start") + PASSAGE).alias("end"), "first"
    )
    # A document has at most so many spans per paragraph as there are offsets.
    spans = F.array_sort(F.collect_list(F.struct("start", "end", "first")))
    return (
        line_spans.unionByName(part_spans)
        .groupBy(*KEY)
        .agg(spans.alias("spans"))
        .select(*KEY, merged(F.col("spans")).alias("runs"))
    )


def merged(spans: Column) -> Column:
    """Sorted spans joined where they meet: an array of (start, end, firsts)."""

    def step(runs: Column, span: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        alone = F.struct(span["start"].alias("start"), span["end"].alias("end"), F.array(span["first"]).alias("firsts"))
        wider = F.struct(
            last["start"].alias("start"),
            F.greatest(last["end"], span["end"]).alias("end"),
            F.array_union(last["firsts"], F.array(span["first"])).alias("firsts"),
        )
        meets = (F.size(runs) > 0) & (span["start"] <= last["end"])
        before = F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0)))
        return F.when(meets, F.concat(before, F.array(wider))).otherwise(F.concat(runs, F.array(alone)))

    none = F.filter(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.array(s["first"]).alias("firsts"))),
        lambda s: F.lit(False),
    )
    return F.aggregate(spans, none, step)


def without(text: str, runs: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``runs``; a blank that parted them from the next word goes."""
    at = [m.start() for m in WORD.finditer(text)] + [len(text)]
    kept, done = [], 0
    for start, end in runs:
        kept.append(text[done : at[start]])
        done = at[min(end, len(at) - 1)]
    kept.append(text[done:])
    return "".join(kept).rstrip() if done == len(text) else "".join(kept)


def cleaned(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``docs`` with repeated passages cut out of the text, and what was cut.

    Adds ``n_words`` (before), ``n_removed`` and ``repeats_of`` (ids of the documents in which the
    passages stand first, sorted). Words are split at white space. Null, empty and short texts
    stay as they are; rows that share an id are one document and not cut for each other; a row
    with a null id is cut for any other, but none for it. Texts are read whole. The names of
    extra columns are kept, except that columns of these three names are replaced.
    """
    added = ("n_words", "n_removed", "repeats_of")
    kept = [c for c in docs.columns if c not in added]
    named = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    runs = repeated_spans(named.filter(F.col("text").isNotNull()))
    runs = written(runs.toDF("_doc", "_row", "_runs"), "runs")
    # A run and each document that it repeats has some 30 bytes.
    n_runs = runs.agg(F.sum(F.size("_runs") + F.size(F.flatten("_runs.firsts")))).first()[0] or 0
    runs = small(runs, n_runs)
    same = F.col(id_col).eqNullSafe(F.col("_doc")) & (F.xxhash64(text) == F.col("_row"))

    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for whole, starts, ends in batches:
            cut_texts = [without(t, list(zip(s, e))) for t, s, e in zip(whole, starts, ends)]
            yield pd.Series(cut_texts, dtype=object)

    n_words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(BLANK_FREE)).cast("long").alias("n_words")
    id_type = docs.schema[id_col].dataType.simpleString()
    none = F.expr("array()").cast(f"array<{id_type}>")
    # Texts without a repeat are most; they stay in the JVM.
    whole = docs.join(runs, same, "left_anti").select(
        *kept, n_words, F.lit(0).cast("long").alias("n_removed"), none.alias("repeats_of")
    )
    parts = docs.join(runs, same)
    shorter = F.pandas_udf(cut, "string")(F.col(text), F.col("_runs.start"), F.col("_runs.end"))
    n_removed = F.aggregate("_runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    firsts = F.array_sort(F.array_distinct(F.flatten(F.col("_runs.firsts"))))
    changed = parts.select(
        *[shorter.alias(text) if c == text else F.col(c) for c in kept],
        n_words,
        n_removed.alias("n_removed"),
        firsts.alias("repeats_of"),
    )
    return whole.unionByName(changed)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out, without those of which nothing but blanks is left.

    Documents that had no word to begin with stay.
    """
    columns = docs.columns
    plain = [c if c in ("doc_id", "text") else f"_c{i}" for i, c in enumerate(columns)]
    cut = cleaned(docs.toDF(*plain)).filter("n_removed = 0 or n_removed < n_words")
    return cut.select(*[F.col(p).alias(c) for p, c in zip(plain, columns)])
