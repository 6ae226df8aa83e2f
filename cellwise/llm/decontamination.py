"""Benchmark decontamination by winnowing, with DataFrame functions only.

A window of an item is ``N`` consecutive words; a shorter item is one window. Documents and items
are fingerprinted alike: of every ``SPAN`` consecutive hashes of ``K`` words the least one is
kept. As K + SPAN - 1 = N, any shared run of N words has a kept hash on both sides, so joining
fingerprints misses no document. The few documents that share one are then read once more, and
every one of their windows is looked up among the items' windows: hits are exact up to a collision
of two independent 64-bit hashes.

Items of fewer than N words are looked for by their least word hash, which their every occurrence
contains, against all distinct words of the documents.

Hashes for the search are taken of words in Unicode lower case, which joins at least what the
contract's lower case of A-Z joins; windows are compared by the latter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellwise.session import small, written

NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
N = 13
K = 6
ROW = ["row", "twin"]


def words_of(text: Column) -> Column:
    """Words of a text, case kept; null and wordless texts have none."""
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), NOT_WORD), lambda w: w != "")


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _grams(hashes: Column, k: int) -> Column:
    """Hashes of ``k`` consecutive elements; fewer elements have none."""
    last = F.size(hashes) - k
    gram = lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), gram)).otherwise(F.expr("array()").cast("array<long>"))


def _least_of(values: Column, n: int) -> Column:
    """Winnowing: the least of every ``n`` consecutive values, each once.

    Every run of ``n`` values holds one of them, chosen by that run alone.
    """
    last = F.size(values) - n
    least = lambda i: F.array_min(F.slice(values, i + 1, n))
    return F.when(last >= 0, F.array_distinct(F.transform(F.sequence(F.lit(0), last), least))).otherwise(
        F.expr("array()").cast("array<long>")
    )


def hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def windows(text: Column, lengths: Column) -> Column:
    """(pos, len, h1, h2) of every run of words with one of ``lengths``; ``text`` in lower case."""

    def at(words: Column, length: Column) -> Column:
        last = F.size(words) - length

        def one(i: Column) -> Column:
            run = F.concat_ws(" ", F.slice(words, i + 1, length))
            return F.struct(
                i.alias("pos"),
                length.alias("len"),
                F.xxhash64(run).alias("h1"),
                F.xxhash64(F.lit(N), run).alias("h2"),
            )

        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), one))

    of_length = lambda words: F.flatten(F.filter(F.transform(lengths, lambda n: at(words, n)), lambda x: x.isNotNull()))
    return _let(words_of(text), of_length)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = N,
    k: int = K,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """``id_col``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` per row.

    Null and wordless texts have no words and no hits; wordless items are in no text. Repeated
    rows are each returned with the same figures. Items with a null id count as hit words, but
    not as items. An item that occurs in several rows counts once by its id. Without items no
    word is hit. Other columns are not read.
    """
    spark = docs.sparkSession
    # A row is known by 128 bits of its id and text: equal rows have equal results.
    mark = [F.xxhash64(id_col, text).alias("row"), F.xxhash64(text, id_col).alias("twin")]
    rows = docs.select(F.col(id_col).alias("id"), *mark, words_of(F.col(text)).alias("words"))
    rows = rows.select("id", *ROW, "words", hashed(F.col("words")).alias("hashes"))

    items = items.select(F.col(item_id).alias("item"), _ascii_lower(F.col(item_text)).alias("text"))
    sized = items.select("item", "text", F.size(words_of(F.col("text"))).alias("n")).filter("n > 0")
    sized = sized.withColumns({"len": F.least("n", F.lit(n)).cast("int"), "hashes": hashed(words_of(F.col("text")))})
    sized = written(sized, "items")
    found = sized.select("item", F.explode(windows(F.col("text"), F.array("len"))).alias("w")).select("item", "w.h1", "w.h2", "w.len")
    item_windows = written(found.distinct(), "item-windows")
    lengths = sorted(r.len for r in sized.select("len").distinct().collect())  # at most n values

    # Fingerprints of the items, and for short items their least word.
    item_grams = sized.filter(F.col("len") == n).select(_grams(F.col("hashes"), k).alias("grams"))
    prints = written(item_grams.select(F.explode(_least_of(F.col("grams"), n - k + 1)).alias("print")).distinct(), "item-prints")
    short = sized.filter(F.col("len") < n).select(F.array_min("hashes").alias("print"))
    least = written(short.distinct(), "item-words")

    # ``rows`` computes hashes once: the grams refer to them by column.
    grams = rows.select("id", *ROW, F.size("words").cast("long").alias("n_words"), "hashes", _grams(F.col("hashes"), k).alias("grams"))
    candidates = (
        grams.select(*ROW, F.explode(_least_of(F.col("grams"), n - k + 1)).alias("print"))
        .join(small(prints, prints.count()), "print", "left_semi")
        .select(*ROW)
    )
    if any(length < n for length in lengths):
        by_word = (
            rows.select(*ROW, F.explode(F.array_distinct("hashes")).alias("print"))
            .join(small(least, least.count()), "print", "left_semi")
            .select(*ROW)
        )
        candidates = candidates.union(by_word)
    candidates = written(candidates.distinct(), "candidates")

    # Extend: all windows of the candidates against all windows of the items.
    n_candidates = candidates.count()
    again = docs.select(*mark, _ascii_lower(F.col(text)).alias("text")).join(
        small(candidates, n_candidates), ROW, "left_semi"
    )
    exploded = again.select(*ROW, F.explode(windows(F.col("text"), F.array(*[F.lit(x) for x in lengths]).cast("array<int>"))).alias("w"))
    looked_up = item_windows.select("h1", "h2", "len").distinct()
    hits = (
        exploded.select(*ROW, "w.*")
        .join(small(looked_up, looked_up.count()), ["h1", "h2", "len"], "left_semi")
        .groupBy(*ROW, "pos")
        .agg(F.max("len").alias("len"), F.collect_set(F.struct("h1", "h2")).alias("all"))
    )
    hits = written(hits, "hits")
    order = W.partitionBy(*ROW).orderBy("pos")
    before = F.max(F.col("pos") + F.col("len")).over(order.rowsBetween(W.unboundedPreceding, -1))
    covered = hits.select(*ROW, (F.col("pos") + F.col("len") - F.greatest("pos", F.coalesce(before, F.lit(0)))).alias("new"))
    n_hit = covered.groupBy(*ROW).agg(F.sum(F.greatest("new", F.lit(0))).cast("long").alias("n_hit"))
    seen = hits.select(*ROW, F.explode("all").alias("w")).select(*ROW, "w.h1", "w.h2").distinct()
    which = (
        seen.join(item_windows.select("h1", "h2", F.col("item").cast("string").alias("item")), ["h1", "h2"])
        .select(*ROW, "item")
        .distinct()
        .groupBy(*ROW)
        .agg(F.sort_array(F.collect_set("item")).alias("found"))
    )
    report = written(n_hit.join(which, ROW, "left"), "contamination")
    # A document may hold many items: they count as rows of their own.
    n_report = report.agg(F.sum(F.greatest(F.size("found"), F.lit(0)) + 1)).first()[0] or 0
    out = grams.select("id", *ROW, "n_words").join(small(report, n_report), ROW, "left")
    found_items = F.coalesce("found", F.expr("array()").cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        hit.alias("n_hit"),
        F.size(found_items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", found_items), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
        *extra,
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without its contaminated documents; rows that share an id are told apart by text."""
    judged = contamination(docs, items, extra=tuple(ROW))
    bad = written(judged.filter("contaminated").select(*[F.col(c).alias(f"_{c}") for c in ROW]).distinct(), "contaminated")
    same = (F.xxhash64("doc_id", "text") == F.col("_row")) & (F.xxhash64("text", "doc_id") == F.col("_twin"))
    return docs.join(small(bad, bad.count()), same, "left_anti")
