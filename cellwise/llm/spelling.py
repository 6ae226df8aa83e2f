"""Spelling variants of words, by permuterm rotations.

A word with a terminator has a rotation for every split: what follows the split, the terminator,
what precedes it. Turned so that an edited letter comes last, two words that differ by that letter
alone share all the rest, so a near pair is a shared prefix of rotations:

- a replaced letter: both rotations without their last letter are equal;
- a letter more: the longer word's rotation without its last letter is the shorter word's rotation.

Rotations are sorted by that prefix, and a scan of each run of equal prefixes gives every word its
number of neighbours there and the best of them. A run holds the words of one pattern with one
letter open, and the word without it: never more than there are letters, whatever the corpus.
Taking a letter out of a row of equal letters gives the same word each time, so only the first of
such a row counts, and each near pair is met once.

A word's form is its most frequent near word, if that is frequent enough; the root follows forms to
the end. Frequencies grow by that factor with each step, so paths are short; they are halved in
rounds of joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellwise.session import removed, small, written

NOT_LETTER = r"[^A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERMINATOR = "\u0001"
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
ERRORS = 97
# Two words of a hash table's row; words of more letters are few.
PAIR_BYTES = 160


def with_errors(run: Column, doc_id: Column, one_in: int = ERRORS) -> Column:
    """``run`` without one letter, if the hash of its document and itself says so."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(key.cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % one_in == 0, cut).otherwise(run)


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    errors: int = ERRORS,
) -> DataFrame:
    """``word`` and ``n``, its occurrences, of the words of all texts that are long and frequent enough.

    Words are runs of Latin-1 letters in lower case (A-Z only), of which one in ``errors`` loses a
    letter. Null texts have none; a null id counts as an empty one. Rows that repeat count each
    time. Counts are added up before the exchange, so a frequent word is no hot key.
    """
    lowered = F.translate(F.col(text).cast("string"), UPPER, LOWER)
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.split(lowered, NOT_LETTER)).alias("run"))
    # One letter may go, and a run that is too short already cannot become long enough.
    runs = runs.filter(F.char_length("run") >= min_length)
    words = runs.select(with_errors(F.col("run"), F.col("id"), errors).alias("word"))
    counts = words.filter(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def _rotations(words: DataFrame) -> DataFrame:
    """``prefix``, ``word``, ``n`` and what the word is there: ``whole``, or with a letter ``open``.

    ``first`` says that the open letter does not follow an equal one; ``own`` marks one row a word.
    """
    length = F.char_length("word")
    word, end = F.col("word"), F.lit(TERMINATOR)
    after = lambda i: F.substring(word, i + 1, length)
    before = lambda i: F.substring(word, F.lit(1), i)
    letter = lambda i: F.substring(word, i, F.lit(1))
    whole = lambda i: F.struct(
        F.concat(after(i), end, before(i)).alias("prefix"), F.lit(False).alias("open"), F.lit(False).alias("first"), (i == 0).alias("own")
    )
    opened = lambda i: F.struct(
        F.concat(after(i), end, before(i - 1)).alias("prefix"),
        F.lit(True).alias("open"),
        ((i == 1) | (letter(i) != letter(i - 1))).alias("first"),
        F.lit(False).alias("own"),
    )
    every = F.concat(
        F.transform(F.sequence(F.lit(0), length), whole),
        F.transform(F.sequence(F.lit(1), length), opened),
    )
    return words.select("word", "n", F.explode(every).alias("r")).select("word", "n", "r.*")


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near`` and ``best`` (``less``: minus its ``n``, ``word``) per row of ``words``.

    ``words`` has every ``word`` once. Near words differ by one letter inserted, deleted or
    replaced; ``best`` is the most frequent, ties to the smallest, null if there is none.
    """
    named = F.struct((-F.col("n")).alias("less"), "word")
    run = W.partitionBy("prefix").orderBy(F.desc("n"), "word").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    kinds = {"open": F.col("open"), "start": F.col("open") & F.col("first"), "whole": ~F.col("open")}
    seen = _rotations(words).withColumn("named", named)
    seen = seen.withColumns(
        {f"n_{k}": F.count(F.when(is_it, 1)).over(run) for k, is_it in kinds.items()}
        | {f"the_{k}": F.first(F.when(is_it, F.col("named")), ignorenulls=True).over(run) for k, is_it in kinds.items()}
        | {"next_open": F.nth_value(F.when(F.col("open"), F.col("named")), 2, ignoreNulls=True).over(run)}
    )
    itself = F.col("the_open.word") == F.col("word")
    other = F.when(itself, F.col("next_open")).otherwise(F.col("the_open"))
    shorter = F.when(F.col("first"), F.col("the_whole"))
    seen = seen.select(
        "word",
        "n",
        "own",
        F.when(F.col("open"), F.col("n_open") - 1 + F.when(F.col("first"), F.col("n_whole")).otherwise(0))
        .otherwise(F.col("n_start"))
        .alias("near"),
        F.when(F.col("open"), F.least(other, shorter)).otherwise(F.col("the_start")).alias("best"),
    )
    return seen.filter("own or near > 0").groupBy("word").agg(
        F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best")
    )


def roots(links: DataFrame) -> DataFrame:
    """``word`` and ``root`` for each row of ``links`` (``word``, each once, and its ``form``).

    The end of the path of forms; paths have no circles. Each round halves what is left of them.
    """
    reached = written(links.select("word", F.col("form").alias("root")), "roots")
    n = reached.count()
    while True:
        onward = small(reached.select(F.col("word").alias("at"), F.col("root").alias("next")), n, PAIR_BYTES)
        moved = reached.join(onward, F.col("root") == F.col("at"), "left")
        further = written(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        removed(reached)
        reached = further
        if reached.filter("moved").isEmpty():
            return reached.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` per row of ``words`` (``word``, ``n``).

    ``form`` is the most frequent near word, if it is ``ratio`` times as frequent (two or more);
    ``root`` is the last of the forms that follow each other, the word itself if it has none. Null
    words take no part, a repeated word counts with the sum of its rows. Other columns are not read.
    """
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent")
    whole = words.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    near = written(neighbours(written(whole, "words")), "near-words")
    counts = F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.word"))
    formed = near.select("word", "n", "n_near", counts.alias("form"), (-F.col("best.less")).alias("best_n"))
    ends = roots(formed.filter("form is not null").select("word", "form"))
    joined = formed.join(small(ends.select(F.col("word").alias("from"), "root"), ends.count(), PAIR_BYTES), F.col("word") == F.col("from"), "left")
    return joined.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        "n_near",
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
    )
