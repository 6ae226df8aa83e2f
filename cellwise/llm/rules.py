"""Quality rules, lines first: rules judge each line, failing lines go, and a document that loses
too much of its words goes with them. DataFrame functions only; nothing is shuffled.

A line fails if it

- ends no sentence: no terminal mark at its end or before white space within it;
- consists of marks: doubled marks ("!!") or symbols for more than one in four of its words;
- is navigation: separators between most of its words, or nothing but a menu's phrase;
- is boilerplate: a short line with a phrase of notices, licences or consent banners;
- repeats an earlier line of the document.

A document's figures (words, characters, symbols, repeats) are taken of the text as it came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
# A terminal mark, closing quotes and brackets aside, before white space or at the end.
SENTENCE_END = r"""[.!?…。！？؟।]["'”’»)\]]*([\x20\x09-\x0D]|$)"""
DOUBLED = r"[!?]{2,}"
SEPARATOR = r"(^|[\x20\x09])[|/>»›·•]+([\x20\x09]|$)"
MENU = (
    r"(?i)^[\x20\x09]*(home|menu|next|previous|log ?in|sign (in|up)|share( this)?|read more|see also|search|"
    r"back to top|skip to (main )?content|related (posts|articles)|click here|print|comments?)[\x20\x09.:!>]*$"
)
BOILERPLATE = (
    r"(?i)(all rights reserved|enable javascript|javascript is (disabled|required)|cookie(s)? (policy|settings|notice)|"
    r"(uses|accept) (all )?cookies|privacy policy|terms of (use|service)|lorem ipsum|subscribe to our|"
    r"licen[sc]ed under|released under the)"
)
# Longer lines are prose that may mention such a phrase.
BOILERPLATE_WORDS = 20
MIN_WORDS = 50
MAX_REPEATED = 50
MAX_LOST = 30


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def passes(line: Column) -> Column:
    """Whether a line passes the rules that need no other line; a wordless line does not."""

    def judged(n: Column) -> Column:
        most = lambda pattern: 4 * _count(line, pattern) > n
        return (
            (n > 0)
            & line.rlike(SENTENCE_END)
            & ~most(DOUBLED)
            & ~most(SYMBOL)
            & ~most(SEPARATOR)
            & ~line.rlike(MENU)
            & ~((n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE))
        )

    return _let(_count(line, WORD), judged)


def repeated_words(words: Column) -> Column:
    """Words in runs of three that stand twice or more in ``words``, every occurrence counted.

    Runs are told apart by a 64-bit hash. Only documents in which a hash repeats sort positions.
    """
    last = F.size(words) - 3

    def runs(hashes: Column) -> Column:
        run = lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2))
        return F.transform(F.sequence(F.lit(0), last), run)

    def repeating(ordered: Column) -> Column:
        """Positions whose run has an equal neighbour in the order by run, ascending."""
        same = lambda i, j: F.coalesce(F.get(ordered, i)["run"] == F.get(ordered, j)["run"], F.lit(False))
        at = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: same(i, i - 1) | same(i, i + 1))
        return F.array_sort(F.transform(at, lambda i: F.get(ordered, i)["at"]))

    def covered(at: Column) -> Column:
        """Words that runs of three at these positions cover together."""
        gaps = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    def counted(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda run, i: F.struct(run.alias("run"), i.alias("at"))))
        some = F.size(F.array_distinct(found)) < F.size(found)
        return F.when(some, _let(_let(ordered, repeating), covered)).otherwise(F.lit(0).cast("long"))

    whole = _let(_let(F.transform(words, lambda w: F.xxhash64(w)), runs), counted)
    return F.when(last >= 0, whole).otherwise(F.lit(0).cast("long"))


def line_cleaned(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_repeated: int = MAX_REPEATED,
    max_lost: int = MAX_LOST,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Figures and verdict per row of ``docs``, and its text without failing lines.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``;
    ``base_failed`` if there are fewer than ``min_words`` words or more than ``max_repeated`` per
    cent of them are repeated; ``n_left`` words in ``cleaned``; ``kept`` unless that failed or
    more than ``max_lost`` per cent of the words went with their lines.

    A null, empty or blank text has no words and fails; its ``cleaned`` is empty. Blank lines are
    not kept. Repeated rows and shared or null ids are judged row by row; of other columns only
    those named in ``keep`` are read. An empty table gives an empty result.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), *[F.col(c).alias(f"_keep_{c}") for c in keep], whole.alias("_text"))
    words = F.filter(F.split("_text", SPACE), lambda w: w != "")
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD))
    rows = rows.withColumns({"_words": words, "_lines": lines})
    rows = rows.withColumn("_distinct", F.array_distinct("_lines"))
    rows = rows.withColumns(
        {
            "_n": F.size("_words").cast("long"),
            "_chars": F.char_length("_text").cast("long") - _count(F.col("_text"), r"[\x20\x09-\x0D]"),
            "_symbols": _count(F.col("_text"), SYMBOL),
            "_dup": (F.size("_lines") - F.size("_distinct")).cast("long"),
            "_repeated": repeated_words(F.col("_words")),
            "_cleaned": F.concat_ws("\n", F.filter("_distinct", passes)),
        }
    )
    rows = rows.withColumn("_left", _count(F.col("_cleaned"), WORD))
    failed = (F.col("_n") < min_words) | (100 * F.col("_repeated") > max_repeated * F.col("_n"))
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_n").alias("n_words"),
        F.col("_chars").alias("word_chars"),
        F.col("_symbols").alias("n_symbols"),
        F.col("_dup").alias("n_dup_lines"),
        F.col("_repeated").alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & (100 * (F.col("_n") - F.col("_left")) <= max_lost * F.col("_n"))).alias("kept"),
        F.col("_left").alias("n_left"),
        F.col("_cleaned").alias("cleaned"),
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
    )
