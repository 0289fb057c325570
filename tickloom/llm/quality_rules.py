"""Line-first quality rules as DataFrame expressions.

Every line is judged by itself: it must end like a sentence, must not be mostly marks, must not be
a menu (cells or steps set apart by separators) and, if short, must not hold a phrase of site
boilerplate. Lines that fail go; a document goes if its base figures fail or if less than
`least_kept` of its word characters are left.

Defined results: a null text has no words and fails; lines without words are neither kept nor
lost; a line that occurs twice is judged twice; repeated rows give repeated results; an empty
table gives no rows. Extra columns are ignored. Repeated 3-word windows are found in a document's
own sorted list of 64-bit window hashes, so the time for a text of n words grows with n log n, and
nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the words, marks and lines are told by.
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
SENTENCE_ENDS = ".!?…:;\"'”’»)]。！？"
MARKS = "!?|*#$%&<>~^=_+/\\@"
SEPARATORS = "|»›•·>"
BOILERPLATE = (
    "lorem ipsum", "javascript", "cookie", "terms of use", "terms of service", "privacy policy", "all rights reserved",
    "click here", "read more", "sign in", "sign up", "log in", "subscribe", "share this", "skip to content",
)

LEAST_WORDS = 50
#: Share of a line's word characters that may be marks; separators from which a line is a menu.
MOST_MARKS, MENU_SEPARATORS = 0.15, 3
#: Characters up to which a line with a boilerplate phrase goes.
SHORT_LINE = 200
LEAST_KEPT = 0.5


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def _without(column: Column, characters: str) -> Column:
    return F.translate(column, characters, "")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """How many words lie in 3-word windows that occur twice or more."""
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("at")))

    def places(s: Column) -> Column:
        """Sorted places of the windows that have an equal beside them in the sorted list."""
        like = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, j: like(x, j - 1) | like(x, j + 1)), lambda x: x["at"]))

    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    covered = F.aggregate(
        _let(F.sort_array(windows), places), zero, lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(p, a["upto"])).alias("n"), (p + 3).alias("upto")), lambda a: a["n"]
    )
    return F.when(n < 3, F.lit(0)).otherwise(covered).cast("long")


def line_fails(line: Column) -> Column:
    """Whether a line with words is to go."""
    n_separators = F.char_length(line) - F.char_length(_without(line, SEPARATORS))

    def fails(bare: Column) -> Column:
        n_chars = F.char_length(bare)
        return (
            ~F.contains(F.lit(SENTENCE_ENDS), F.right(bare, F.lit(1)))
            | ((F.char_length(line) <= SHORT_LINE) & F.lower(line).rlike("|".join(BOILERPLATE)))
            | (n_chars - F.char_length(_without(bare, MARKS)) > MOST_MARKS * n_chars)
            | ((n_separators >= MENU_SEPARATORS) & (5 * n_separators >= F.size(words_of(line))))
        )

    return _let(_without(line, BLANKS), fails)


def judge(docs: DataFrame, least_kept: float = LEAST_KEPT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, clean_text, n_failed_lines.

    clean_text: the lines that pass, in order; the document's text where it is kept.
    """
    has_words = lambda line: F.char_length(_without(line, BLANKS)) > 0
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # A generator between the steps: words and lines are made once, not once for each use.
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select("doc_id", "text", F.inline(F.array(F.struct(words_of(F.col("text")).alias("words"), F.filter(F.split("text", "\n", -1), has_words).alias("lines")))))
    base = F.struct(
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.filter("lines", lambda line: ~line_fails(line)).alias("good"),
    )
    told = rows.select("doc_id", F.inline(F.array(base)))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.char_length(_without(F.concat_ws("", "good"), BLANKS))
    return told.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (left >= least_kept * F.col("word_chars"))).alias("kept"),
        F.concat_ws("\n", "good").alias("clean_text"), (F.col("n_lines") - F.size("good")).cast("long").alias("n_failed_lines"),
    )
