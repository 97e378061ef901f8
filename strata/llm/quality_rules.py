"""Line-first quality rules, as built-in expressions over each text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.shared import free_name, let, without

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
# fixed values: characters that separate the entries of a menu, and phrases of notices
SEPARATORS = r"[|›»·•]"
BOILERPLATE = (
    r"(?i)all rights reserved|copyright \(c\)|copyright ©|licensed under|spdx-license-identifier"
    r"|terms of (use|service)|privacy policy|cookie policy|accept cookies|enable javascript|subscribe to our newsletter|click here|log in to continue"
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def repeated_words(words: Column, window: int = 8) -> Column:
    """How many words stand in a window of 8 words that occurs twice or more in the text.

    Window hashes come from doubling (1, 2, 4, 8 words). Only a text with a repeat sorts
    them; equal neighbours give the starts, and each start covers 8 words or as many as lie before the next.
    """
    if window != 8:
        raise ValueError("windows of 8 words only")

    def shift(a, k):
        return F.zip_with(a, F.slice(a, k + 1, F.size(a)), lambda x, y: F.xxhash64(x, y))

    def covered(starts):
        return F.aggregate(
            F.zip_with(starts, F.slice(starts, 2, F.size(starts)), lambda p, q: F.least(F.lit(window), F.coalesce(q - p, F.lit(window)))),
            F.lit(0).cast("long"), lambda acc, x: acc + x)

    def starts(pairs):
        equal = F.zip_with(pairs, F.slice(pairs, 2, F.size(pairs)), lambda p, q: F.when(p["h"] == q["h"], F.array(p["i"], q["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda x: x.isNotNull()))))

    def of_hashes(h):
        sorted_pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(sorted_pairs, lambda p: let(starts(p), covered)))

    def of_words(w):
        one = F.transform(w, lambda x: F.xxhash64(x))
        eight = let(one, lambda a: let(shift(a, 1), lambda b: let(shift(b, 2), lambda c: F.slice(shift(c, 4), 1, F.size(c) - (window - 1)))))
        return F.when(F.size(w) <= window, F.lit(0).cast("long")).otherwise(let(eight, of_hashes))

    return of_words(words)


def line_fails(line: Column, *, max_symbols: float = 0.3, max_marks: float = 0.3, max_separators: float = 0.15, max_boilerplate_words: int = 40) -> Column:
    """Whether a line breaks the punctuation, navigation or boilerplate rule.

    Punctuation: more than ``max_symbols`` of ``[#*$%&<>]``, or more than ``max_marks`` of ``[!?]``, for each word. Navigation:
    three separators or more, over ``max_separators`` for each word. Boilerplate: a notice's phrase in a line of at most
    ``max_boilerplate_words`` words. A line without words never fails.
    """
    def rules(n):
        punctuation = (F.regexp_count(line, F.lit("[#*$%&<>]")) > max_symbols * n) | (F.regexp_count(line, F.lit("[!?]")) > max_marks * F.greatest(n, F.lit(4)))
        marks = F.regexp_count(line, F.lit(SEPARATORS))
        navigation = (marks >= 3) & (marks > max_separators * n)
        return (n > 0) & (punctuation | navigation | ((n <= max_boilerplate_words) & line.rlike(BOILERPLATE)))

    return let(F.size(words_of(line)), rules)


def quality_rules(docs: DataFrame, *, text_col: str = "text", max_lost: float = 0.5, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """``docs`` with cleaned text (``clean_text``), the base figures, base_failed and kept.

    Lines that break a rule go; a document that loses more than ``max_lost`` of the characters in its words is rejected,
    as is one that fails the base rules (fewer than ``min_words`` words, or more than ``max_repeat_percent`` of them in repeated windows).
    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars (all long), base_failed, kept, clean_text; input columns of
    these names are replaced.

    Defined results: a null or empty text has no words, so base_failed is true and kept false; its clean_text is empty. Very long
    texts, ties, repeated rows and null ids change nothing, since each row is judged alone. An empty table gives an empty table.
    """
    docs = without(docs, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars", "base_failed", "kept", "clean_text")
    text = F.coalesce(F.col(text_col), F.lit(""))
    has_word = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    chars = lambda x: F.length(F.regexp_replace(x, SPACE + "+", "")).cast("long")
    figures = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("n_repeat_words")))
    by_line = let(F.split(text, "\n", -1), lambda lines: F.struct(
        let(F.filter(lines, has_word), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        F.array_join(F.filter(lines, lambda x: ~line_fails(x)), "\n").alias("clean_text")))
    f, l = free_name(docs, "figures"), free_name(docs, "by_line")
    df = docs.withColumns({f: figures, l: by_line, "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long")})
    base_failed = (F.col(f"{f}.n_words") < min_words) | (100 * F.col(f"{f}.n_repeat_words") > max_repeat_percent * F.col(f"{f}.n_words"))
    df = df.withColumns({"lost_chars": F.col(f"{f}.word_chars") - chars(F.col(f"{l}.clean_text")), "base_failed": base_failed})
    kept = ~F.col("base_failed") & (F.col("lost_chars") <= max_lost * F.col(f"{f}.word_chars"))
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], f"{f}.n_words", f"{f}.word_chars", "n_symbols", f"{l}.n_dup_lines", f"{f}.n_repeat_words", "lost_chars", "base_failed", kept.alias("kept"), f"{l}.clean_text")
