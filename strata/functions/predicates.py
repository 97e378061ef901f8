"""Predicates over text and arrays."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _any(text: Column, phrases: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(p.lower())) for p in phrases])


def text_any_match(col: Column, phrases: Sequence[str], *, array: bool = False, field: str | None = None) -> Column:
    """Whether any phrase occurs in the text, or in any fragment of an array, in any case; false for null."""
    if array:
        return F.coalesce(F.exists(col, lambda x: F.coalesce(_any(x[field] if field else x, phrases), F.lit(False))), F.lit(False))
    return F.coalesce(_any(col, phrases), F.lit(False))


def text_none_match(col: Column, phrases: Sequence[str], *, array: bool = False, field: str | None = None) -> Column:
    """The opposite of text_any_match: true for null, too."""
    return ~text_any_match(col, phrases, array=array, field=field)


def like_length(col: Column, pattern: str, lengths: Sequence[int]) -> Column:
    """Whether a value has a LIKE shape and one of the lengths."""
    return col.like(pattern) & F.length(col).isin(*lengths)


def any_array_element(col: Column, test) -> Column:
    """Whether any element passes; false for null and empty arrays."""
    return F.coalesce(F.exists(col, test), F.lit(False))


def not_in_list(col: Column, words: Sequence[str]) -> Column:
    """Whether a non-null value is none of the words, in any case."""
    return ~F.lower(col).isin([w.lower() for w in words])
