"""Text helpers: trimming, missing-value tokens, text lists, flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

#: The characters Python's ``str.strip`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

#: Texts that count as missing at each stage.
KEY_TOKENS = ("", "nan")
VALUE_TOKENS = ("", "nan", "NaN")
REFERENCE_TOKENS = ("", "nan", "None")

#: Words read as true.
TRUE_WORDS = ("true", "t", "1", "yes")


def strip(c: Column) -> Column:
    """Trim every whitespace character ``str.strip`` would.

    Blanks go first, at little cost; only a text that still starts or ends with
    another whitespace character takes the slower trim by a set of characters.
    """
    t = F.trim(c)
    edges = F.contains(F.lit(WHITESPACE), F.left(t, F.lit(1))) | F.contains(F.lit(WHITESPACE), F.right(t, F.lit(1)))
    return F.when(edges, F.trim(t, F.lit(WHITESPACE))).otherwise(t)


def is_missing(c: Column, tokens: Sequence[str]) -> Column:
    """True for NULL and for any of ``tokens``; never NULL itself."""
    return c.isNull() | F.coalesce(c.cast("string").isin(*tokens), F.lit(False))


def null_if_token(c: Column, tokens: Sequence[str] = VALUE_TOKENS) -> Column:
    """NULL where the text is one of ``tokens``, else the value."""
    return F.when(~is_missing(c, tokens), c)


def list_items(c: Column) -> Column:
    """Items of a comma-separated text, trimmed, blanks dropped; NULL when none remain."""
    items = F.filter(F.transform(F.split(null_if_token(c), ","), strip), lambda x: x != "")
    return F.when(F.size(items) > 0, items)


def to_text(c: Column) -> Column:
    return c.cast("string")


def to_bool(c: Column) -> Column:
    """True for the true words in any case; missing stays NULL, anything else is false."""
    return F.when(~is_missing(c, VALUE_TOKENS), F.lower(strip(c.cast("string"))).isin(*TRUE_WORDS))
