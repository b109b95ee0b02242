"""SQL expressions over whole texts that several scans share."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def spans_of(text: Column, pattern: str | Column, measure=F.length) -> Column:
    """``array<struct<start, end, value>>`` of the leftmost matches that do not overlap.

    The pieces between the matches and the matches themselves are measured in turn, so positions are sums of
    lengths: code points by default, or whatever ``measure`` counts. A match must not be empty.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def step(state: Column, both: Column) -> Column:
        start = state["at"] + measure(both["pieces"])
        end = start + measure(both["matches"])
        span = F.struct(start.alias("start"), end.alias("end"), both["matches"].alias("value"))
        return F.when(both["matches"].isNull(), state).otherwise(
            F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))
        )

    both = F.arrays_zip(pieces.alias("pieces"), matches.alias("matches"))
    first = F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("spans"))
    return F.aggregate(both, first, step, lambda state: state["spans"])
