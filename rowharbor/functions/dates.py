"""Text to date. A text that is not a usable date becomes NULL; nothing is rejected.

Every layout is rewritten to year, month and day by one chain of replacements, each a no-op for the texts of other layouts, so a text
passes through once and nothing is computed twice; the result depends on the text and the reference year alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from rowharbor.functions.text import VALUE_TOKENS, is_missing, strip

#: The end-of-time marker, the last year kept and the first full day kept.
END_OF_TIME = "9999-12-31"
LAST_YEAR = 2200
FIRST_DAY = "1677-09-22"

#: Two-digit years land within fifty years of this one.
REFERENCE_YEAR = 2026

_CLOCK = (
    r"[ T]+([01]?[0-9]|2[0-3]):([0-5]?[0-9])(?::([0-5]?[0-9])(?:\.([0-9]+))?)?"
    r"(?: ?([AaPp])[Mm])?(?: ?(?:Z|UTC|GMT|[+-][0-9]{2}:?[0-9]{2}))?$"
)
_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_ISO_WITH_CLOCK = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}" + _CLOCK
_WEEKDAY = r"^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +"
_MONTHS = "january february march april may june july august september october november december".split()
#: The first three letters of a month that is written out, cut to three, or ``sept``.
_NAME = r"(?=(?:" + "|".join([*_MONTHS, "sept", *(m[:3] for m in _MONTHS)]) + r")(?![a-z]))([a-z]{3})[a-z]*"
_SEP = r"(?: *[-/., ] *|)"
_DAY = r"([0-9]{1,2})(?:st|nd|rd|th)?"
_YEAR = r"([0-9]{4}|[0-9]{2})"

#: Layouts, and where year, month and day stand in them. The first that matches turns the text into ``year|month|day``.
_LAYOUTS = (
    (rf"^{_DAY}{_SEP}{_NAME}{_SEP}{_YEAR}$", "$3|$2|$1"),
    (rf"^{_NAME}{_SEP}{_DAY}[-/., ] *{_YEAR}$", "$3|$1|$2"),
    (rf"^([0-9]{{4}})[-/., ]+{_NAME}[-/., ]+([0-9]{{1,2}})$", "$1|$2|$3"),
    (rf"^{_NAME}[-/., ]+([0-9]{{4}})$", "$2|$1|1"),
    (r"^([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})$", "$1|$2|$3"),
    (rf"^(0?[0-9]|1[0-2])[-/.]([0-9]{{1,2}})[-/.]{_YEAR}$", "$3|$1|$2"),
    (rf"^([0-9]{{1,2}})[-/.]([0-9]{{1,2}})[-/.]{_YEAR}$", "$3|$2|$1"),
    (r"^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1|$2|$3"),
    (r"^([0-9]{4})[-/]([0-9]{1,2})$", "$1|$2|1"),
    (r"^([0-9]{1,2})[-/]([0-9]{4})$", "$2|$1|1"),
    (r"^([0-9]{4})$", "$1|1|1"),
)
#: Days outside of what is kept, by their text: years after ``LAST_YEAR`` and days before ``FIRST_DAY``.
_NOT_KEPT = r"^(?!1677-09-2[2-9]|1677-09-30|1677-1[0-2]|167[89]|16[89]|1[7-9]|2[01]|2200)"


def _below(n: int) -> str:
    """Pattern of the two-digit numbers below ``n``."""
    tens, ones = divmod(n, 10)
    parts = ([f"[0-{tens - 1}][0-9]"] if tens else []) + ([f"{tens}[0-{ones - 1}]"] if ones else [])
    return "|".join(parts) or "(?!)"


def _day_text(text: Column, reference_year: int) -> Column:
    """``yyyy-MM-dd`` of a text in any layout; anything else for a text that is no date or not kept."""
    century, turn = divmod(reference_year + 50, 100)
    steps = [(_CLOCK, ""), (_WEEKDAY, ""), *_LAYOUTS, (rf"^({_below(turn)})\|", f"{century}$1|"), (r"^([0-9]{2})\|", f"{century - 1}$1|")]
    found = F.regexp_replace(text, *steps[0])
    found = reduce(lambda t, step: F.regexp_replace(t, *step), steps[1:], F.lower(found))
    found = reduce(lambda t, m: F.replace(t, F.lit(f"|{m[1][:3]}|"), F.lit(f"|{m[0]:02}|")), enumerate(_MONTHS, 1), found)
    dashed = F.translate(F.regexp_replace(found, r"\|(?=[0-9](?:\||$))", "|0"), "-|", "x-")
    return F.regexp_replace(dashed, _NOT_KEPT, "x")


def to_date(c: Column, reference_year: int = REFERENCE_YEAR, apart: bool = False) -> Column:
    """Date part of a text.

    Any text holding the end-of-time marker is that date; years after 2200, days
    before 1677-09-22 and unreadable texts are NULL. ``a/b/yyyy`` is read month
    first, or day first when ``a`` is above 12. With ``apart`` the layouts other than the common ones stand in a lambda,
    which is evaluated and not generated: their chain is longer than the methods that the JVM compiles, and would keep
    all columns beside it from being compiled.
    """
    text = strip(c)
    other = lambda t: F.try_to_date(_day_text(t, reference_year), "yyyy-MM-dd")
    # The common layout needs no parsing beyond the cast; its texts sort like its days.
    kept = lambda day: F.when(day.between(FIRST_DAY, f"{LAST_YEAR}-12-31"), day.try_cast("date"))
    return (
        F.when(is_missing(c, VALUE_TOKENS), F.lit(None).cast("date"))
        .when(F.contains(c, F.lit(END_OF_TIME)), F.lit(END_OF_TIME).cast("date"))
        .when(text.rlike(_ISO), kept(text))
        .when(text.rlike(_ISO_WITH_CLOCK), kept(F.left(text, F.lit(10))))
        .when(text.rlike("[0-9]"), F.get(F.transform(F.array(text), other), F.lit(0)) if apart else other(text))
    )


def to_datetime(c: Column, reference_year: int = REFERENCE_YEAR) -> Column:
    """As :func:`to_date` but keeping the time of day as written (no time zone)."""
    text = strip(c)
    g = F.regexp_extract
    hour = g(text, _CLOCK, 1).try_cast("int")
    half = F.lower(g(text, _CLOCK, 5))
    hour = F.when(half == "p", hour % 12 + 12).when(half == "a", hour % 12).otherwise(hour)
    second = F.when(g(text, _CLOCK, 3) != "", g(text, _CLOCK, 3)).otherwise(F.lit("0"))
    fraction = F.when(g(text, _CLOCK, 4) != "", F.left(g(text, _CLOCK, 4), F.lit(6))).otherwise(F.lit("0"))
    clock = F.concat(
        F.lpad(hour.cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(g(text, _CLOCK, 2), 2, "0"),
        F.lit(":"),
        F.lpad(second, 2, "0"),
        F.lit("."),
        fraction,
    )
    clock = F.when(text.rlike(_CLOCK) & ~F.contains(c, F.lit(END_OF_TIME)), clock).otherwise(F.lit("00:00:00"))
    return F.concat_ws(" ", to_date(c, reference_year).cast("string"), clock).try_cast("timestamp_ntz")
