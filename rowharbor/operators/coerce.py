"""Coerce whole tables to declared types, keeping the reason for every rejected row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from rowharbor.functions.dates import REFERENCE_YEAR, to_date, to_datetime
from rowharbor.functions.json_text import to_json_or_array
from rowharbor.functions.numbers import digits, float_problem, int_problem, parse_float, parse_int
from rowharbor.functions.text import VALUE_TOKENS, null_if_token, to_bool

REASON = "rejection_reason"
STAGE = "reject_stage"
TYPED = "_typed"

#: Prefix of a type rejection.
TYPE_REASON = "Type coercion failed: "

_IN, _OUT, _UNREAD = "_in_", "_out_", " unread"


def _cell_text(c: Column, word: str) -> Column:
    text = c.cast("string")
    return digits(text) if word in ("int", "float") else null_if_token(text, VALUE_TOKENS)


def _value(text: Column, word: str, keep_time: bool, real_bools: bool, reference_year: int) -> Column:
    if word == "int":
        return parse_int(text)
    if word == "float":
        return parse_float(text)
    if word == "date":
        whole = lambda t: to_datetime(t, reference_year)
        return F.get(F.transform(F.array(text), whole), F.lit(0)) if keep_time else to_date(text, reference_year, apart=True)
    if word == "dict":
        return to_json_or_array(text)
    if word == "bool" and real_bools:
        return to_bool(text)
    return text


def _unread(text: Column, value: Column, word: str) -> Column:
    """A number's text that has no value, with the type it was read as; else NULL."""
    return F.when(text.isNotNull() & value.isNull(), F.struct(F.lit(word).alias("word"), text.alias("text")))


def _type_reason(unread: Column) -> Column:
    """Why the first unread text of a row is not a number; written once, however many columns there are."""
    text = unread["text"]
    return F.concat(F.lit(TYPE_REASON), F.when(unread["word"] == "int", int_problem(text)).when(unread["word"] == "float", float_problem(text)))


def check_types(
    df: DataFrame, types: Mapping[str, str], keep_time: bool = False, real_bools: bool = False, reference_year: int = REFERENCE_YEAR
) -> DataFrame:
    """Add the typed row as a struct and the reason of the first failing column in declared order.

    Cell text, value, first unread text and reason are projections in a row, so every cell is
    trimmed once and parsed once, and both halves of a split read the same result.
    Columns without a declared type enter the typed row unchanged.
    """
    present = {c: w for c, w in types.items() if c in df.columns}
    texts = df.withColumns({_IN + c: _cell_text(F.col(f"`{c}`"), w) for c, w in present.items()})
    values = texts.withColumns(
        {_OUT + c: _value(F.col(f"`{_IN}{c}`"), w, keep_time, real_bools, reference_year) for c, w in present.items()}
    )
    unread = [_unread(F.col(f"`{_IN}{c}`"), F.col(f"`{_OUT}{c}`"), w) for c, w in present.items() if w in ("int", "float")]
    typed = [F.col(f"`{_OUT}{c}`" if c in present else f"`{c}`").alias(c) for c in df.columns]
    own = [F.col(f"`{c}`") for c in df.columns]
    if not unread:
        return values.select(*own, F.struct(*typed).alias(TYPED), F.lit(None).cast("string").alias(REASON))
    first = values.select(*own, F.struct(*typed).alias(TYPED), F.coalesce(*unread).alias(_UNREAD))
    return first.select(*own, TYPED, _type_reason(F.col(_UNREAD)).alias(REASON))


def pinned(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows with the given columns computed at this point of the plan, once.

    The optimizer moves a filter on a computed column below its computation and then
    computes it again for every place that reads it. A filter does not move below the
    one-element explode used here.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    held = F.explode(F.array(F.struct(*[F.col(f"`{c}`") for c in columns]))).alias("_held")
    return df.select(*rest, held).select(*rest, *[F.col(f"_held.{c}").alias(c) for c in columns])


def coerce_table(
    df: DataFrame, types: Mapping[str, str], keep_time: bool = False, real_bools: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split into typed rows and untouched rejected rows with their reason."""
    checked = pinned(check_types(df, types, keep_time, real_bools), TYPED, REASON)
    valid = checked.where(F.col(REASON).isNull()).select(f"{TYPED}.*")
    rejected = checked.where(F.col(REASON).isNotNull()).drop(TYPED)
    return valid, rejected
