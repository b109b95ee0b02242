"""Text to number, with the reason why a text is not one."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rowharbor.functions.text import VALUE_TOKENS, null_if_token, strip

#: Plain decimal or exponent notation. Narrower than a cast, which also takes '12d'.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY = r"(?i)^[+-]?inf(inity)?$"
NOT_A_NUMBER = r"(?i)^[+-]?nan$"

#: Messages a failed numeric conversion reports.
NOT_NUMERIC = "could not convert string to float: "
INFINITE_INT = "cannot convert float infinity to integer"
NAN_INT = "cannot convert float NaN to integer"
TOO_LARGE_INT = "integer out of range"


def digits(c: Column) -> Column:
    """The text a number is read from: no thousands commas, no outer blanks; NULL when missing."""
    return strip(F.replace(null_if_token(c, VALUE_TOKENS), F.lit(","), F.lit("")))


def quoted(c: Column) -> Column:
    """The text in quotes, double ones where it holds single quotes only."""
    in_double = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    in_single = F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(in_double, F.concat(F.lit('"'), c, F.lit('"'))).otherwise(in_single)


def parse_number(t: Column) -> Column:
    """Double of a trimmed text in plain number notation, else NULL."""
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def parse_int(t: Column) -> Column:
    """Whole number of a trimmed text, truncated toward zero, else NULL."""
    return parse_number(t).try_cast("bigint")


def parse_float(t: Column) -> Column:
    """As :func:`parse_number`, also reading infinity and not-a-number words."""
    infinity = F.when(t.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (
        F.when(t.rlike(NUMBER), t.try_cast("double"))
        .when(t.rlike(INFINITY), infinity)
        .when(t.rlike(NOT_A_NUMBER), F.lit(float("nan")))
    )


def int_problem(t: Column) -> Column:
    """Why a trimmed text that :func:`parse_int` could not read is not a whole number."""
    return (
        F.when(t.rlike(NUMBER), F.lit(TOO_LARGE_INT))
        .when(t.rlike(INFINITY), F.lit(INFINITE_INT))
        .when(t.rlike(NOT_A_NUMBER), F.lit(NAN_INT))
        .otherwise(float_problem(t))
    )


def float_problem(t: Column) -> Column:
    """Why a trimmed text that :func:`parse_float` could not read is not a number."""
    return F.concat(F.lit(NOT_NUMERIC), quoted(t))


def to_int(c: Column) -> Column:
    """Whole number truncated toward zero; NULL when missing or unreadable."""
    return parse_int(digits(c))


def to_float(c: Column) -> Column:
    """Double with thousands commas removed; NULL when missing or unreadable."""
    return parse_float(digits(c))
