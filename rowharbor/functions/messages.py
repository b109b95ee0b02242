"""Technical messages and rejection reasons as text for business readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Patterns and texts a report reader expects, word for word.
FK_PATTERN = r'Key \(([^)]+)\)=\(([^)]+)\) is not present in table "([^"]+)"'
COLUMN_PATTERN = r'column "([^"]+)" of relation "[^"]+" does not exist'
NULL_PATTERN = r'null value in column "([^"]+)"'
MISSING_PATTERN = r"Missing required data in columns: \[([^\]]+)\]"

TEXT_FK = (
    "Missing Reference Data: The value '%s' in column '%s' does not exist in the %s table. "
    "Please ensure this value exists in the reference table first."
)
TEXT_COLUMN = (
    "Column Mismatch: The Excel sheet has a column '%s' that doesn't match the database structure. "
    "Please check the column names in your Excel file."
)
TEXT_NULL = (
    "Missing Required Data: Column '%s' cannot be empty. Please provide values for all rows in this column."
)
TEXT_JSON = (
    "Data Format Issue: Some values are not in the correct format. "
    "Text values that should be lists need to be properly formatted."
)
TEXT_NUMBER = (
    "Number Format Issue: Some values cannot be converted to numbers. "
    "Please check for special characters, text in number fields, or scientific notation."
)
TEXT_DATE = (
    "Date Format Issue: Some date values are invalid or out of range. "
    "Please check date formats and extreme dates like '9999-12-31'."
)
TEXT_DUPLICATE = (
    "Duplicate Records: There are duplicate entries for the same key. "
    "Please remove duplicate rows from your Excel file."
)
TEXT_OTHER = (
    "Data Issue: There was a problem loading data into %s. Please check the data format and required fields."
)
REASON_MISSING = "Missing Required Data: Some rows are missing values in the '%s' column(s)."
REASON_FORMAT = (
    "Data Format Issue: Some values are in the wrong format and cannot be converted to the required data type."
)
REASON_OTHER = "Data Quality Issue: %s"

ACTION_FK = "Action Required: Load the referenced table first, or verify the reference values exist."
ACTION_COLUMN = "Action Required: Check your Excel column headers and ensure they match the expected format."
ACTION_NULL = "Action Required: Fill in all required fields - no empty cells allowed in this column."
ACTION_NUMBER = "Action Required: Check number fields for text, special characters, or scientific notation."
ACTION_DATE = "Action Required: Review date formats and replace extreme dates like '9999-12-31' with valid dates."
ACTION_DUPLICATE = "Action Required: Remove duplicate rows with the same ID/key values."
ACTION_OTHER = "Action Required: Review the data format and contact the system administrator if needed."
ACTION_REASON_MISSING = "Action Required: Fill in the missing required values in your Excel file."
ACTION_REASON_FORMAT = (
    "Action Required: Check data formats - ensure numbers are numeric, dates are valid, etc."
)
ACTION_REASON_OTHER = "Action Required: Review the rejected rows CSV file for specific issues."
# End of fixed values.


def _has(c: Column, *needles: str) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | F.contains(c, F.lit(needle))
    return found


def _fill(template: str, *values: Column) -> Column:
    return F.format_string(template, *values)


def title_words(c: Column) -> Column:
    """``user_master`` as ``User Master``."""
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def parse_fk_error(message: Column) -> Column:
    """Column, value and parent table named by a foreign-key message, as a struct of NULLs when absent."""
    hit = message.rlike(FK_PATTERN)
    return F.struct(
        *[
            F.when(hit, F.regexp_extract(message, FK_PATTERN, i)).alias(name)
            for i, name in enumerate(("fk_column", "fk_value", "fk_table"), start=1)
        ]
    )


def classify_error(message: Column, table: Column) -> Column:
    """Business text of a technical message. First rule wins; the first three also need their detail."""
    fk = parse_fk_error(message)
    return (
        F.when(
            _has(message, "ForeignKeyViolation") & message.rlike(FK_PATTERN),
            _fill(TEXT_FK, fk["fk_value"], fk["fk_column"], title_words(fk["fk_table"])),
        )
        .when(
            _has(message, "UndefinedColumn") & message.rlike(COLUMN_PATTERN),
            _fill(TEXT_COLUMN, F.regexp_extract(message, COLUMN_PATTERN, 1)),
        )
        .when(
            _has(message, "NotNullViolation") & message.rlike(NULL_PATTERN),
            _fill(TEXT_NULL, F.regexp_extract(message, NULL_PATTERN, 1)),
        )
        .when(_has(message, "InvalidTextRepresentation") & _has(F.lower(message), "json"), F.lit(TEXT_JSON))
        .when(_has(message, "InvalidTextRepresentation") & _has(message, "numeric", "integer"), F.lit(TEXT_NUMBER))
        .when(_has(message, "OutOfBoundsDatetime", "invalid input syntax for type date"), F.lit(TEXT_DATE))
        .when(_has(message, "CardinalityViolation"), F.lit(TEXT_DUPLICATE))
        .otherwise(_fill(TEXT_OTHER, title_words(table)))
    )


def action_for_error(message: Column) -> Column:
    """What to do about a technical message."""
    rules: Sequence[tuple[Column, str]] = (
        (_has(message, "ForeignKeyViolation"), ACTION_FK),
        (_has(message, "UndefinedColumn"), ACTION_COLUMN),
        (_has(message, "NotNullViolation"), ACTION_NULL),
        (_has(message, "InvalidTextRepresentation") & _has(message, "numeric"), ACTION_NUMBER),
        (_has(message, "OutOfBoundsDatetime"), ACTION_DATE),
        (_has(message, "CardinalityViolation"), ACTION_DUPLICATE),
    )
    return _first_rule(rules, F.lit(ACTION_OTHER))


def classify_reason(reason: Column) -> Column:
    """Business text of a rejection reason."""
    columns = F.translate(F.regexp_extract(reason, MISSING_PATTERN, 1), "'\"", "")
    return (
        F.when(reason.rlike(MISSING_PATTERN), _fill(REASON_MISSING, columns))
        .when(_has(reason, "Type coercion failed"), F.lit(REASON_FORMAT))
        .otherwise(_fill(REASON_OTHER, reason))
    )


def action_for_reason(reason: Column) -> Column:
    """What to do about a rejection reason."""
    rules = (
        (_has(reason, "Missing required data"), ACTION_REASON_MISSING),
        (_has(reason, "Type coercion failed"), ACTION_REASON_FORMAT),
    )
    return _first_rule(rules, F.lit(ACTION_REASON_OTHER))


def reason_kind(reason: Column) -> Column:
    """A reason without the value it quotes, so that the number of kinds does not grow with the data."""
    cut = F.regexp_replace(reason, r"(?s)^(Type coercion failed: could not convert string to float): .*$", "$1")
    cut = F.regexp_replace(cut, r"(?s)^(Value not allowed in [^:]+): .*$", "$1")
    return F.regexp_replace(
        cut, r"(?s)^(Foreign key violation: [^=]+)=.* not found in (\S+)(?: \(reference table is empty\))?$", "$1 not found in $2"
    )


def _first_rule(rules: Sequence[tuple[Column, str]], default: Column) -> Column:
    chain = None
    for condition, text in rules:
        chain = F.when(condition, F.lit(text)) if chain is None else chain.when(condition, F.lit(text))
    return chain.otherwise(default)
