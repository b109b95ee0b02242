"""JSON held in text columns: validity, lists, repair of quotes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rowharbor.functions.text import VALUE_TOKENS, is_missing, list_items

_STRICT = {"allowSingleQuotes": "false"}
#: A number, literal or string of JSON with blanks around it; such texts need no parser.
_SCALAR = (
    r"^[ \t\r\n]*(-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?|true|false|null|NaN|-?Infinity"
    r'|"([^"\\\x00-\x1f]|\\(["\\/bfnrt]|u[0-9a-fA-F]{4}))*")[ \t\r\n]*$'
)
_NESTED = r"^[ \t\r\n]*[\[{]"


def is_json(c: Column) -> Column:
    """True when the whole text is one JSON value.

    A parse alone would accept trailing text, so a list or object is parsed once as
    the only item of a list and once as the only field of an object: text after it
    breaks at least one of the two.
    """
    as_item = F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>", _STRICT)
    as_field = F.from_json(F.concat(F.lit('{"v":'), c, F.lit("}")), "v string", _STRICT)
    nested = (F.size(as_item) == 1) & as_field["v"].isNotNull()
    return F.coalesce(F.when(c.rlike(_NESTED), nested).otherwise(c.rlike(_SCALAR)), F.lit(False))


def csv_to_array(c: Column) -> Column:
    """Comma-separated text as a JSON list; NULL when it has no items."""
    return F.to_json(list_items(c))


def to_json_or_array(c: Column) -> Column:
    """Valid JSON verbatim, anything else as a JSON list of its comma-separated items."""
    return F.when(~is_missing(c, VALUE_TOKENS), F.when(is_json(c), c).otherwise(csv_to_array(c)))


def repair_json(c: Column) -> Column:
    """Make a list or object written with single quotes valid JSON.

    Valid JSON and unbracketed text stay as they are. A bracketed text that cannot
    be read even with single quotes gets its quotes replaced. Blank becomes NULL.
    """
    bracketed = (c.startswith("[") & c.endswith("]")) | (c.startswith("{") & c.endswith("}"))
    as_item = F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<variant>")
    as_field = F.from_json(F.concat(F.lit('{"v":'), c, F.lit("}")), "v variant")
    requoted = F.when((F.size(as_item) == 1) & as_field["v"].isNotNull(), F.to_json(as_field["v"]))
    return F.when(
        c.isNotNull() & (c != ""),
        F.when(is_json(c) | ~bracketed, c).otherwise(F.coalesce(requoted, F.translate(c, "'", '"'))),
    )
