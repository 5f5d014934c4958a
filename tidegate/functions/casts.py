"""Guarded casts as SQL text: a text becomes a value only in the forms a contract allows.

Spark's own casts accept more ('+5' as a number, 'yes' as true, '2026' as a date) and drop a
zone offset silently, so every form is checked by a pattern first; anything else is NULL.
"""

from __future__ import annotations

from tidegate.sources.specs import ColumnSpec

_SPACE = " \t\n\r\f\u000b"
_INT = "^-?[0-9]+$"
_DECIMAL = "^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_BASIC_DATE = "^([0-9]{4})([0-9]{2})([0-9]{2})$"
_TIMESTAMP = "^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,6})?)?)?$"


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stripped(text: str) -> str:
    return f"btrim({text}, {quoted(_SPACE)})"


def to_int(text: str) -> str:
    return f"if({text} RLIKE '{_INT}', try_cast({text} AS bigint), NULL)"


def to_money(text: str, scale: int) -> str:
    """Half-even rounding to the declared scale; what does not fit 18 digits is not a value."""
    exact = f"if({text} RLIKE '{_DECIMAL}', try_cast({text} AS decimal(38,20)), NULL)"
    return f"try_cast(bround({exact}, {scale}) AS decimal(18,{scale}))"


def to_date(text: str) -> str:
    dashed = f"regexp_replace({text}, '{_BASIC_DATE}', '$1-$2-$3')"
    return f"if({dashed} RLIKE '{_DATE}', try_cast({dashed} AS date), NULL)"


def to_timestamp(text: str) -> str:
    return f"if({text} RLIKE '{_TIMESTAMP}', try_cast(replace({text}, ',', '.') AS timestamp_ntz), NULL)"


def to_bool(text: str) -> str:
    return f"CASE lower({text}) WHEN 'true' THEN true WHEN 'false' THEN false END"


def typed(clean: str, text: str, column: ColumnSpec) -> str:
    """The value of a text under its contract, NULL when it is blank or cannot be read.

    `clean` is the stripped text ('' for a blank one), `text` the text as delivered.
    """
    if column.type == "string":
        return f"if({clean} = '', NULL, {text})"
    if column.type == "int":
        return to_int(clean)
    if column.type == "decimal":
        return to_money(clean, column.scale)
    if column.type == "date":
        return to_date(clean)
    if column.type == "timestamp":
        return to_timestamp(clean)
    if column.type == "bool":
        return to_bool(clean)
    return f"nullif({clean}, '')"
