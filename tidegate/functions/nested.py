"""Column builders that walk a nested schema: redaction, text atoms, named secrets.

The walk happens once, over the schema; the result is one expression, so the rows are
rewritten and searched by Spark with neither a Python function nor a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

SENSITIVE_FIELDS = ("ssn", "credit_card", "api_key", "phone_number", "password")  # fixed values
REDACTED = "[REDACTED]"  # fixed value

_TEXTS = "array<string>"
_SECRETS = "array<struct<path:string,value:string>>"


def _complex(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def _none(array_type: str) -> Column:
    return F.array().cast(array_type)


def _concat(parts: list[Column], array_type: str) -> Column:
    return F.concat(*parts) if parts else _none(array_type)


def redact(value: Column, kind: T.DataType, names: tuple[str, ...] = SENSITIVE_FIELDS) -> Column:
    """The same value with everything under a sensitive name replaced, at any depth."""
    if isinstance(kind, T.StructType):
        fields = [
            (F.lit(REDACTED) if f.name in names else redact(value[f.name], f.dataType, names)).alias(f.name)
            for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType) and _complex(kind.elementType):
        return F.transform(value, lambda x: redact(x, kind.elementType, names))
    if isinstance(kind, T.MapType):
        text = isinstance(kind.valueType, T.StringType)

        def entry(key, item):
            inner = redact(item, kind.valueType, names)
            shown = inner if text else F.to_json(inner) if _complex(kind.valueType) else inner.cast("string")
            return F.when(key.cast("string").isin(*names), F.lit(REDACTED)).otherwise(shown)

        return F.transform_values(value, entry)
    return value


def atoms(value: Column, kind: T.DataType) -> Column:
    """Every text in the value: string leaves, map keys, and the names of its fields."""
    if isinstance(kind, T.StructType):
        named = F.array(*[F.lit(f.name) for f in kind.fields])
        inner = [atoms(value[f.name], f.dataType) for f in kind.fields]
        return F.when(value.isNotNull(), _concat([named, *inner], _TEXTS)).otherwise(_none(_TEXTS))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType):
            found = F.array_compact(value)
        elif _complex(kind.elementType):
            found = F.flatten(F.transform(value, lambda x: atoms(x, kind.elementType)))
        else:
            return _none(_TEXTS)
        return F.coalesce(found, _none(_TEXTS))
    if isinstance(kind, T.MapType):
        parts = [F.map_keys(value)] if isinstance(kind.keyType, T.StringType) else []
        parts.append(atoms(F.map_values(value), T.ArrayType(kind.valueType)))
        return F.when(value.isNotNull(), _concat(parts, _TEXTS)).otherwise(_none(_TEXTS))
    if isinstance(kind, T.StringType):
        return F.array_compact(F.array(value))
    return _none(_TEXTS)


def _secret(path: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), value.cast("string").alias("value"))


def secrets(value: Column, kind: T.DataType, names: tuple[str, ...] = SENSITIVE_FIELDS,
            path: Column | None = None) -> Column:
    """(path, value) of every text found under a sensitive name, before redaction."""

    def below(name: Column) -> Column:
        return name if path is None else F.concat(path, F.lit("."), name)

    if isinstance(kind, T.StructType):
        parts = []
        for f in kind.fields:
            where = below(F.lit(f.name))
            if f.name in names and isinstance(f.dataType, T.StringType):
                parts.append(F.array_compact(F.array(F.when(value[f.name] != "", _secret(where, value[f.name])))))
            elif _complex(f.dataType):
                parts.append(secrets(value[f.name], f.dataType, names, where))
        return F.coalesce(_concat(parts, _SECRETS), _none(_SECRETS)) if parts else _none(_SECRETS)
    if isinstance(kind, T.ArrayType) and _complex(kind.elementType):
        start = F.lit("") if path is None else path

        def element(x, i):
            return secrets(x, kind.elementType, names, F.concat(start, F.lit("["), i.cast("string"), F.lit("]")))

        return F.coalesce(F.flatten(F.transform(value, element)), _none(_SECRETS))
    if isinstance(kind, T.MapType):
        entries = F.map_entries(value)
        parts = []
        if isinstance(kind.valueType, T.StringType):
            hits = F.filter(entries, lambda e: e["key"].cast("string").isin(*names)
                            & e["value"].isNotNull() & (e["value"] != ""))
            parts.append(F.transform(hits, lambda e: _secret(below(e["key"].cast("string")), e["value"])))
        elif _complex(kind.valueType):
            parts.append(F.flatten(F.transform(entries, lambda e: secrets(
                e["value"], kind.valueType, names, below(e["key"].cast("string"))))))
        return F.coalesce(_concat(parts, _SECRETS), _none(_SECRETS)) if parts else _none(_SECRETS)
    return _none(_SECRETS)


def any_text(texts: Column, test: Callable[[Column], Column]) -> Column:
    """True when some text meets the test; never NULL."""
    return F.coalesce(F.exists(texts, test), F.lit(False))
