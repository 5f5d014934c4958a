"""Contract checks of an extract: its columns, and every problem of every row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidegate.functions import casts
from tidegate.functions.codes import entries_where
from tidegate.operators.expectations import fail_on
from tidegate.operators.ordering import latest_per_key
from tidegate.sources.specs import ColumnSpec, DatasetSpec

# Row-level reason codes.
MISSING_REQUIRED = "missing_required"
NULL_PRIMARY_KEY = "null_primary_key"
CAST_FAILED = "cast_failed"
INVALID_ENUM = "invalid_enum"
DUPLICATE_KEY = "duplicate_key"

PROBLEMS = "_problems"
RAW = "_raw"
PROBLEMS_TYPE = "array<struct<column:string,reason:string>>"


@dataclass(frozen=True)
class SchemaDiff:
    added: list[str]
    removed: list[str]
    removed_required: list[str]


def schema_diff(spec: DatasetSpec, observed: list[str]) -> SchemaDiff:
    """Delivered columns against the contract."""
    have, declared = set(observed), set(spec.columns)
    return SchemaDiff(sorted(have - declared), sorted(declared - have),
                      sorted(c for c in spec.required() if c not in have))


def _checks(clean: str, value: str, column: ColumnSpec, is_key: bool) -> list[tuple[str, str]]:
    """(condition, problem) of one column; at most one condition holds for a row."""

    def problem(reason: str) -> str:
        return f"named_struct('column', {casts.quoted(column.name)}, 'reason', '{reason}')"

    found = [(f"{clean} <> '' AND {value} IS NULL", problem(CAST_FAILED))]
    if column.required:
        found.append((f"{clean} = ''", problem(NULL_PRIMARY_KEY if is_key else MISSING_REQUIRED)))
    if column.type == "enum":
        allowed = ", ".join(casts.quoted(v) for v in column.values)
        found.append((f"{clean} <> '' AND {value} NOT IN ({allowed})", problem(INVALID_ENUM)))
    return found


def validate(spec: DatasetSpec, extract: DataFrame, keep_raw: bool = True) -> DataFrame:
    """Typed columns, all problems of the row in contract order, and the raw row as JSON.

    Each pattern and cast runs once per value. A filter on the problems would otherwise be
    pushed below the projections that compute them, and with it a copy of every pattern and
    cast per use; generating the values as a one-element array is a step it cannot pass.
    Typed values of a row with problems are not to be used.
    """
    delivered = extract.columns
    columns = list(spec.columns.values())
    texts = [f"cast(`{c.name}` AS string) AS `_text_{c.name}`" if c.name in delivered
             else f"cast(NULL AS string) AS `_text_{c.name}`" for c in columns]
    raw = [RAW] if keep_raw else []
    if keep_raw:
        fields = ", ".join(f"`{c}`" for c in sorted(delivered))
        texts.append(f"to_json(struct({fields}), map('ignoreNullFields', 'false')) AS {RAW}")
    # The window test of a rejected row reads its cursor text as delivered, unstripped.
    kept_texts = {spec.cursor_column, *[c.name for c in columns if c.type == "string"]}
    cleaned = [f"coalesce({casts.stripped(f'`_text_{c.name}`')}, '') AS `_clean_{c.name}`" for c in columns]
    values = [f"{casts.quoted(c.name)}, cast({casts.typed(f'`_clean_{c.name}`', f'`_text_{c.name}`', c)}"
              f" AS {c.ddl})" for c in columns]
    values.append(f"'_raw_cursor', {casts.to_timestamp(f'`_text_{spec.cursor_column}`')}")
    checks = [pair for c in columns
              for pair in _checks(f"`_clean_{c.name}`", f"`{c.name}`", c, c.name in spec.primary_key)]
    return (
        extract.selectExpr(*texts)
        .selectExpr(*cleaned, *[f"`_text_{c}`" for c in sorted(kept_texts)], *raw)
        .selectExpr("*", f"inline(array(named_struct({', '.join(values)})))")
        .selectExpr(*[f"`{c.name}`" for c in columns],
                    f"{entries_where(checks, PROBLEMS_TYPE)} AS {PROBLEMS}", "_raw_cursor", *raw)
    )


def valid_rows(spec: DatasetSpec, extract: DataFrame) -> DataFrame:
    """Typed rows without problems."""
    checked = validate(spec, extract, keep_raw=False)
    return checked.filter(F.size(PROBLEMS) == 0).select(*spec.columns)


def restore(spec: DatasetSpec, saved: DataFrame) -> DataFrame:
    """Saved text rows as typed rows again; a row that no longer meets the contract stops the job."""
    checked = validate(spec, saved, keep_raw=False)
    return fail_on(checked, {"matches_contract": f"size({PROBLEMS}) = 0"}).select(*spec.columns)


def latest_valid(spec: DatasetSpec, extract: DataFrame) -> DataFrame:
    """One valid row per key: the newest cursor, the rest of the row breaking ties."""
    return latest_per_key(valid_rows(spec, extract), list(spec.primary_key), [spec.cursor_column])
