"""Scan a corpus of legacy SQL scripts for constructs that have no safe translation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.codes import codes_where

# Code and pattern, matched case-blind on the text without comments.
BLOCKERS = (
    ("cursor", r"\bDECLARE\s+\w+\s+CURSOR\b|\bFETCH\s+NEXT\b"),
    ("while_loop", r"\bWHILE\b"),
    ("try_catch", r"\bBEGIN\s+TRY\b|\bBEGIN\s+CATCH\b"),
    ("transaction", r"\bBEGIN\s+TRAN(SACTION)?\b|\bCOMMIT\b|\bROLLBACK\b"),
    ("temp_table", r"(?<![\w@])#\w+"),
    ("dynamic_sql", r"\bsp_executesql\b|\bEXEC(UTE)?\s*\("),
    ("rowcount_error_globals", r"@@(ROWCOUNT|ERROR|TRANCOUNT)\b"),
    ("nondeterministic_clock", r"\b(GETDATE|SYSDATETIME|CURRENT_TIMESTAMP|GETUTCDATE)\b"),
)
HAZARD = "datediff_boundary_semantics"
_DATEDIFF_UNIT = r"(?iU)\bDATEDIFF\s*\(\s*(?!(day|dd|d)\s*,)\w+\s*,"


def without_comments(script: Column) -> Column:
    blocks = F.regexp_replace(script, r"(?s)/\*.*?\*/", " ")
    return F.regexp_replace(blocks, r"--[^\n]*", " ")


def scan(df: DataFrame, script: str, name: str = "findings") -> DataFrame:
    """Adds the sorted blocker codes and the hazard code of each script."""
    cleaned = df.withColumn("_plain", without_comments(F.col(script)))
    coded = sorted(BLOCKERS)
    found = codes_where(*[(code, F.col("_plain").rlike("(?iU)" + pattern)) for code, pattern in coded],
                        (HAZARD, F.col("_plain").rlike(_DATEDIFF_UNIT)))
    return cleaned.withColumn(name, found).drop("_plain")


def month_boundaries(start: Column, end: Column) -> Column:
    """Month boundaries crossed between two dates; Spark's own difference counts whole months."""
    return (F.year(end) * 12 + F.month(end) - F.year(start) * 12 - F.month(start)).cast("bigint")
