"""Evidence checks: redaction, marker and leak scans, citations, reply shapes, text flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tidegate.functions import nested
from tidegate.functions.nested import REDACTED, SENSITIVE_FIELDS

CANARY_MARKER = "CANARY-7f3a9c2e"  # the marker planted by default; a parameter everywhere
MIN_SECRET_LENGTH = 8  # fixed value: shorter texts match by chance

# An action whose name holds one of these words is never run.
PROHIBITED_VERBS = (
    "export", "delete", "drop", "truncate", "grant", "revoke", "write", "insert", "update", "upsert",
    "merge", "alter", "create", "upload", "send", "publish", "deploy", "copy", "move", "overwrite",
)

# Text that reads like an instruction. Case-blind, `.` crosses line breaks, and
# letters of any script count as word characters.
INSTRUCTION_PATTERNS = (
    r"\b(ignore|disregard|forget|override)\b.{0,40}\b(instructions?|rules?|prompt|policy)\b",
    r"\bmark\b.{0,40}\b(healthy|resolved|passed|clean|safe)\b",
    r"\b(approve|authori[sz]e)\b.{0,40}\b(recovery|replay|restore|action|export)\b",
    r"\b(replay_batch|restore_lead_invalid_rate|allowlist|allowed_tools)\b",
)
_FLAGS = "(?isU)"


def _packet(df: DataFrame, column: str) -> tuple[Column, T.DataType]:
    return F.col(column), df.schema[column].dataType


def redact_column(df: DataFrame, column: str, names: tuple[str, ...] = SENSITIVE_FIELDS) -> DataFrame:
    value, kind = _packet(df, column)
    return df.withColumn(column, nested.redact(value, kind, names))


def with_canary(df: DataFrame, column: str, name: str = "has_canary", marker: str = CANARY_MARKER) -> DataFrame:
    """Flags rows that hold the marker in any text or key."""
    value, kind = _packet(df, column)
    return df.withColumn(name, nested.any_text(nested.atoms(value, kind), lambda a: F.contains(a, F.lit(marker))))


def _judged(df: DataFrame, column: str, names: tuple[str, ...]) -> DataFrame:
    """Adds the redacted packet, its texts, and the secrets of the original."""
    value, kind = _packet(df, column)
    redacted = df.withColumn("_secrets", nested.secrets(value, kind, names)).withColumn(
        column, nested.redact(value, kind, names))
    value, kind = _packet(redacted, column)
    return redacted.withColumn("_atoms", nested.atoms(value, kind))


def _leaks() -> Column:
    """Secrets of 8 or more characters that some text of the redacted packet still holds."""
    return F.filter("_secrets", lambda s: (F.length(s["value"]) >= MIN_SECRET_LENGTH) & F.exists(
        F.col("_atoms"), lambda a: F.contains(a, s["value"])))


def evidence_gate(df: DataFrame, column: str, names: tuple[str, ...] = SENSITIVE_FIELDS,
                  marker: str = CANARY_MARKER) -> DataFrame:
    """Redacts `column` and adds `allowed` and `evidence_problems`.

    Problems name the path of a leaked value, never the value itself.
    """
    judged = _judged(df, column, names)
    leaks = F.transform(_leaks(), lambda s: F.concat(
        F.lit("sensitive value at "), s["path"], F.lit(" is also held elsewhere")))
    marked = F.when(nested.any_text(F.col("_atoms"), lambda a: F.contains(a, F.lit(marker))),
                    F.array(F.lit("canary marker after redaction"))).otherwise(F.array().cast("array<string>"))
    return (judged.withColumn("evidence_problems", F.concat(leaks, marked))
            .withColumn("allowed", F.size("evidence_problems") == 0).drop("_secrets", "_atoms"))


def gate_codes(problems: Column) -> Column:
    """The problem texts as fixed codes, sorted and distinct."""
    return F.array_sort(F.array_distinct(F.transform(problems, lambda p: F.when(
        p.startswith("canary"), "canary_present").when(p.startswith("sensitive value"), "sensitive_value_leak")
        .otherwise("evidence_gate_failed"))))


def secret_leaks(df: DataFrame, column: str, names: tuple[str, ...] = SENSITIVE_FIELDS) -> DataFrame:
    """Adds `leak_paths`: where the copied secrets came from."""
    judged = _judged(df, column, names)
    return judged.withColumn("leak_paths", F.transform(_leaks(), lambda s: s["path"])).drop("_secrets", "_atoms")


def gate_and_redact(record: DataFrame, marker: str = CANARY_MARKER) -> DataFrame:
    """A log record that is safe to write: redacted, and forced to failed when a check fires."""
    names = record.columns
    packed = record.select(F.struct(*names).alias("packet"))
    judged = evidence_gate(packed, "packet", marker=marker)
    return judged.select(
        *[(F.col("packet.passed") & F.col("allowed")).alias("passed") if n == "passed"
          else F.concat("packet.problems", "evidence_problems").alias("problems") if n == "problems"
          else F.col(f"packet.{n}") for n in names])


def has_instruction(text: Column) -> Column:
    """True when one text matches an instruction pattern."""
    hit = F.lit(False)
    for pattern in INSTRUCTION_PATTERNS:
        hit = hit | text.rlike(_FLAGS + pattern)
    return hit


def instruction_flag(value: Column, kind: T.DataType) -> Column:
    """True when any text of a nested value reads like an instruction."""
    return nested.any_text(nested.atoms(value, kind), has_instruction)


def is_prohibited(name: Column) -> Column:
    """True when the name holds a prohibited verb as a word (snake, kebab or camel case)."""
    spaced = F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1_$2")
    words = F.split(F.lower(spaced), "[^a-z0-9]+")
    return F.coalesce(F.arrays_overlap(words, F.array(*[F.lit(v) for v in PROHIBITED_VERBS])), F.lit(False))


# -- citations ---------------------------------------------------------------------

_CITATION = r"^([^.\[\]]+(\[\d{1,9}\])*|(\[\d{1,9}\])+)(\.[^.\[\]]+(\[\d{1,9}\])*)*$"


def _variant_path(citation: Column) -> Column:
    """rows[0].stage -> $['rows'][0]['stage']; NULL for what is not a citation path."""
    quote = F.when(F.contains(citation, F.lit("'")), F.lit('"')).otherwise(F.lit("'"))
    steps = F.regexp_replace(citation, r"(^|\.)([^.\[\]]+)", "[\u0001$2\u0001]")
    path = F.concat(F.lit("$"), F.translate(steps, "\u0001", "'"))
    doubled = F.concat(F.lit("$"), F.translate(steps, "\u0001", '"'))
    usable = citation.rlike(_CITATION) & ~(F.contains(citation, F.lit("'")) & F.contains(citation, F.lit('"')))
    return F.when(usable, F.when(quote == '"', doubled).otherwise(path))


def _visible(node_json: Column) -> Column:
    """False when a JSON value holds redaction markers and nothing else.

    String tokens are fenced with control characters, which JSON text never holds raw, so
    that keys and marker values can be told apart without parsing the value again.
    """
    # The possessive repeat loops; a plain one recurses and overflows the stack on long text.
    fenced = F.regexp_replace(node_json, r'("(?:[^"\\]|\\.)*+")', "\u0001$1\u0002")
    values = F.regexp_replace(fenced, "\u0001[^\u0001\u0002]*\u0002\\s*:", "")
    marked = F.regexp_replace(values, "\u0001\"\\[REDACTED\\]\"\u0002", "R")
    return marked.rlike(r"[^\[\]{},R\s]") | F.contains(marked, F.lit("[]")) | F.contains(marked, F.lit("{}"))


def check_citations(df: DataFrame, payload: str, citations: str, key: str) -> DataFrame:
    """One row per citation with its code: ok, unresolved_citation or redacted_citation."""
    cited = df.select(key, F.try_parse_json(payload).alias("_doc"), F.posexplode(citations).alias("position", "citation"))
    located = cited.withColumn("_path", _variant_path(F.col("citation")))
    safe_path = F.coalesce("_path", F.lit("$"))
    node = F.when(F.col("_path").isNotNull(), F.to_json(F.variant_get("_doc", safe_path, "variant")))
    return located.withColumn("_node", node).select(
        key, "position", "citation",
        F.when(F.col("_node").isNull(), "unresolved_citation").when(~_visible(F.col("_node")), "redacted_citation")
        .otherwise("ok").alias("code"))


# -- reply shapes ------------------------------------------------------------------

REPORT_FIELDS = ("summary", "uncertainty", "proposed_recovery")  # fixed values


def _kind(doc: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(doc, path, "variant"))


def _filled_text(doc: Column, path: str) -> Column:
    text = F.try_variant_get(doc, path, "string")
    return F.coalesce((_kind(doc, path) == "STRING") & text.rlike(r"\S"), F.lit(False))


def _is_object(doc: Column) -> Column:
    return F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))


def report_code(reply: Column) -> Column:
    """ok, malformed_response or no_citations for one report reply."""
    doc = F.try_parse_json(reply)
    filled = _is_object(doc)
    for name in REPORT_FIELDS:
        filled = filled & _filled_text(doc, f"$.{name}")
    cited = F.try_variant_get(doc, "$.citations", "array<variant>")
    all_texts = F.forall(cited, lambda c: F.coalesce(
        (F.schema_of_variant(c) == "STRING") & F.try_variant_get(c, "$", "string").rlike(r"\S"), F.lit(False)))
    missing = _kind(doc, "$.citations").isNull() | (_kind(doc, "$.citations") == "VOID")
    return (
        F.when(~filled, "malformed_response").when(missing, "no_citations")
        .when(cited.isNull(), "malformed_response").when(F.size(cited) == 0, "no_citations")
        .when(~F.coalesce(all_texts, F.lit(False)), "malformed_response").otherwise("ok")
    )


def classification_ok(reply: Column) -> Column:
    """True for {"label": text, "confidence": number in 0..1}; a boolean is not a number."""
    doc = F.try_parse_json(reply)
    number = _kind(doc, "$.confidence").rlike("^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$")
    value = F.try_variant_get(doc, "$.confidence", "double")
    return F.coalesce(_is_object(doc) & _filled_text(doc, "$.label") & number & value.between(0.0, 1.0), F.lit(False))


def tool_request_ok(reply: Column) -> Column:
    """True for {"tool_request": {"tool": text, "args": {name: scalar}}} and nothing else."""
    doc = F.try_parse_json(reply)
    outer = F.map_keys(F.try_variant_get(doc, "$", "map<string,variant>"))
    inner = F.map_keys(F.try_variant_get(doc, "$.tool_request", "map<string,variant>"))
    args = F.try_variant_get(doc, "$.tool_request.args", "map<string,variant>")
    scalar = F.forall(F.map_values(args), lambda v: ~F.schema_of_variant(v).rlike("^(ARRAY|OBJECT)"))
    args_given = F.array_contains(inner, "args")
    return F.coalesce(
        _is_object(doc) & (F.size(outer) == 1) & F.array_contains(outer, "tool_request")
        & (F.size(F.array_except(inner, F.array(F.lit("tool"), F.lit("args")))) == 0)
        & _filled_text(doc, "$.tool_request.tool")
        & (~args_given | F.coalesce(args.isNotNull() & scalar, F.lit(False))), F.lit(False))
