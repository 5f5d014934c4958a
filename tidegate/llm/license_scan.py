"""Operator 12: license wordings in documents, by diagonal voting over word k-grams.

Words are runs of digits, letters a to z after lower-casing A to Z, and characters outside ASCII. The rolling hashes of all
word k-grams of every text are joined with the places of the templates' k-grams. A match votes for its template and its
diagonal, the place in the text less the place in the template; votes are aggregated by diagonal, neighbouring diagonals of a
template (words added or left out shift the diagonal) are merged into a span, and spans are verified on the words of the text:
phrases and names must stand word by word, a notice needs MIN_SHARE of its words in order inside the span's window.
Phrases and names use grams of SHORT words, notices grams of LONG words.

Matches and spans belong to a class of equal texts, known by two 64-bit hashes of the text, so copies are joined and merged
once; each row of documents then gets the spans of its class by a join that adaptive execution may split. The gram table is
broadcast only when it is below GRAM_BYTES. A stretch of one text and template is sorted in one task; it is bounded by
the length of that text.

Defined results: a null text is an empty one without words; no base place gives null first_word and last_word; no label gives an
empty string and, without a verified span, score 0; repeated rows each get their row; a null doc_id stays null; no rows give no
rows; other columns are not read. Words, grams and texts are known by hashes of 64 bits and more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidegate.llm import scan
from tidegate.llm.common import stage
from tidegate.llm.license_texts import TEMPLATES, Template

SHORT, LONG = 2, 5
MERGE_GAP = 4
MIN_SHARE = 0.8
GRAM_BYTES = 8 << 20
SLICE_WORDS = 1 << 15

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True

GRAMS = "class_a bigint, class_b bigint, width int, first bigint, grams array<bigint>"
FOUND = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
         "score double, spans array<struct<label: string, template: int, first_word: bigint, last_word: bigint, share: double>>")


class Wording(NamedTuple):
    """A template as word hashes: grams of `width` words, and how far merged diagonals may lie apart."""

    label: str
    base: bool
    exact: bool
    words: np.ndarray
    width: int
    gap: int


def word_hashes(texts: scan.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words before each text) in a chunk of texts."""
    data = texts.lowered()
    edge = np.zeros(len(data) + 1, bool)
    edge[texts.bounds] = True
    inside = np.concatenate([[False], _WORD[data], [False]])
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return scan.span_hashes(data, starts, ends), np.searchsorted(starts, texts.bounds)


def wordings(templates: Sequence[Template]) -> list[Wording]:
    out = []
    for template in templates:
        raw = np.frombuffer(template.text.encode(), np.uint8)
        words, _ = word_hashes(scan.Texts(raw, np.array([0, len(raw)])))
        width = SHORT if template.exact else LONG
        if len(words) < width:
            raise ValueError(f"a template of {len(words)} words has no grams of {width}")
        out.append(Wording(template.label, template.base, template.exact, words, width,
                           0 if template.exact else min(MERGE_GAP, len(words) // 3)))
    return out


def _gram_table(spark: SparkSession, known: list[Wording]) -> DataFrame:
    rows = [(w.width, int(gram), number, place) for number, w in enumerate(known)
            for place, gram in enumerate(scan.combine(w.words, w.width).view(np.int64))]
    table = spark.createDataFrame(rows, "width int, gram bigint, template int, place int")
    return F.broadcast(table) if len(rows) * 64 <= GRAM_BYTES else table


def _classed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("class_a"),
                       F.xxhash64(text, F.lit(1)).alias("class_b"))


def text_grams(docs: DataFrame, widths: Sequence[int]) -> DataFrame:
    """All rolling gram hashes of every text, in slices of at most SLICE_WORDS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in scan.text_chunks(batch.column(2)):
                words, begins = word_hashes(texts)
                for width in widths:
                    counts = np.maximum(np.diff(begins) - width + 1, 0)
                    slices = -(-counts // SLICE_WORDS)
                    rows = np.repeat(np.arange(b - a), slices)
                    number = np.arange(len(rows)) - np.repeat(slices.cumsum() - slices, slices)
                    first = number * SLICE_WORDS
                    lengths = np.minimum(counts[rows] - first, SLICE_WORDS)
                    # The last width - 1 words of a text start no gram.
                    starts = np.zeros(len(words) + 1, np.int64)
                    np.add.at(starts, begins[:-1][counts > 0], 1)
                    np.add.at(starts, (begins[:-1] + counts)[counts > 0], -1)
                    grams = scan.combine(words, width)
                    grams = grams[starts.cumsum()[:len(grams)] > 0]
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(a, b - a).take(pa.array(rows)), batch.column(1).slice(a, b - a).take(pa.array(rows)),
                        pa.array(np.full(len(rows), width, np.int32)), pa.array(first),
                        pa.ListArray.from_arrays(pa.array(np.append(0, lengths.cumsum()), pa.int32()), pa.array(grams.view(np.int64)))],
                        ["class_a", "class_b", "width", "first", "grams"])

    return docs.select("class_a", "class_b", "text").mapInArrow(run, GRAMS)


def find_spans(docs: DataFrame, known: list[Wording]) -> DataFrame:
    """One written row per class of texts with matches: its spans (template, least and greatest diagonal, words that voted)."""
    spark = docs.sparkSession
    grams = text_grams(docs, sorted({w.width for w in known})).select(
        "class_a", "class_b", "width", "first", F.posexplode("grams").alias("offset", "gram"))
    hits = grams.join(_gram_table(spark, known), ["width", "gram"]).withColumn("diagonal", F.col("first") + F.col("offset") - F.col("place"))
    # A diagonal has at most one place of each gram of its template, copies of a text included.
    votes = hits.groupBy("class_a", "class_b", "template", "diagonal").agg(F.sort_array(F.collect_set("place")).alias("places"))
    rules = spark.createDataFrame([(n, len(w.words) - w.width + 1 if w.exact else 1, w.gap, w.width) for n, w in enumerate(known)],
                                  "template int, least int, gap int, width int")
    votes = votes.join(F.broadcast(rules) if len(known) * 64 <= GRAM_BYTES else rules, "template").filter(F.size("places") >= F.col("least"))
    inside = Window.partitionBy("class_a", "class_b", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(inside) > F.col("gap"), F.lit(True))
    stretches = votes.withColumn("apart", apart.cast("int")).withColumn("stretch", F.sum("apart").over(inside))
    spans = stretches.groupBy("class_a", "class_b", "template", "stretch").agg(
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"),
        F.min(F.col("diagonal") + F.element_at("places", 1)).alias("first"),
        F.max(F.col("diagonal") + F.element_at("places", -1) + F.col("width") - 1).alias("last"))
    listed = spans.groupBy("class_a", "class_b").agg(F.sort_array(F.collect_list(F.struct("first", "last", "template", "low", "high"))).alias("found"))
    return stage(listed, "license-spans")


def common_in_order(words: np.ndarray, wanted: np.ndarray) -> int:
    """Length of the longest common subsequence, one numpy pass per wanted word."""
    best = np.zeros(len(words) + 1, np.int64)
    for word in wanted:
        best[1:] = np.maximum(best[1:], best[:-1] + (words == word))
        np.maximum.accumulate(best, out=best)
    return int(best[-1])


def _share(words: np.ndarray, wording: Wording, low: int, high: int) -> float:
    """Which part of a template's words stands in a span's window; for exact ones all or nothing."""
    if wording.exact:
        return float(np.array_equal(words[low:low + len(wording.words)], wording.words))
    window = words[max(low - wording.gap, 0):high + len(wording.words) + wording.gap]
    return common_in_order(window, wording.words) / len(wording.words)


def _verified(words: np.ndarray, spans: list[dict], known: list[Wording]) -> list[dict]:
    out = []
    for span in spans:
        wording = known[span["template"]]
        share = _share(words, wording, span["low"], span["high"])
        if share >= MIN_SHARE:
            out.append({"label": wording.label, "template": span["template"], "first_word": span["first"],
                        "last_word": span["last"], "share": share})
    return out


def _row(n_words: int, spans: list[dict], known: list[Wording]) -> tuple:
    base = [s for s in spans if known[s["template"]].base]
    places = [s["first_word"] for s in base]
    return (n_words, len(base), min(places, default=None), max(places, default=None), ",".join(sorted({s["label"] for s in base})),
            ",".join(sorted({s["label"] for s in spans})), max((s["share"] for s in spans), default=0.0), spans)


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per row of `docs` (doc_id, text) with its verified license wordings."""
    known = wordings(templates)
    classed = _classed(docs)
    found = find_spans(classed, known)
    joined = classed.join(found, ["class_a", "class_b"], "left").select("doc_id", "text", "found")
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([
        ("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("share", pa.float64())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in scan.text_chunks(batch.column(1)):
                words, begins = word_hashes(texts)
                spans = batch.column(2).slice(a, b - a).to_pylist()
                rows = [_row(int(end - start), _verified(words[start:end], own or [], known), known)
                        for start, end, own in zip(begins[:-1], begins[1:], spans)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(
                    pa.array(values, t) for values, t in zip(zip(*rows), types))], names)

    return joined.mapInArrow(run, FOUND)
