"""Operator 1: a quality score per document from a sparse ensemble of rules over text statistics.

Small trees on a bounded sample of labelled documents give conjunctive rules, a lasso logistic fit
weighs them, and the rules become one column expression. FIT_ROWS is the bound of the sample:
the labelled documents with the smallest hash of their id. Labels, ids, language and source are
never statistics.

Defined results: a null text is an empty one, and both are scored like any other; documents with a
null label, several labels of one document that differ, and held-out documents teach nothing; without
two kinds of labels every score is the smoothed share of label 1; equal rows get equal scores; of several
texts of one labelled doc_id the one with the least statistics teaches, so the driver gets at most FIT_ROWS rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegate.llm import rules, scan
from tidegate.llm.common import fresh_name, held_out

FIT_ROWS = 20_000
THRESHOLD = 0.3
STATISTICS = (
    "bytes", "words", "bytes_per_word", "longest_word", "upper_share", "digit_share", "mark_share", "bang_share",
    "bar_share", "symbol_share", "repeated_mark_share", "wide_share", "white_share", "lines", "words_per_line",
    "distinct_words", "distinct_lines", "word_mark_share", "upper_word_share", "sentence_mark_share",
)
_CLASSES = 9  # the byte classes below
_CLASS = np.zeros((_CLASSES, 256), bool)
_CLASS[0, 65:91] = True
_CLASS[1, 48:58] = True
_CLASS[2, [b for b in range(33, 127) if not chr(b).isalnum()]] = True
_CLASS[3, ord("!")] = True
_CLASS[4, ord("|")] = True
_CLASS[5, [ord(c) for c in "#$%&*+<=>@^~\\_{}[]"]] = True
_CLASS[6, 128:] = True
_CLASS[7, [0x20, *range(0x09, 0x0E)]] = True
_CLASS[8, [ord(c) for c in ".,;:?"]] = True


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.float64)


def _distinct(keys: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Distinct values per text."""
    _, first = np.unique(keys + scan.mix(owner.astype(np.uint64)), return_index=True)
    return np.bincount(owner[first], minlength=texts).astype(np.float64)


def statistics(texts: scan.Texts) -> np.ndarray:
    """One row of STATISTICS per text."""
    data, bounds, n = texts.data, texts.bounds, len(texts)
    size = np.diff(bounds).astype(np.float64)
    upper, digit, mark, bang, bar, symbol, wide, white, sentence = (_per_text(c[data], bounds) for c in _CLASS)
    repeated = np.zeros(len(data), bool)
    repeated[1:] = (data[1:] == data[:-1]) & _CLASS[2][data[1:]]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    repeated[inner] = False
    starts, stops, owner = texts.words()
    words = np.bincount(owner, minlength=n).astype(np.float64)
    longest = np.zeros(n)
    np.maximum.at(longest, owner, (stops - starts).astype(np.float64))
    ends_marked = np.bincount(owner, _CLASS[2][data[stops - 1]] if len(stops) else None, n)
    all_upper = _per_text_words(data, starts, stops, owner, n)
    distinct_words = _distinct(scan.span_hashes(data, starts, stops), owner, n)
    breaks = np.flatnonzero(data == 0x0A)
    line_starts = np.unique(np.concatenate([bounds[:-1][size > 0], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_owner = np.searchsorted(bounds, line_starts, "right") - 1
    line_ends = np.append(line_starts[1:], len(data)) if len(line_starts) else line_starts
    lines = np.bincount(line_owner, minlength=n).astype(np.float64)
    distinct_lines = _distinct(scan.span_hashes(data, line_starts, line_ends), line_owner, n)
    share = lambda a, b: a / np.maximum(b, 1)
    return np.stack([
        size, words, share(size - white, words), longest, share(upper, size), share(digit, size), share(mark, size),
        share(bang, size), share(bar, size), share(symbol, size), share(_per_text(repeated, bounds), size), share(wide, size),
        share(white, size), lines, share(words, lines), share(distinct_words, words), share(distinct_lines, lines),
        share(ends_marked, words), share(all_upper, words), share(sentence, size)], 1).round(9)


def _per_text_words(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many words hold capitals and no small ASCII letter."""
    small = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
    large = np.concatenate([[0], np.cumsum(_CLASS[0][data])])
    loud = (small[stops] == small[starts]) & (large[stops] > large[starts])
    return np.bincount(owner, loud, n)


def with_statistics(docs: DataFrame, name: str = "_statistics") -> DataFrame:
    """All columns of `docs` and an array of STATISTICS over its column `text`."""
    at = docs.columns.index("text")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in scan.text_chunks(batch.column(at)):
                values = statistics(texts)
                column = pa.ListArray.from_arrays(
                    pa.array(np.arange(b - a + 1) * len(STATISTICS), pa.int32()), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, column], [*names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    return docs.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> rules.Ensemble:
    """Fit on at most `fit_rows` labelled documents (doc_id, quality) that are not held out."""
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out("doc_id", 0))
    agreed = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_most")).filter(
        "quality = _most").drop("_most")
    chosen = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # At most fit_rows ids and labels, so the broadcast is bounded.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    each = with_statistics(rows).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("_statistics").alias("_statistics"))
    found = each.orderBy("doc_id").toPandas()
    x = np.array(found["_statistics"].tolist(), np.float64).reshape(-1, len(STATISTICS))
    return rules.fit(x, found["quality"].to_numpy(np.float64))


def score_column(ensemble: rules.Ensemble, values: str = "_statistics") -> Column:
    """The score as a column expression over the array of statistics."""

    def holds(conditions) -> Column:
        tests = [F.col(values)[f] > F.lit(t) if above else F.col(values)[f] <= F.lit(t) for f, above, t in conditions]
        return reduce(lambda a, b: a & b, tests)

    odds = F.lit(ensemble.bias)
    for rule in ensemble.rules:
        odds = odds + F.when(holds(rule.conditions), F.lit(rule.weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-odds))


def score(docs: DataFrame, ensemble: rules.Ensemble, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = with_statistics(docs.select("doc_id", "text")).select(
        "doc_id", held_out("doc_id", 0).alias("held_out"), score_column(ensemble).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, ensemble: rules.Ensemble, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that the ensemble does not reject, with their columns."""
    name = fresh_name(docs, "_statistics")
    return with_statistics(docs, name).filter(score_column(ensemble, name) >= threshold).select(*docs.columns)
