"""Operator 10: scores of a word-pair model whose counts live in a log-frequency Bloom filter.

Tokens are the lower-cased (A-Z) words of a text and one end. Words and pairs are counted over all
training documents: every task counts inside its batches, the counts meet by shards of the key
space, and each shard becomes a segment of the filter, with the same bits for an insertion at every size of the
corpus. Segments up to FILTER_BYTES in all are one broadcast that a worker keeps; a larger filter is handed out in
groups of at most FILTER_GROUP_BYTES (or one segment), which tasks load one after the other for many chunks of text together.

The model interpolates P(w | u) = s * c(u, w) / c(u) + (1 - s) * P1(w), with P1 the smoothed share of w and counts
read from the filter by repeated probes; after an unseen u it is P1(w). The base score uses exact counts, which
are handed to the tasks in groups of at most GROUP_BYTES, one group in memory at a time.

Words and pairs are known by 64-bit hashes. Defined results: a null text is an empty one, whose only token
is the end; a null doc_id is a training document; repeated rows each count and each get a score; without
training documents every token has c = 0, N = 0 and V = 0; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import bloom, scan
from tidegate.llm.common import held_out, shuffle_partitions, stage

HELD_OUT = 1
PAIR_SHARE = 0.2
BITS_PER_INSERTION = 8.0
FILTER_BYTES, FILTER_GROUP_BYTES = 1 << 28, 64 << 20
CHUNKS_TOGETHER = 16  # of text, where groups are loaded in turn
GROUP_BYTES = 32 << 20
END, START = np.uint64(0x1B873593CC9E2D51), np.uint64(0x52DCE729E6546B64)
_PAIR_KEY = np.uint64(0xE7037ED1A0B428DB)
_ENTRY_BYTES = 16
SHARDS_PER_TASK = 4  # a task holds the counts of one shard at a time


def tokens(texts: scan.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(keys of all tokens in order, text index of each); every text ends with END."""
    lowered = texts.lowered()
    starts, stops, owner = texts.words()
    keys = scan.span_hashes(lowered, starts, stops)
    ends = np.searchsorted(owner, np.arange(len(texts)), "right")
    return np.insert(keys, ends, END), np.insert(owner, ends, np.arange(len(texts)))


def pair_keys(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key of the token before each token, key of the pair)."""
    before = np.empty_like(keys)
    before[:1], before[1:] = START, keys[:-1]
    before[1:][owner[1:] != owner[:-1]] = START
    return before, scan.mix(before * _PAIR_KEY + keys)


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Counts of each batch, cut by shard: (pairs or words, shard, keys, counts)."""
    for batch in batches:
        found: tuple[list, list] = ([], [])
        for _, _, texts in scan.text_chunks(batch.column(0)):
            keys, owner = tokens(texts)
            found[0].append(keys)
            found[0].append(np.full(len(texts), START))  # as a context: once per text
            found[1].append(pair_keys(keys, owner)[1])
        for pairs, lists in enumerate(found):
            if not lists:
                continue
            every = np.sort(np.concatenate(lists))
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            keys, counts = every[first], np.diff(np.append(first, len(every)))
            shard = bloom.shard_of(keys, shards)
            order = np.argsort(shard, kind="stable")
            keys, counts, edges = keys[order], counts[order].astype("<u4"), np.searchsorted(shard[order], np.arange(shards + 1))
            full = np.flatnonzero(np.diff(edges))
            yield pa.RecordBatch.from_arrays([
                pa.array([bool(pairs)] * len(full)), pa.array(full, pa.int32()),
                pa.array([keys[edges[s]:edges[s + 1]].tobytes() for s in full], pa.binary()),
                pa.array([counts[edges[s]:edges[s + 1]].tobytes() for s in full], pa.binary()),
            ], ["pairs", "shard", "keys", "counts"])


def _build(batches: Iterator[pa.RecordBatch], bits: float) -> Iterator[pa.RecordBatch]:
    """Per shard, its filter segment, and for words their exact counts; rows come sorted by shard."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    words = None
    now, size = None, 0

    def fold() -> tuple[np.ndarray, np.ndarray]:
        if not held:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return _merged(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))

    def row(shard: int, words, pairs) -> pa.RecordBatch:
        keys, counts = words
        segment = bloom.segment(np.concatenate([keys, pairs[0]]), np.concatenate([counts, pairs[1]]), bits)
        own = keys != START  # a context only, not a token
        return pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int32()), pa.array([segment], pa.binary()), pa.array([keys[own].astype("<u8").tobytes()], pa.binary()),
            pa.array([counts[own].astype("<i8").tobytes()], pa.binary()), pa.array([int(own.sum())], pa.int64()),
            pa.array([int(counts[own].sum())], pa.int64())], ["shard", "segment", "word_keys", "word_counts", "n_words", "n_tokens"])

    empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    for batch in batches:
        for pairs, shard, keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                              scan.binary_views(batch.column(2)), scan.binary_views(batch.column(3))):
            if (shard, pairs) != now:
                if now is not None:
                    if now[1]:
                        yield row(now[0], words or empty, fold())
                        words = None
                    else:
                        words = fold()
                        if now[0] != shard:
                            yield row(now[0], words, empty)
                            words = None
                now, held, size = (shard, pairs), [], 0
            held.append((np.frombuffer(keys.tobytes(), "<u8"), np.frombuffer(counts.tobytes(), "<u4").astype(np.int64)))
            size += len(held[-1][0])
            if len(held) > 1 and size > 2 * len(held[0][0]) + (1 << 20):  # fold when what is new outweighs what is folded
                held = [fold()]
                size = len(held[0][0])
    if now is not None:
        yield row(now[0], words or empty, fold()) if now[1] else row(now[0], fold(), empty)


def _parts(sizes: list[tuple[int, int]], most: int) -> list[list[int]]:
    """Shards in order, cut into groups of at most `most` bytes or of one shard."""
    parts: list[list[int]] = []
    held = 0
    for shard, size in sizes:
        if not parts or held + size > most:
            parts.append([])
            held = 0
        parts[-1].append(shard)
        held += size
    return parts


class Model:
    """The broadcast filter (one or in groups), the exact totals, and the groups of exact word counts."""

    def __init__(self, spark: SparkSession, tables: DataFrame, shards: int):
        totals = tables.agg(F.sum("n_words").alias("v"), F.sum("n_tokens").alias("n")).first()
        self.n, self.v = int(totals["n"] or 0), int(totals["v"] or 0)
        lengths = sorted((r["shard"], r["n"]) for r in tables.select("shard", F.octet_length("segment").alias("n")).collect())
        most = FILTER_BYTES if sum(n for _, n in lengths) <= FILTER_BYTES else FILTER_GROUP_BYTES
        self.filters: list[Broadcast] = []
        for part in _parts(lengths, most) or [[]]:
            rows = tables.filter(F.col("shard").isin(part)).select("shard", "segment").toArrow()
            self.filters.append(spark.sparkContext.broadcast(
                bloom.joined(shards, list(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())))))
            del rows
        sizes = sorted((r["shard"], r["n_words"]) for r in tables.select("shard", "n_words").collect())
        self.groups: list[Broadcast] = []
        group: list[int] = []
        held = 0
        for shard, words in [*sizes, (None, 0)]:
            if group and (shard is None or (held + words) * _ENTRY_BYTES > GROUP_BYTES):
                rows = tables.filter(F.col("shard").isin(group)).select("word_keys", "word_counts").toArrow()
                keys = np.concatenate([np.frombuffer(k, "<u8") for k in rows.column(0).to_pylist()])
                counts = np.concatenate([np.frombuffer(c, "<i8") for c in rows.column(1).to_pylist()])
                del rows
                order = np.argsort(keys)
                # Plain bytes: a worker then holds them once.
                self.groups.append(spark.sparkContext.broadcast((keys[order].tobytes(), counts[order].tobytes())))
                group, held = [], 0
            if shard is not None:
                group.append(shard)
                held += words


def train(docs: DataFrame, bits_per_insertion: float = BITS_PER_INSERTION) -> Model:
    """Count the words and pairs of all texts of `docs` and build the filter."""
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    shards = SHARDS_PER_TASK * partitions
    counted = docs.select("text").mapInArrow(lambda b: _count(b, shards), "pairs boolean, shard int, keys binary, counts binary")
    meeting = counted.repartition(partitions, "shard").sortWithinPartitions("shard", "pairs")
    schema = "shard int, segment binary, word_keys binary, word_counts binary, n_words bigint, n_tokens bigint"
    return Model(spark, stage(meeting.mapInArrow(lambda b: _build(b, bits_per_insertion), schema), "lm-counts"), shards)


def _exact(words: np.ndarray, groups: list[Broadcast]) -> np.ndarray:
    """Training counts of the words; several groups are loaded and let go one after the other."""
    out = np.zeros(len(words), np.int64)
    for group in groups:
        keys, counts = (np.frombuffer(raw, kind) for raw, kind in zip(group.value, ("<u8", "<i8")))
        if len(keys):
            at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
            out += np.where(keys[at] == words, counts[at], 0)
        if len(groups) > 1:
            group.__dict__.pop("_value", None)
    return out


def _seen(keys: np.ndarray, filters: list[Broadcast]) -> np.ndarray:
    """Levels of the keys; a key is met only in the group that holds its shard, the others have no bits for it."""
    out = np.zeros(len(keys), np.int64)
    for part in filters:
        out += bloom.LogBloom(*part.value).levels(keys)
        if len(filters) > 1:
            part.__dict__.pop("_value", None)
    return out


def score(docs: DataFrame, model: Model, pair_share: float = PAIR_SHARE) -> DataFrame:
    """Base score and model score, log10, of every text of (doc_id, text, held_out)."""
    n, v, filters, groups = model.n, model.v, model.filters, model.groups
    floor = n + 0.5 * (v + 1)
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    together = CHUNKS_TOGETHER if max(len(filters), len(groups)) > 1 else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunks in batched(scan.text_chunks(batch.column(1)), together):
                parts = []
                for a, b, texts in chunks:
                    keys, owner = tokens(texts)
                    parts.append((a, b, keys, owner, *pair_keys(keys, owner)))
                words = np.unique(np.concatenate([[START], *(p[2] for p in parts)]))
                pairs = np.unique(np.concatenate([p[5] for p in parts]))
                levels = _seen(np.concatenate([words, pairs]), filters)
                single, double = bloom.VALUES[levels[:len(words)]], bloom.VALUES[levels[len(words):]]
                exact = _exact(words, groups)
                for a, b, keys, owner, before, both in parts:
                    word = np.searchsorted(words, keys)
                    counts = exact[word]
                    base = np.log10((counts + 0.5) / floor)
                    share = (single[word] + 0.5) / floor
                    seen = single[np.searchsorted(words, before)]
                    met = np.minimum(double[np.searchsorted(pairs, both)], seen)
                    chance = np.where(seen > 0, pair_share * met / np.maximum(seen, 1) + (1 - pair_share) * share, share)
                    rows = b - a
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(a, rows), batch.column(2).slice(a, rows),
                        pa.array(np.bincount(owner, minlength=rows).astype(np.int64)),
                        pa.array(np.bincount(owner, counts > 0, rows).astype(np.int64)), pa.array(np.full(rows, n, np.int64)),
                        pa.array(np.bincount(owner, base, rows)), pa.array(np.bincount(owner, np.log10(chance), rows)),
                    ], [f.split()[0] for f in schema.split(", ")])

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, schema)


def score_all(docs: DataFrame, remainder: int = HELD_OUT) -> DataFrame:
    """Train on the documents whose crc32(doc_id) mod 5 is not `remainder`, score all."""
    marked = docs.select("doc_id", "text", held_out("doc_id", remainder).alias("held_out"))
    return score(marked, train(marked.filter("NOT held_out")))
