"""Operator 13: tokens of two vocabularies aligned by their bytes, with corpus-wide counts of linked ids.

Every text is encoded on both sides, the byte ends are aligned by diagonal run skipping (`diagonals.py`), and each document is
written once with its groups digest and its distinct linked id pairs. The number of documents of a pair is an aggregate over
that table. Pairs of many documents, at most HOT_PAIRS of them, go to the tasks as one table of fixed size; the
pairs below, each in few documents, are joined by a shuffle, so no task or driver ever holds counts of a number that grows.

Defined results: a null or empty text, and one whose tokens do not give back its bytes with a space before
them on both sides, has no tokens, all zeros and an empty digest; repeated rows are documents of their own, each counted and
returned; a null doc_id stays null; no rows give no rows; other columns are not read. A text is encoded as a whole, so the
memory of a task follows its longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from tidegate.llm import scan
from tidegate.llm.common import stage
from tidegate.llm.diagonals import align
from tidegate.llm.token_bytes import ByteLevelSide, PieceSide, spaced, spans

HOT_PAIRS = 4_000_000
B_BITS = 24  # a pair of ids is one number: the A id above this many bits of the B id
CHUNK_BYTES = 1 << 20

ALIGNED = ("row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "pairs array<bigint>, times array<int>")
_SIDES: dict[str, ByteLevelSide | PieceSide] = {}


def _side(kind: type, path: str) -> ByteLevelSide | PieceSide:
    if path not in _SIDES:
        _SIDES[path] = kind(path)
    return _SIDES[path]


def _equal_texts(side: ByteLevelSide | PieceSide, ids: np.ndarray, lengths: np.ndarray, texts: scan.Texts) -> np.ndarray:
    """Which texts the joined bytes of their tokens give back."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    size = np.bincount(owner, side.bytes.lengths[ids], len(lengths)).astype(np.int64)
    equal = size == np.diff(texts.bounds)
    own = side.bytes.joined(ids[equal[owner]])
    asked = texts.data[spans(texts.bounds[:-1][equal], size[equal])]
    wrong = np.flatnonzero(own != asked)
    equal[np.flatnonzero(equal)[np.searchsorted(size[equal].cumsum(), wrong, "right")]] = False
    return equal


def _decimals(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, lengths) of ids in decimal, each with the mark that follows it."""
    digits = max(len(str(int(ids.max()))), 1) if len(ids) else 1
    cells = np.empty((len(ids), digits + 1), np.uint8)
    rest = ids.copy()
    for place in range(digits - 1, -1, -1):
        rest, cells[:, place] = np.divmod(rest, 10)
    cells[:, :digits] += 48
    cells[:, digits] = ends
    lead = (ids[:, None] < 10 ** np.arange(digits - 1, 0, -1)) if digits > 1 else np.zeros((len(ids), 0), bool)
    shown = np.ones(cells.shape, bool)
    shown[:, :digits - 1] = ~lead
    return cells[shown], shown.sum(1)


def _digests(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, groups: np.ndarray) -> list[str]:
    """Hex digests of `a1,a2|b1;a3|b2,b3` for texts of groups[t] groups each."""
    size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    at_a = np.arange(len(ids_a)) + np.repeat(size_b.cumsum() - size_b, size_a)
    at_b = np.arange(len(ids_b)) + np.repeat(size_a.cumsum(), size_b)
    ids = np.empty(len(ids_a) + len(ids_b), np.int64)
    ids[at_a], ids[at_b] = ids_a, ids_b
    marks = np.full(len(ids), ord(","), np.uint8)
    marks[at_a[cut_a]], marks[at_b[cut_b]] = ord("|"), ord(";")
    raw, lengths = _decimals(ids, marks)
    stops = lengths.cumsum()[at_b[cut_b][groups.cumsum() - 1]] if len(groups) else np.zeros(0, np.int64)
    view = memoryview(raw.tobytes())
    # The last mark of a text is no part of it.
    return [hashlib.sha256(view[a:b - 1]).hexdigest() for a, b in zip(np.append(0, stops[:-1]), stops)]


def _aligned(texts: pa.Array, side_a: ByteLevelSide, side_b: PieceSide) -> list[pa.Array]:
    """The columns of ALIGNED after doc_id, for a chunk of texts."""
    n = len(texts)
    with_space = spaced(texts)
    raw, bounds = scan.string_buffers(with_space)
    own = scan.Texts(raw[bounds[0]:bounds[-1]], bounds - bounds[0])
    ids_a, n_a = side_a.encode(own)
    ids_b, n_b = side_b.encode(texts.to_pylist())
    if len(ids_b) and int(ids_b.max()) >> B_BITS:
        raise ValueError("ids of the second vocabulary do not fit a pair")
    good = (np.diff(own.bounds) > 1) & _equal_texts(side_a, ids_a, n_a, own) & _equal_texts(side_b, ids_b, n_b, own)
    ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
    n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
    found = align(side_a.bytes.lengths[ids_a].cumsum(), side_b.bytes.lengths[ids_b].cumsum())
    owner = np.repeat(np.arange(n), n_a)
    groups = np.bincount(owner[found.cut_a], minlength=n)
    links = np.bincount(owner[found.link_a], minlength=n)
    digests = np.full(n, "", object)
    digests[good] = _digests(ids_a, ids_b, found.cut_a, found.cut_b, groups[good])
    pair = ids_a[found.link_a] << B_BITS | ids_b[found.link_b]
    distinct, place = np.unique(pair, return_inverse=True)
    keys, times = np.unique(owner[found.link_a] * max(len(distinct), 1) + place, return_counts=True)
    offsets = np.append(0, np.bincount(keys // max(len(distinct), 1), minlength=n).cumsum())
    return [pa.array(n_a), pa.array(n_b), pa.array(groups), pa.array(links), pa.array(digests, pa.string()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(distinct[keys % max(len(distinct), 1)])),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(times.astype(np.int32)))]


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One written row per row of `docs` (doc_id, text): token, group and link numbers, the digest, distinct linked pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        names = [f.split()[0] for f in ALIGNED.split(", ")]
        side_a, side_b = _side(ByteLevelSide, path_a), _side(PieceSide, path_b)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for a, b, _ in scan.text_chunks(texts, CHUNK_BYTES):
                numbers = np.arange(row, row + b - a)
                row += b - a
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers), batch.column(0).slice(a, b - a), *_aligned(texts.slice(a, b - a), side_a, side_b)], names)

    picked = docs.select(F.col("doc_id").cast("bigint"), F.col("text"))
    return stage(picked.mapInArrow(run, ALIGNED), "token-links")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, documents, best): in how many documents a pair is linked, and whether no pair of its A id is in more."""
    counts = stage(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents")), "pair-counts")
    id_a = F.shiftright("pair", B_BITS)
    most = counts.groupBy(id_a.alias("id_a")).agg(F.max("documents").alias("most"))
    return counts.withColumn("id_a", id_a).join(most, "id_a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def _hot_floor(counts: DataFrame, most: int) -> int:
    """The least power of two at or above which at most `most` pairs lie; found from one row per power."""
    powers = counts.groupBy(F.floor(F.log2("documents")).cast("int").alias("power")).agg(F.count("*").alias("n")).collect()
    floor, left = 62, most
    for row in sorted(powers, key=lambda r: -r.power):
        left -= row.n
        if left < 0:
            break
        floor = row.power
    return 1 << floor


def _with_hot(aligned: DataFrame, hot: Broadcast) -> DataFrame:
    """Best links and sums over the pairs in `hot`, and the other pairs of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, documents, best = (np.frombuffer(b, t) for b, t in zip(hot.value, ("<i8", "<i8", "?")))
        for batch in batches:
            lists, n = batch.column("pairs"), batch.num_rows
            pairs = lists.flatten().to_numpy()
            times = batch.column("times").flatten().to_numpy()
            owner = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            at, own, often = at[known], owner[known], times[known].astype(np.int64)
            sums = np.zeros((2, n), np.int64)
            np.add.at(sums[0], own, often * best[at])
            np.add.at(sums[1], own, often * documents[at])
            offsets = pa.array(np.append(0, np.bincount(owner[~known], minlength=n).cumsum()), pa.int32())
            cold = [pa.ListArray.from_arrays(offsets, pa.array(x[~known])) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], pa.array(sums[0]), pa.array(sums[1]), *cold],
                [*batch.schema.names[:7], "n_best", "count_sum", "pairs", "times"])

    schema = ALIGNED.replace("pairs array", "n_best bigint, count_sum bigint, pairs array")
    return aligned.mapInArrow(run, schema)


def score_links(aligned: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per row of `align_documents`: its numbers, its links to the best partners of their A ids, the sum of link counts."""
    spark = aligned.sparkSession
    counts = stage(pair_counts(aligned), "pair-best")
    floor = _hot_floor(counts, hot_pairs)
    table = counts.filter(F.col("documents") >= floor).toArrow().sort_by("pair")
    hot = spark.sparkContext.broadcast(tuple(
        table[c].to_numpy().astype(t).tobytes() for c, t in (("pair", "<i8"), ("documents", "<i8"), ("best", "?"))))
    scored = _with_hot(aligned, hot)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if floor == 1:
        return scored.select(names)
    scored = stage(scored, "hot-links")
    rare = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    less = counts.filter(F.col("documents") < floor).join(rare, F.col("pair") == F.col("pairs"))
    sums = less.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
        F.sum(F.col("times") * F.col("documents")).alias("_sum"))
    both = scored.drop("pairs", "times").join(sums, "row", "left")
    return both.withColumns({
        "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}).select(names)


def align_tokens(docs: DataFrame, path_a: str, path_b: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    return score_links(align_documents(docs, path_a, path_b), hot_pairs)
