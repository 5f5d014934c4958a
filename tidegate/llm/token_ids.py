"""Operator 2: token ids of all documents as wavelet-matrix shards, and reading them back.

Defined results: a null text is an empty one (the end id alone); rows with the same doc_id are
kept, ordered by text; a null doc_id comes first; no rows give no shards; other columns are
not read. A shard never splits a document, so a very long document makes one large shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import batched, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidegate.llm import scan, wavelet
from tidegate.llm.common import stage

END_ID = 2
SHARD_TOKENS = 1 << 20
CACHE_WORDS = 1_200_000
JOINED = 256  # pieces encoded side by side in one call
SHARDS = "part int, shard int, part_start bigint, first_doc_id bigint, doc_ids binary, null_ids binary, n_docs bigint, n_tokens bigint, image binary"
_CODERS: dict[str, PieceCoder] = {}

_ASCII_SPACE = scan._SEPARATOR
_KIND = np.zeros(256, np.uint8)  # 1 letter, 2 digit, 3 other visible ASCII; 0 is left to the library
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = 3


class PieceCoder:
    """Ids of whole texts from the tokenizers library, one call per distinct piece of text.

    The byte-level pre-tokeniser never joins text across the boundaries used here: before a
    word together with its one leading space, around other white space by its own rules, and
    between runs of ASCII letters, digits and marks inside a word (the apostrophe, which starts
    contractions, is never cut at). Texts with rare white space or an added token of the
    vocabulary go to the library whole. Pieces are known by a 64-bit hash. The memory is bounded:
    beyond CACHE_WORDS pieces it starts anew.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        # A character of a byte-level name stands for one byte.
        self.name_bytes = np.zeros(max(names.values()) + 1, np.int64)
        self.name_bytes[list(names.values())] = [len(name) for name in names]
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.order = np.zeros(0, np.int64)
        self.bounds = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _library(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _side_by_side(self, pieces: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per piece) of pieces that stand alone, many to a call and cut apart by their bytes."""
        found = self._library(["".join(group) for group in batched(pieces, JOINED)])
        ids = np.fromiter(chain.from_iterable(found), np.uint32, sum(map(len, found)))
        ends, wanted = self.name_bytes[ids].cumsum(), sizes.cumsum()
        last = np.searchsorted(ends, wanted)
        if len(pieces) and (last[-1] != len(ends) - 1 or not np.array_equal(ends[last], wanted)):
            raise ValueError("a token reaches across words")
        return ids, np.diff(last, prepend=-1)

    def _learn(self, keys: np.ndarray, pieces: list[str], sizes: np.ndarray, alone: np.ndarray) -> None:
        """Remember new pieces; `alone` marks those of one space and a word, which the pre-tokeniser always cuts before."""
        own, rest = np.flatnonzero(alone), np.flatnonzero(~alone)
        ids, lengths = self._side_by_side([pieces[i] for i in own], sizes[own])
        others = self._library([pieces[i] for i in rest])
        more = np.fromiter(map(len, others), np.int64, len(others))
        slots = np.empty(len(pieces), np.int64)
        slots[np.concatenate([own, rest])] = len(self.bounds) - 1 + np.arange(len(pieces))
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.concatenate([lengths, more]).cumsum()])
        self.ids = np.concatenate([self.ids, ids, np.fromiter(chain.from_iterable(others), np.uint32, int(more.sum()))])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.order = np.insert(self.keys, at, keys), np.insert(self.order, at, slots)

    @staticmethod
    def piece_starts(texts: scan.Texts) -> np.ndarray:
        data, bounds = texts.data, texts.bounds
        space = _ASCII_SPACE[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[bounds] = True
        begins = begins[:-1]
        before = np.empty_like(space)
        before[:1], before[1:] = False, space[:-1]
        before &= ~begins
        mark = begins.copy()
        mark |= space & ~before
        words = np.flatnonzero(~space & before)  # words with white space before them
        mark[words - 1] = True
        mark[words[data[words - 1] != 0x20]] = True
        kind = _KIND[data]
        cut = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        mark[1:] |= cut
        return np.flatnonzero(mark)

    def rare(self, texts: scan.Texts) -> np.ndarray:
        """Which texts hold white space outside ASCII, its separators 1C to 1F, or an added token."""
        d = texts.data
        at = (d >= 0x1C) & (d <= 0x1F)
        wide = np.flatnonzero((d == 0xC2) | (d >= 0xE1) & (d <= 0xE3))
        wide = wide[wide < len(d) - 1]
        second, third = d[wide + 1], d[np.minimum(wide + 2, len(d) - 1)]
        odd = (d[wide] == 0xC2) & ((second == 0x85) | (second == 0xA0)) | (d[wide] == 0xE1) & (second == 0x9A) \
            | (d[wide] == 0xE2) & ((second == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF))
                                   | (second == 0x81) & (third == 0x9F)) | (d[wide] == 0xE3) & (second == 0x80) & (third == 0x80)
        at[wide[odd]] = True
        raw = d.tobytes()
        for token in self.added:
            position = raw.find(token.encode())
            while position >= 0:
                at[position] = True
                position = raw.find(token.encode(), position + 1)
        out = np.zeros(len(texts), bool)
        out[np.searchsorted(texts.bounds, np.flatnonzero(at), "right") - 1] = True
        return out

    def encode(self, texts: scan.Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids per text)."""
        if not len(texts.data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        rare = self.rare(texts)
        starts = self.piece_starts(texts)
        owner = np.searchsorted(texts.bounds, starts, "right") - 1
        stops = np.append(starts[1:], len(texts.data))
        if rare.any():
            plain = ~rare[owner]
            whole = np.flatnonzero(rare)
            starts = np.concatenate([starts[plain], texts.bounds[whole]])
            stops = np.concatenate([stops[plain], texts.bounds[whole + 1]])
            owner = np.concatenate([owner[plain], whole])
            order = np.argsort(starts, kind="stable")
            starts, stops, owner = starts[order], stops[order], owner[order]
        keys = scan.span_hashes(texts.data, starts, stops)
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > CACHE_WORDS:
            self._clear()
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == unique[inside]
        if not known.all():
            raw = texts.data.tobytes()
            new = first[~known]
            begin, end, data = starts[new], stops[new], texts.data
            second = data[np.minimum(begin + 1, len(data) - 1)]
            alone = (data[begin] == 0x20) & (end - begin > 1) & ~_ASCII_SPACE[second] & ~rare[owner[new]]
            self._learn(unique[~known], [raw[a:b].decode("utf-8", "replace") for a, b in zip(begin, end)], end - begin, alone)
            at = np.searchsorted(self.keys, unique)
        slots = self.order[at][inverse]
        lengths = self.bounds[slots + 1] - self.bounds[slots]
        ends = lengths.cumsum()
        index = np.arange(int(ends[-1])) + np.repeat(self.bounds[slots] - (ends - lengths), lengths)
        return self.ids[index], np.bincount(owner, lengths, len(texts)).astype(np.int64)


def coder(path: str) -> PieceCoder:
    """One per worker and vocabulary file."""
    if path not in _CODERS:
        _CODERS[path] = PieceCoder(path)
    return _CODERS[path]


def _shards(batches: Iterator[pa.RecordBatch], path: str, end_id: int, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    part, shard = TaskContext.get().partitionId(), 0
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    size = written = 0

    def flush() -> pa.RecordBatch:
        ids, lengths, docs, nulls = (np.concatenate(x) for x in zip(*held))
        image = wavelet.encode(ids, lengths.cumsum())
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([written], pa.int64()),
            pa.array([None if nulls[0] else int(docs[0])], pa.int64()), pa.array([docs.astype("<i8").tobytes()], pa.binary()),
            pa.array([np.packbits(nulls).tobytes()], pa.binary()), pa.array([len(docs)], pa.int64()),
            pa.array([len(ids)], pa.int64()), pa.array([image], pa.binary()),
        ], ["part", "shard", "part_start", "first_doc_id", "doc_ids", "null_ids", "n_docs", "n_tokens", "image"])

    for batch in batches:
        doc_ids = batch.column(0)
        nulls = np.asarray(doc_ids.is_null())
        docs = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b, texts in scan.text_chunks(batch.column(1)):
            ids, lengths = coder(path).encode(texts)
            out = np.insert(ids, lengths.cumsum(), np.uint32(end_id))
            held.append((out, lengths + 1, docs[a:b], nulls[a:b]))
            size += len(out)
            if size >= shard_tokens:
                yield flush()
                held, size, written, shard = [], 0, written + size, shard + 1
    if held:
        yield flush()


def write_token_shards(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID,
                       shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode (doc_id, text) in ascending doc_id order and write the shards; returns a scan of them.

    The sort range-partitions the documents, and each task streams its range into shards of about
    `shard_tokens` ids, so neither a task nor the driver holds more than one shard.
    """
    ordered = docs.select("doc_id", "text").repartitionByRange(F.asc("doc_id")).sortWithinPartitions("doc_id", "text")
    return stage(ordered.mapInArrow(lambda b: _shards(b, tokenizer_path, end_id, shard_tokens), SHARDS), "token-shards")


def read_token_shards(shards: DataFrame) -> DataFrame:
    """One row per document from the shard files: where its ids start, how many, and their checksum."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                base, ids, nulls, image = (batch.column(c)[row].as_py() for c in range(4))
                matrix = wavelet.WaveletMatrix(image)
                tokens = matrix.all_ids().astype("<u4")
                raw = memoryview(tokens.tobytes())
                starts = np.concatenate([[0], matrix.ends[:-1]]).astype(np.int64)
                docs = np.frombuffer(ids, "<i8")
                missing = np.unpackbits(np.frombuffer(nulls, np.uint8), count=len(docs)).astype(bool)
                sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts, matrix.ends)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64(), mask=missing), pa.array(base + starts, pa.int64()),
                    pa.array(matrix.ends - starts, pa.int64()), pa.array(sums, pa.int64()),
                ], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # The ids before each range: one row per task of the writer, so the broadcast is bounded by their number.
    ranges = shards.groupBy("part").agg(F.sum("n_tokens").alias("_size"))
    earlier = ranges.select("part", F.coalesce(
        F.sum("_size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_range"))
    placed = shards.join(F.broadcast(earlier), "part").select(
        (F.col("_range") + F.col("part_start")).alias("base"), "doc_ids", "null_ids", "image")
    return placed.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
