"""Operator 8: SentencePiece encoding with seeded merge-dropout, and decoding.

The vocabulary is a SentencePiece model of merge type with byte fallback; the merging is done
here. Symbols start as characters (a space is the piece U+2581, one is put before the text);
candidate merges stand in an agenda ordered by score and then place. A candidate taken from the
agenda is skipped when a keyed hash of (seed, occurrence of the word, place, both symbols) falls
below the dropout share. The occurrence is a 64-bit hash of the document, its reading, the word's number in it and
the seed, so every occurrence draws for itself and every run with the same seed gives the same ids. Only the merging
without dropout is remembered, per word with its merges; occurrences whose draws skip one of these merges are merged anew.
Characters without a piece, and U+2581 itself, become byte pieces, so
decoding always gives back the text.

No piece reaches from other characters into a space, and some control characters stand in no
piece at all, so words are segmented on their own: short ones together as numpy matrices, one agenda step for
each word per round, long ones with a heap. Both give the same pieces.

Defined results: a null text is an empty one, which has no ids and decodes to the empty text; rows
with equal doc_id, reading and text get equal ids; a null doc_id is keyed as one value; no rows give no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidegate.llm import scan
from tidegate.llm.common import stage
from tidegate.llm.pieces import IdStore

SEED, DROPOUT = 17, 0.1
CACHE_PIECES = 500_000
CHUNK_BYTES = 1 << 19  # text encoded at a time, which changes no result
SHORT = 48
DECODE_ROWS = 256  # rows decoded at a time, which changes no result
MARK = "▁"
_NONE = np.int32(2**31 - 1)
_U = np.uint64
_MASK = (1 << 64) - 1
_SALT = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_CODECS: dict[tuple, Codec] = {}


def _mix(value: int) -> int:
    value = ((value ^ (value >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    value = ((value ^ (value >> 27)) * 0x94D049BB133111EB) & _MASK
    return value ^ (value >> 31)


def _drawn_by(place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What the draw of a merge depends on besides the salt."""
    key = left.astype(np.int64) << 20 | right.astype(np.int64)
    return place.astype(_U) * _U(_SALT[1]) + key.astype(_U) * _U(_SALT[2])


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices of all spans, one after the other."""
    ends = counts.cumsum()
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class Words:
    """Words as spans of an array of code points, so that thousands of them become a matrix without loops over strings."""

    def __init__(self, codes: np.ndarray, begins: np.ndarray, lengths: np.ndarray):
        self.codes, self.begins, self.lengths = codes, begins, lengths

    @classmethod
    def of(cls, words: list[str]) -> Words:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        return cls(np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4"), lengths.cumsum() - lengths, lengths)

    def __len__(self) -> int:
        return len(self.begins)

    def take(self, at: np.ndarray) -> Words:
        return Words(self.codes, self.begins[at], self.lengths[at])

    def text(self, i: int) -> str:
        return self.codes[self.begins[i]:self.begins[i] + self.lengths[i]].tobytes().decode("utf-32-le", "surrogatepass")

    def matrix(self, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(code points of the given words, where they are inside their word), `width` to a row."""
        inside = np.arange(width) < self.lengths[rows, None]
        at = np.minimum(self.begins[rows, None] + np.arange(width), max(len(self.codes) - 1, 0))
        return self.codes[at], inside


class Codec:
    """`variants`, if given, bounds the draws of a word to so many; without it every occurrence has its own."""

    def __init__(self, path: str, seed: int = SEED, dropout: float = DROPOUT, variants: int | None = None):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        known = {p: i for i, p in enumerate(pieces) if not special[i]}
        if any(MARK in p.lstrip(MARK) for p in known):
            raise ValueError("a piece crosses words, which this segmentation does not expect")
        self.breaks = np.zeros(256, bool)  # bytes that stand in no piece, so that words end at them
        self.breaks[[b for b in range(0x09, 0x0E) if not any(chr(b) in p for p in known)]] = True
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.uint32)
        self.chars = np.full(0x110000, -1, np.int32)
        for piece, i in known.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
        self.chars[ord(" ")] = self.chars[ord(MARK)]
        self.chars[ord(MARK)] = -1
        # The place of a piece in the order of scores; pieces of one score share it.
        scores = sorted({model.get_score(i) for i in known.values()}, reverse=True)
        place = {s: n for n, s in enumerate(scores)}
        pairs = {}
        for piece, i in known.items():
            for cut in range(1, len(piece)):
                left, right = known.get(piece[:cut]), known.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = (place[model.get_score(i)], i)
        self.pairs = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.pairs], np.int32)
        self.merged = np.array([pairs[k][1] for k in self.pairs], np.int32)
        self.pair_map = pairs
        raw = [b"" if special[i] else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        for b in range(256):
            raw[self.bytes[b]] = bytes([b])
        self.sizes = np.array([len(r) for r in raw], np.int64)
        self.offsets = np.concatenate([[0], self.sizes.cumsum()])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.seed, self.variants = seed, variants
        self.limit = min(int(dropout * 2.0**64), _MASK)
        self.store = IdStore(CACHE_PIECES)

    # One word -----------------------------------------------------------------------------

    def segment(self, word: str, variant: int | None, merges: list[int] | None = None) -> list[int]:
        """Ids of one word (with its leading spaces) by an agenda held in a heap; without a variant nothing is skipped.

        What the draws of the merges made depend on, besides the salt, is added to `merges`.
        """
        salt = None if variant is None else _mix(self.seed * _SALT[0] + variant & _MASK)
        ids = [int(self.chars[ord(c)]) for c in word]
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        agenda: list[tuple[int, int, int, int, int]] = []

        def propose(left: int) -> None:
            right = after[left]
            if left < 0 or right >= n or ids[left] < 0 or ids[right] < 0:
                return
            found = self.pair_map.get(ids[left] << 20 | ids[right])
            if found is not None:
                heapq.heappush(agenda, (found[0], left, ids[left], ids[right], found[1]))

        for i in range(n - 1):
            propose(i)
        while agenda:
            _, left, a, b, made = heapq.heappop(agenda)
            right = after[left]
            if not alive[left] or right >= n or ids[left] != a or ids[right] != b or (
                    salt is not None and self._skipped(salt, left, a, b)):
                continue
            if merges is not None:
                merges.append(left * _SALT[1] + (a << 20 | b) * _SALT[2] & _MASK)
            ids[left], alive[right] = made, False
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            propose(left)
            if before[left] >= 0:
                propose(before[left])
        out, i = [], 0
        while i < n:
            out += [ids[i]] if ids[i] >= 0 else [int(self.bytes[x]) for x in word[i].encode("utf-8", "surrogatepass")]
            i = after[i]
        return out

    def _skipped(self, salt: int, place: int, left: int, right: int) -> bool:
        return _mix(salt + place * _SALT[1] + (left << 20 | right) * _SALT[2] & _MASK) < self.limit

    # Many short words -----------------------------------------------------------------------

    def _candidates(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, salt: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of each pair; no pair, or a skipped one, has the rank _NONE."""
        key = left.astype(np.int64) << 20 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        found = (self.pairs[at] == key) & (left >= 0) & (right >= 0)
        if salt is not None:
            found &= scan.mix(salt + _drawn_by(place, left, right)) >= _U(self.limit)
        return np.where(found, self.ranks[at], _NONE), self.merged[at]

    def segment_many(self, symbols: np.ndarray, salts: np.ndarray | None, merges: list | None = None) -> np.ndarray:
        """Merge every row of a matrix of symbols (-2 pads) to the end; rows shrink to the left.

        Without salts nothing is skipped. What is merged is added to `merges`, as (rows, what the draws depend on).
        """
        rows, width = symbols.shape
        out = symbols.copy()
        if width < 2:
            return out
        live = np.arange(rows)
        place = np.broadcast_to(np.arange(width, dtype=np.int32), symbols.shape).copy()
        rank, made = self._candidates(symbols[:, :-1], symbols[:, 1:], place[:, :-1], None if salts is None else salts[:, None])
        pad = np.full((rows, 1), _NONE, np.int32)
        rank, made, symbols = np.hstack([rank, pad]), np.hstack([made, pad]), symbols.copy()
        columns = np.arange(width)
        while len(live):
            best = rank.argmin(1)
            row = np.arange(len(live))
            going = rank[row, best] < _NONE
            if not going.all():
                out[live[~going]] = symbols[~going]
                live, symbols, place, rank, made, best = (x[going] for x in (live, symbols, place, rank, made, best))
                salts = None if salts is None else salts[going]
                row = np.arange(len(live))
                if not len(live):
                    break
            if merges is not None:
                merges.append((live, _drawn_by(place[row, best], symbols[row, best], symbols[row, best + 1])))
            symbols[row, best] = made[row, best]
            source = np.minimum(columns + (columns > best[:, None]), width - 1)
            symbols, place, rank, made = (np.take_along_axis(x, source, 1) for x in (symbols, place, rank, made))
            symbols[:, -1], rank[:, -1] = -2, _NONE
            for at in (best, best - 1):
                ok = (at >= 0) & (at < width - 1)
                r, c = row[ok], at[ok]
                rank[r, c], made[r, c] = self._candidates(symbols[r, c], symbols[r, c + 1], place[r, c], None if salts is None else salts[r])
        return out

    def _cut(self, words: Words, word: np.ndarray, variants: np.ndarray | None, traced: bool = False) -> tuple[np.ndarray, ...]:
        """Ids of the occurrences `word` (indices into words), joined, and their starts and counts.

        With `traced` also what the draws of the merges depend on, and the occurrence of each.
        """
        lengths = words.lengths
        salts = None if variants is None else scan.mix(_U(self.seed * _SALT[0] & _MASK) + variants.astype(_U))
        small = np.flatnonzero(lengths <= SHORT)
        width = int(lengths[small].max(initial=0))
        table = np.full((len(words), width), -2, np.int32)
        if width:
            for a in range(0, len(small), 8192):
                codes, inside = words.matrix(small[a:a + 8192], width)
                table[small[a:a + 8192]] = np.where(inside, self.chars[codes], -2)
        size = lengths[word]
        order = np.argsort(size, kind="stable")
        order = order[size[order] <= SHORT]
        pool: list[np.ndarray] = [np.zeros(0, np.uint32)]
        drawn: list[np.ndarray] = [np.zeros(0, np.uint64)]
        of: list[np.ndarray] = [np.zeros(0, np.int64)]
        starts, counts, filled = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64), 0
        alone = np.flatnonzero(size > SHORT).tolist()
        for a in range(0, len(order), 8192):
            group = order[a:a + 8192]
            merges: list | None = [] if traced else None
            merged = self.segment_many(table[word[group], :int(size[group[-1]])], None if salts is None else salts[group], merges)
            clean = (merged != -1).all(1)
            alone += group[~clean].tolist()
            taken = (merged >= 0) & clean[:, None]
            counts[group] = taken.sum(1)
            ends = counts[group].cumsum()
            starts[group] = filled + ends - counts[group]
            pool.append(merged[taken].astype(np.uint32))
            filled += len(pool[-1])
            for rows, keys in merges or ():
                drawn.append(keys[clean[rows]])
                of.append(group[rows[clean[rows]]])
        for i in alone:
            made: list[int] = []
            ids = self.segment(words.text(word[i]), None if variants is None else int(variants[i]), made)
            starts[i], counts[i] = filled, len(ids)
            pool.append(np.array(ids, np.uint32))
            filled += len(ids)
            if traced:
                drawn.append(np.array(made, np.uint64))
                of.append(np.full(len(made), i))
        return np.concatenate(pool), starts, counts, np.concatenate(drawn), np.concatenate(of)

    def _learn(self, words: list[str], variants: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pool, starts, counts, _, _ = self._cut(Words.of(words), np.arange(len(words)), variants)
        return pool[_spans(starts, counts)], counts

    def _learn_merges(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Per word without dropout, joined: the number of ids, the ids, the low and then the high halves of its merges."""
        pool, starts, counts, drawn, of = self._cut(words, np.arange(len(words)), None, True)
        merges = np.bincount(of, minlength=len(words))
        drawn = drawn[np.argsort(of, kind="stable")]
        sizes = 1 + counts + 2 * merges
        begin = sizes.cumsum() - sizes
        out = np.empty(int(sizes.sum()), np.uint32)
        out[begin] = counts
        out[_spans(begin + 1, counts)] = pool[_spans(starts, counts)]
        out[_spans(begin + 1 + counts, merges)] = drawn & _U(0xFFFFFFFF)
        out[_spans(begin + 1 + counts + merges, merges)] = drawn >> _U(32)
        return out, sizes

    # Texts --------------------------------------------------------------------------------

    def encode(self, texts: scan.Texts, document_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids per text)."""
        sizes = np.diff(texts.bounds)
        filled = sizes > 0
        if not filled.any():
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        data = np.insert(texts.data, texts.bounds[:-1][filled], 0x20)
        bounds = np.concatenate([[0], (sizes + filled).cumsum()])
        begins = np.zeros(len(data) + 1, bool)
        begins[bounds] = True
        begins = begins[:-1]
        space = data == 0x20
        line = self.breaks[data]
        mark = begins | line
        mark[1:] |= (space[1:] & ~space[:-1]) | line[:-1]
        starts = np.flatnonzero(mark)
        stops = np.append(starts[1:], len(data))
        owner = np.searchsorted(bounds, starts, "right") - 1
        number = np.arange(len(starts)) - np.searchsorted(starts, bounds[:-1])[owner]
        variant = scan.mix(document_keys[owner] + number.astype(_U) * _U(_SALT[1]) + _U(self.seed))
        if self.variants is not None:
            variant %= _U(self.variants)
        keys = scan.span_hashes(data, starts, stops)
        # Code points before each byte.
        before = np.concatenate([[0], ((data & 0xC0) != 0x80).cumsum()])
        codes = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
        words = Words(codes, before[starts], before[stops] - before[starts])
        known, sizes = self.store.lookup(keys, lambda new: self._learn_merges(words.take(new)))
        begin = sizes.cumsum() - sizes
        counts = known[begin].astype(np.int64)
        begin += 1
        if self.limit:
            merges = (sizes - 1 - counts) // 2
            low = _spans(begin + counts, merges)
            drawn = known[low].astype(_U) | known[low + np.repeat(merges, merges)].astype(_U) << _U(32)
            salts = scan.mix(_U(self.seed * _SALT[0] & _MASK) + variant)
            skips = np.flatnonzero(scan.mix(np.repeat(salts, merges) + drawn) < _U(self.limit))
            again = np.unique(np.searchsorted(merges.cumsum(), skips, "right"))
            if len(again):
                _, first, word = np.unique(keys[again], return_index=True, return_inverse=True)
                pool, begun, cut, _, _ = self._cut(words.take(again[first]), word, variant[again])
                begin[again], counts[again] = len(known) + begun, cut
                known = np.concatenate([known, pool])
        return known[_spans(begin, counts)], np.bincount(owner, counts, len(texts)).astype(np.int64)

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, their bounds): the inverse of encode."""
        sizes = self.sizes[ids]
        ends = sizes.cumsum()
        total = int(ends[-1]) if len(ends) else 0
        data = self.raw[np.arange(total) + np.repeat(self.offsets[ids] - (ends - sizes), sizes)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], counts.cumsum()])]
        filled = np.diff(bounds) > 0
        data = np.delete(data, bounds[:-1][filled])  # the space put before each text
        return data, np.concatenate([[0], (np.diff(bounds) - filled).cumsum()])

    def decode(self, ids: np.ndarray) -> str:
        data, _ = self.decode_all(np.asarray(ids, np.int64), np.array([len(ids)]))
        return data.tobytes().decode("utf-8", "surrogatepass")


def codec(path: str, seed: int, dropout: float) -> Codec:
    """One per worker and setting."""
    key = (path, seed, dropout)
    if key not in _CODECS:
        _CODECS[key] = Codec(*key)
    return _CODECS[key]


def document_keys(ids: pa.Array, readings: pa.Array) -> np.ndarray:
    values = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    own = scan.mix(values.astype(_U) + np.asarray(ids.is_null()).astype(_U) * _U(_SALT[2]))
    return own + (readings.to_numpy(zero_copy_only=False).astype(_U) - _U(1)) * _U(_SALT[0])


def readings(docs: DataFrame) -> DataFrame:
    """`docs` with `reading`: the rows of one doc_id and text are numbered from 1, so that each draws for itself."""
    window = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("text")
    return docs.select("doc_id", "text", F.row_number().over(window).alias("reading"))


def encode_documents(docs: DataFrame, model_path: str, seed: int = SEED, dropout: float = DROPOUT,
                     with_ids: bool = True, reading: str | None = None) -> DataFrame:
    """Encode (doc_id, text): n_tokens, checksum of the ids, whether decoding gave the text back, and the ids.

    The column named by `reading`, from 1, is part of the key of the draws; without it every row is the first reading.
    """
    number = F.lit(1) if reading is None else F.col(reading)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, seed, dropout)
        for batch in batches:
            keys = document_keys(batch.column(0), batch.column(2))
            for a, b, texts in scan.text_chunks(batch.column(1), CHUNK_BYTES):
                ids, counts = own.encode(texts, keys[a:b])
                data, bounds = own.decode_all(ids, counts)
                ends = np.concatenate([[0], counts.cumsum()])
                wire, back, plain = ids.astype("<u4").tobytes(), data.tobytes(), texts.data.tobytes()
                same = [back[p:q] == plain[x:y] for p, q, x, y in zip(bounds[:-1], bounds[1:], texts.bounds[:-1], texts.bounds[1:])]
                columns = [batch.column(0).slice(a, b - a), pa.array(counts), pa.array(
                    [zlib.crc32(wire[4 * p:4 * q]) for p, q in zip(ends[:-1], ends[1:])], pa.int64()),
                    pa.array([zlib.crc32(back[p:q]) for p, q in zip(bounds[:-1], bounds[1:])], pa.int64()), pa.array(same)]
                names = ["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "lossless"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, n_tokens bigint, ids_crc32 bigint, decoded_crc32 bigint, lossless boolean"
    return docs.select("doc_id", "text", number.cast("bigint").alias("reading")).mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """The columns of `encoded` (ids, ...), and the text that the ids stand for."""
    place = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, SEED, DROPOUT)  # decoding depends on neither
        for batch in batches:
            for a in range(0, batch.num_rows, DECODE_ROWS):
                rows = batch.slice(a, DECODE_ROWS)
                ids = rows.column(place)
                counts = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                data, bounds = own.decode_all(ids.flatten().to_numpy(zero_copy_only=False), counts)
                text = pa.StringArray.from_buffers(len(rows), pa.py_buffer(bounds.astype("<i4").tobytes()), pa.py_buffer(data.tobytes()))
                yield pa.RecordBatch.from_arrays([*rows.columns, text], [*rows.schema.names, "text"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())]))


def read_back(encoded: DataFrame, model_path: str) -> DataFrame:
    """What encode_documents gave, with decoded_crc32 and lossless after the ids were written, read and decoded again."""
    decoded = decode_documents(stage(encoded, "piece-ids"), model_path)
    again = F.crc32(F.col("text").cast("binary"))
    return decoded.select("doc_id", "n_tokens", "ids_crc32", again.alias("decoded_crc32"),
                          (F.col("lossless") & (again == F.col("decoded_crc32"))).alias("lossless"), "ids")
