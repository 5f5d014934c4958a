"""Tokens of two public tokenizers with the bytes that each of them stands for."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa

from tidegate.llm import scan
from tidegate.llm.token_ids import PieceCoder

_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_alphabet() -> dict[str, int]:
    """The byte behind every character of a byte-level vocabulary: printable bytes stand for themselves,
    all others, in order, for the characters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class TokenBytes:
    """The bytes of every id of a vocabulary, joined, with their bounds."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.fromiter(map(len, entries), np.int64, len(entries))
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.starts = self.lengths.cumsum() - self.lengths

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spans(self.starts[ids], self.lengths[ids])]


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices of all spans, one after the other."""
    ends = counts.cumsum()
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class ByteLevelSide:
    """Ids of a byte-level vocabulary; strings of special tokens inside a text are plain text."""

    def __init__(self, path: str):
        self.coder = PieceCoder(path)
        tokenizer = self.coder.tokenizer
        tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        names = {i: t for t, i in tokenizer.get_vocab(with_added_tokens=True).items()}
        self.bytes = TokenBytes([
            bytes(alphabet[c] for c in name) if all(c in alphabet for c in name) else name.encode()
            for name in (names.get(i, "") for i in range(max(names) + 1))])

    def encode(self, texts: scan.Texts) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths = self.coder.encode(texts)
        return ids.astype(np.int64), lengths


class PieceSide:
    """Ids of a SentencePiece vocabulary; the library itself puts the space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        self.bytes = TokenBytes([
            bytes.fromhex(_BYTE_PIECE.fullmatch(name)[1]) if self.library.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.library.encode(texts, num_threads=1)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(lengths.sum())), lengths


def spaced(texts: pa.Array) -> pa.Array:
    """Every text with one space before it."""
    import pyarrow.compute as pc

    return pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts.cast(pa.large_string()), pa.scalar("", pa.large_string()))
