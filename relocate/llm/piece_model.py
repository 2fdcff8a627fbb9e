"""A SentencePiece BPE model file as arrays: symbols, merges by rank, byte pieces.

The file is read where the driver runs and travels with the tasks: it is one vocabulary, well
under a few megabytes, whatever the data.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np

#: Fixed values of the model format: kinds of pieces, and the mark that stands for a space.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE_MARK = "▁"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


@dataclass
class PieceModel:
    """Pieces in id order and what is derived from them.

    Symbols are piece ids; single characters that only occur inside longer pieces get numbers
    after the last id. Merges are pairs of symbols whose joined text is a piece; a higher score
    is a lower rank, equal scores share a rank.
    """

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool
    unknown_id: int
    byte_ids: np.ndarray
    symbol_of: dict[str, int] = field(repr=False)
    pair_keys: np.ndarray = field(repr=False)
    pair_rank: np.ndarray = field(repr=False)
    pair_symbol: np.ndarray = field(repr=False)
    joining: frozenset[str] = field(repr=False)

    @classmethod
    def load(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            return cls.parse(f.read())

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        pieces, scores, kinds, trainer, normalizer = [], [], [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        plain = not normalizer.get(2) and not normalizer.get(4, 1) and normalizer.get(5, 1)
        if trainer.get(3) != 2 or not plain or USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("only BPE models with identity normalisation are supported")
        return cls(*cls._derive(pieces, scores, kinds, bool(normalizer.get(3, 1))))

    @staticmethod
    def _derive(pieces: list[str], scores: list[float], kinds: list[int], dummy_prefix: bool) -> tuple:
        own = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == NORMAL}
        if any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in own):
            raise ValueError("a piece goes on after a space")
        symbols = dict(own)
        for p in own:
            for c in p:
                symbols.setdefault(c, len(pieces) + len(symbols) - len(own))
        size = len(pieces) + len(symbols) - len(own) + 1
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in own.values()}, reverse=True))}
        merges = sorted(
            (symbols[p[:cut]] * size + symbols[p[cut:]], order[scores[i]], i)
            for p, i in own.items()
            for cut in range(1, len(p))
            if p[:cut] in symbols and p[cut:] in symbols
        )
        keys, ranks, made = (np.array(x, np.int64) for x in zip(*merges, strict=True))
        byte_ids = np.full(256, kinds.index(UNKNOWN), np.int32)
        for i, k in enumerate(kinds):
            if k == BYTE:
                byte_ids[int(pieces[i][3:5], 16)] = i
        joining = frozenset(c for p in own if len(p) > 1 for c in p)
        unknown = kinds.index(UNKNOWN)
        return pieces, scores, kinds, dummy_prefix, unknown, byte_ids, symbols, keys, ranks, made, joining

    @property
    def symbols(self) -> int:
        """One more than the largest symbol; it stands for any character no piece has."""
        return len(self.pieces) + sum(1 for s in self.symbol_of.values() if s >= len(self.pieces)) + 1

    @cached_property
    def bytes_of(self) -> list[bytes]:
        """The text of each id."""
        out = [p.replace(SPACE_MARK, " ").encode() for p in self.pieces]
        for value, i in enumerate(self.byte_ids):
            if self.kinds[i] == BYTE:
                out[i] = bytes([value])
        for i, k in enumerate(self.kinds):
            if k in (CONTROL, UNKNOWN):
                out[i] = b""
        return out

    @cached_property
    def splitter(self) -> re.Pattern:
        """Cuts a text where no merge can reach across: before spaces, around lone characters."""
        lone = "".join(re.escape(c) for c in ("\n", "\r", "\t") if c not in self.joining)
        word = f" *[^ {lone}]+| +"
        return re.compile(f"[{lone}]|{word}" if lone else word)
