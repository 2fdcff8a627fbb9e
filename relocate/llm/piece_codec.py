"""SentencePiece encoding with seeded merge-dropout, and decoding.

Every candidate merge may be skipped by a keyed hash while the agenda is worked off, so a text
gets another segmentation for every seed and epoch, and the same one again for the same seed.
The key of a pre-token is its document and its place there, so a word that recurs is cut anew each
time. Every candidate's fate is drawn anew at every place; only where none of those that the plain
merge looks at is skipped, which leaves the agenda as it is, the remembered plain pieces stand.
Decoding joins the text of the pieces: characters without a piece, and a literal space mark, travel
as byte pieces, so every text comes back unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.llm.common import fresh_names, in_batches, text_bytes
from relocate.llm.merge_arrays import LONG, Merger, mixed
from relocate.llm.piece_model import BYTE, PieceModel
from relocate.llm.token_counts import merger, vocabulary_path

DROPOUT = 0.1
SEED = 42
#: Pre-tokens merged in one step, and pre-tokens whose plain merge a worker remembers.
STEP_TOKENS = 60_000
KEPT_TOKENS = 200_000
IDS = "piece_ids"


def _ids(tokens: list[str], m: Merger, keys: np.ndarray | None, looked: list | None = None) -> list[bytes]:
    """The ids of each pre-token under its key, as 32-bit numbers; see :meth:`Merger.merge`."""
    if not tokens:
        return []
    symbols, starts, per_token = m.merge(tokens, keys, looked)
    lone = symbols >= len(m.model.pieces)
    ids, ends = symbols.astype("<i4"), np.cumsum(per_token)
    begins = ends - per_token
    raw = ids.tobytes()
    out = [raw[a:z] for a, z in zip((4 * begins).tolist(), (4 * ends).tolist(), strict=True)]
    for t in np.flatnonzero(np.add.reduceat(lone, begins)):
        row = []
        for i in range(begins[t], ends[t]):
            row.extend(m.model.byte_ids[list(tokens[t][starts[i]].encode())] if lone[i] else [ids[i]])
        out[t] = np.array(row, "<i4").tobytes()
    return out


def _lossless(m: Merger) -> None:
    if np.count_nonzero(np.array(m.model.kinds) == BYTE) != 256:
        raise ValueError("decoding is lossless only with all byte pieces")


def _put(held: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """The array with values written from a place on, twice as long where it is too short."""
    if at + len(values) > len(held):
        held = np.concatenate([held[:at], np.empty(max(at, len(values)) + len(values), held.dtype)])
    held[at : at + len(values)] = values
    return held


class Plain:
    """What the plain merge makes of pre-tokens, and the candidates it looks at on the way."""

    def __init__(self, m: Merger):
        self.merger = m
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.ids, self.ends = np.empty(1024, object), np.zeros(1025, np.int64)
        self.start, self.made = np.zeros(8192, np.int32), np.zeros(8192, np.int32)

    def learn(self, tokens: list[str]) -> None:
        if len(self.row) + len(tokens) > KEPT_TOKENS:
            self.clear()
        looked: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        ids = _ids(tokens, self.merger, None, looked)
        have = len(self.row)
        self.row.update(zip(tokens, range(have, have + len(tokens)), strict=True))
        whose, start, made = (np.concatenate(x) for x in zip(*looked, strict=True))
        order = np.argsort(whose, kind="stable")
        ends = self.ends[have] + np.cumsum(np.bincount(whose, minlength=len(tokens)))
        told = np.empty(len(ids), object)
        told[:] = ids
        self.ids = _put(self.ids, have, told)
        self.start = _put(self.start, self.ends[have], start[order])
        self.made = _put(self.made, self.ends[have], made[order])
        self.ends = _put(self.ends, have + 1, ends)

    def untouched(self, rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Whether no candidate that the plain merge looks at is skipped under the key."""
        begin, count = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        ends = np.cumsum(count)
        flat = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + count, count)
        skips = self.merger.skipped(np.repeat(keys, count), self.start[flat], self.made[flat])
        total = np.concatenate([[0], np.cumsum(skips)])
        return total[ends] == total[ends - count]


class PlaceEncoder:
    """Encodes texts with a key of its own for every pre-token: the text's key and the place."""

    def __init__(self, m: Merger):
        _lossless(m)
        self.merger, self.plain, self.met = m, Plain(m), set()

    def _encoded(self, tokens: list[str], keys: np.ndarray) -> list[bytes]:
        """The ids of pre-tokens; those met before are merged anew only where a skip touches them."""
        plain, met = self.plain, set(tokens)
        new = [t for t in met.difference(plain.row) if t in self.met and len(t) <= LONG]
        if new:
            plain.learn(new)
        if len(self.met) > KEPT_TOKENS:
            self.met.clear()
        self.met |= met
        rows = np.fromiter(map(plain.row.get, tokens, repeat(-1)), np.int64, len(tokens))
        known = np.flatnonzero(rows >= 0)
        same = known[plain.untouched(rows[known], keys[known])]
        cut = np.ones(len(tokens), bool)
        cut[same] = False
        others = np.flatnonzero(cut)
        out = np.empty(len(tokens), object)
        out[same] = plain.ids[rows[same]]
        out[others] = _ids(list(compress(tokens, cut)), self.merger, keys[others])
        return out.tolist()

    def encode_all(self, texts: list[str], keys: list[int]) -> list[bytes]:
        model, out = self.merger.model, [[] for _ in texts]
        step: list[tuple[int, list[str], np.ndarray]] = []
        size = 0

        def work() -> None:
            tokens = [t for _, part, _ in step for t in part]
            ids, at = self._encoded(tokens, np.concatenate([k for _, _, k in step])), 0
            for i, part, _ in step:
                out[i].append(b"".join(ids[at : at + len(part)]))
                at += len(part)
            step.clear()

        for i, (text, key) in enumerate(zip(texts, keys, strict=True)):
            tokens = model.splitter.findall((" " if model.dummy_prefix else "") + text) if text else []
            place = np.arange(len(tokens), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            drawn = mixed(mixed(np.array([key], np.uint64)) + place)
            for at in range(0, len(tokens), STEP_TOKENS):
                step.append((i, tokens[at : at + STEP_TOKENS], drawn[at : at + STEP_TOKENS]))
                size += len(step[-1][1])
                if size >= STEP_TOKENS:
                    work()
                    size = 0
        if step:
            work()
        return [b"".join(parts) for parts in out]


def _model(path: str | None) -> bytes:
    with open(path or vocabulary_path(), "rb") as f:
        return f.read()


def _lists(values: list[bytes]) -> pa.Array:
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(values), "<i4")))


def _with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, kind)])


def encode(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    dropout: float = DROPOUT,
    seed: int = SEED,
    epoch: int = 0,
) -> DataFrame:
    """The input columns and ``piece_ids`` (array of int) for every row.

    Null and empty texts get an empty list. A column named ``piece_ids`` is replaced. Rows with
    the same id and text get the same pieces; a null id counts as id 0.
    """
    model = _model(path)
    docs = fresh_names(docs, [IDS])
    at, id_at = docs.columns.index(text), docs.columns.index(key)
    names = [*docs.columns, IDS]
    salt = xxhash.xxh64_intdigest(f"{seed}/{epoch}".encode(), 42)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(model, dropout)
        encoder = PlaceEncoder(m)
        for b in batches:
            texts = [x.decode() for x in text_bytes(b.column(at))]
            keys = [((i or 0) * 0x94D049BB133111EB ^ salt) % 2**64 for i in b.column(id_at).to_pylist()]
            ids = _lists(encoder.encode_all(texts, keys))
            yield pa.RecordBatch.from_arrays([*b.columns, ids], names=names)

    return in_batches(docs, work, _with(docs, IDS, T.ArrayType(T.IntegerType())))


_models: dict[bytes, PieceModel] = {}


def _pieces(model: bytes) -> PieceModel:
    """The pieces of a model file, read once in each worker; decoding needs no merges."""
    if model not in _models:
        _models[model] = PieceModel.parse(model)
    return _models[model]


def decode(
    rows: DataFrame, ids: str = IDS, name: str = "decoded", path: str | None = None
) -> DataFrame:
    """The input columns and the text of the ids. A null list decodes to an empty text."""
    model = _model(path)
    rows = fresh_names(rows, [name])
    at = rows.columns.index(ids)
    names = [*rows.columns, name]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _pieces(model)
        for b in batches:
            texts = []
            for row in b.column(at):
                values = row.values.to_numpy() if row.is_valid and len(row) else ()
                whole = b"".join(map(m.bytes_of.__getitem__, values))
                texts.append(whole[1:] if m.dummy_prefix and len(values) else whole)
            decoded = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, decoded], names=names)

    return in_batches(rows, work, _with(rows, name, T.StringType()))


def digests(rows: DataFrame, ids: str = IDS) -> DataFrame:
    """Number of pieces and a hash of the ids, computed from the lists."""
    return rows.withColumns(
        {
            "n_tokens": F.size(ids).cast("long"),
            "ids_sha256": F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")).cast("binary"), 256),
        }
    )
