"""Token counts of whole texts under a public SentencePiece BPE vocabulary.

Texts are cut into pre-tokens where no merge can reach across, so the counts of pre-tokens add
up to the library's count of the text. Pre-tokens a task has not met yet are merged together by
:class:`~relocate.llm.merge_arrays.Merger`; their counts are kept for the next texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.llm.common import batch, in_batches, text_bytes
from relocate.llm.merge_arrays import Merger
from relocate.llm.piece_model import SPACE_MARK, PieceModel

VOCABULARY = "piece_bpe_32k.model"
CONTEXT_TOKENS = 4096
#: Pre-tokens merged in one step, and pre-tokens a worker remembers.
STEP_TOKENS = 50_000
KEPT_TOKENS = 1_000_000

_mergers: dict[tuple[bytes, float], Merger] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def merger(model: bytes, dropout: float = 0.0) -> Merger:
    """The merger of a model file, built once in each worker."""
    if (model, dropout) not in _mergers:
        _mergers[model, dropout] = Merger(PieceModel.parse(model), dropout)
    return _mergers[model, dropout]


def pre_tokens(text: str, m: PieceModel) -> list[str]:
    """Cuts of a text as the library sees it: a space goes first, marks and spaces are one."""
    if not text:
        return []
    return m.splitter.findall((" " if m.dummy_prefix else "") + text.replace(SPACE_MARK, " "))


def surviving(tokens: list[str], m: Merger) -> np.ndarray:
    """Symbols left of each pre-token; a character without a piece counts its bytes."""
    symbols, starts, per_token = m.merge(tokens)
    weight = np.ones(len(symbols), np.int64)
    lone = np.flatnonzero(symbols >= len(m.model.pieces))
    if len(lone):
        token = np.repeat(np.arange(len(tokens)), per_token)
        for i in lone:
            weight[i] = len(tokens[token[i]][starts[i]].encode())
    total = np.concatenate([[0], np.cumsum(weight)])
    ends = np.cumsum(per_token)
    return total[ends] - total[ends - per_token]


class Counter:
    """Counts texts, remembering pre-tokens."""

    def __init__(self, m: Merger):
        self.merger, self.known = m, {}

    def learn(self, needed: set[str]) -> None:
        new = list(needed.difference(self.known))
        if len(self.known) + len(new) > KEPT_TOKENS:
            self.known.clear()
            new = list(needed)
        for i in range(0, len(new), STEP_TOKENS):
            step = new[i : i + STEP_TOKENS]
            self.known.update(zip(step, surviving(step, self.merger).tolist(), strict=True))

    def count(self, text: str) -> int:
        return self.count_all([text])[0]

    def count_all(self, texts: list[str]) -> list[int]:
        cut = [pre_tokens(t, self.merger.model) for t in texts]
        self.learn(set().union(*cut))
        return [sum(map(self.known.__getitem__, tokens)) for tokens in cut]


def token_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    limit: int = CONTEXT_TOKENS,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; null texts are empty (0 tokens).

    No begin, end or added tokens; strings that look like special pieces are ordinary text; no
    truncation. Rows that repeat are counted each.
    """
    with open(path or vocabulary_path(), "rb") as f:
        model = f.read()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(merger(model))
        for b in batches:
            raw = text_bytes(b.column(1))
            yield batch(
                doc_id=b.column(0),
                n_bytes=pa.array(map(len, raw), pa.int64()),
                n_tokens=pa.array(counter.count_all([x.decode() for x in raw]), pa.int64()),
            )

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counts = in_batches(narrow, work, "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
