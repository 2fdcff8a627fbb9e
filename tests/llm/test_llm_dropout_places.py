"""Merge-dropout by place: a word is cut anew wherever it stands, and in every epoch."""

import numpy as np
from corpus import odd_documents

from relocate.llm import piece_codec, token_counts
from relocate.llm.merge_arrays import Merger
from relocate.llm.piece_model import PieceModel

MODEL = PieceModel.load(token_counts.vocabulary_path())


def test_a_word_is_cut_anew_at_every_place():
    encoder = piece_codec.PlaceEncoder(Merger(MODEL, 0.1))
    word = MODEL.splitter.findall(" international")
    assert len(word) == 1
    text = " ".join(["international"] * 500)
    whole = np.frombuffer(encoder.encode_all([text], [5])[0], "<i4").tolist()
    cuts, part = set(), []
    for piece in whole:
        if MODEL.bytes_of[piece].startswith(b" ") and part:
            cuts.add(tuple(part))
            part = []
        part.append(piece)
    assert len(cuts) > 4
    assert b"".join(MODEL.bytes_of[p] for p in whole)[1:].decode() == text


def test_steps_change_nothing(monkeypatch):
    texts = ["the international thing " * n for n in (0, 1, 7, 40)]
    encoder = piece_codec.PlaceEncoder(Merger(MODEL, 0.3))
    expected = encoder.encode_all(texts, [1, 2, 3, 4])
    monkeypatch.setattr(piece_codec, "STEP_TOKENS", 5)
    assert encoder.encode_all(texts, [1, 2, 3, 4]) == expected
    assert [encoder.encode_all([t], [k])[0] for t, k in zip(texts, [1, 2, 3, 4], strict=True)] == expected


def test_short_texts_vary_over_epochs(spark):
    docs = odd_documents(spark, [(1, "international communication of governments", "en", "s", 1)])
    found = {tuple(piece_codec.encode(docs, epoch=e).first().piece_ids) for e in range(12)}
    assert len(found) > 4
