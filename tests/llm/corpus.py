"""Documents with everything that goes wrong, and small tools of the corpus tests."""

from __future__ import annotations

import random

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, SCORE int, row string, `count` int"
LONG = " ".join(random.Random(1).choices(["the", "and", "onti", "erth", "shan", "a"], k=40_000))
PASSAGE = "".join(random.Random(2).choices("abcdefgh ", k=260))

ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "src1", 0),
    (3, "One two three four five six seven eight nine ten", "en", "src1", 48),
    (3, "One two three four five six seven eight nine ten", "en", "src1", 48),
    (3, "another text under the same id", "de", "src2", 30),
    (None, "a text without an id " + PASSAGE, "en", "src3", None),
    (5, LONG, "en", "src0", len(LONG)),
    (6, "ONE two three four five six seven eight nine TEN", "en", "other", 48),
    (7, "  \n\t ", "fr", "src4", 5),
    (8, PASSAGE + " tail " + PASSAGE, "es", "src5", 1),
    (9, "é中😀 ▁ é\x00x　y", "es", "src6", 9),
    (10, "x" * 5000, None, "src7", 5000),
]


def odd_documents(spark, rows=None):
    rows = ROWS if rows is None else rows
    return spark.createDataFrame([(*r, "old", 7, "old", 1) for r in rows], SCHEMA)


def own_columns(df):
    """What the input brought along besides the columns of documents."""
    return [c for c in df.columns if c.lower() in ("kept", "score", "row", "count")]
