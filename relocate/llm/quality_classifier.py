"""Quality classifier by co-training on two views: the text, and what is known beside it.

The text view counts kinds of characters and repeated words. The metadata view has language,
source, stated length and, where a crawled page belongs to the document, its address and size.
Each view starts from the labelled sample. In every round each classifier hands the documents of
the unlabelled pool that it is surest about to the other one as pseudo-labels. Labelled documents
that neither was trained on calibrate both views, and a last small model combines their odds.

The two classifiers are fitted on a bounded sample; features of all documents are computed once,
written to the shared folder, and scored from there.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate.llm.common import batch, in_batches, row_key, sample_class, text_bytes, whole
from relocate.session import settle

#: Labelled documents of each class, and documents of the pool, that training reads.
SAMPLE_DOCS = 3000
POOL_DOCS = 4000
ROUNDS = 5
#: Pseudo-labels of each class that a view hands over per round, and how sure it has to be.
HANDED = 200
SURE = 0.95
PSEUDO_WEIGHT = 0.5
RIDGE = 1.0
KEEP = 0.5
LANG_BUCKETS, SOURCE_BUCKETS = 8, 32

#: Kinds of characters that the text view counts.
_KINDS = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t\n\x0b\x0c\r",
    b"\n",
    b"#*$%&<>",
    b"|",
    b"!",
    b".,;:?",
    b"\"'()[]{}-_=+/\\@^~`",
]
_TABLE = np.zeros((256, len(_KINDS)), np.float64)
for _place, _chars in enumerate(_KINDS):
    _TABLE[list(_chars), _place] = 1.0


def text_view(text: bytes) -> list[float]:
    """Numbers of one whole text. An empty text has only zeros."""
    if not text:
        return [0.0] * (len(_KINDS) + 7)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = counts @ _TABLE
    words = text.split()
    n = max(1, len(words))
    seen = Counter(words)
    same = sum(map(eq, words, words[1:]))
    letters = max(1.0, counts[97:123].sum() + counts[128:].sum() + kinds[0])
    most = max(seen.values(), default=0)
    return [
        *np.sqrt(kinds / len(text)).tolist(),
        float(kinds[0] / letters),
        float(letters / len(text)),
        same / n,
        len(seen) / n,
        most / n,
        min(len(text) / n, 40.0) / 10,
        float(np.log1p(n)),
    ]


def page_view(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``_page_doc`` and numbers of the page whose address ends with a document's number.

    Of several pages of a document the one with the least address counts.
    """
    address = whole(url)
    path = F.regexp_extract(address, r"^[a-z]+://[^/]*(/[^?#]*)", 1)
    number = F.regexp_extract(path, r"/([0-9]{1,18})$", 1)
    host = F.regexp_extract(address, r"^[a-z]+://([^/]*)", 1)
    numbers = F.array(
        F.lit(1.0),
        address.startswith("https").cast("double"),
        address.contains("?").cast("double"),
        address.contains("#").cast("double"),
        F.size(F.split(host, r"\.")).cast("double"),
        F.log1p(F.octet_length(whole(html)).cast("double")) / 10,
    )
    page = F.struct(address.alias("address"), numbers.alias("numbers"))
    rows = pages.select(number.alias("number"), page.alias("page"))
    return (
        rows.filter("number <> ''")
        .groupBy(F.col("number").cast("long").alias("_page_doc"))
        .agg(F.min("page").alias("page"))
        .select("_page_doc", F.col("page.numbers").alias("_page"))
    )


def _one_of(value: Column, size: int) -> Column:
    place = F.pmod(F.xxhash64(F.coalesce(value.cast("string"), F.lit(""))), F.lit(size))
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (i == place).cast("double"))


def views(
    docs: DataFrame,
    pages: DataFrame | None,
    key: str,
    text: str,
    lang: str,
    source: str,
    n_chars: str,
) -> DataFrame:
    """``doc_id, row, text_view, meta_view`` of every row, written to the shared folder."""
    stated = F.coalesce(F.col(n_chars).cast("double"), F.lit(0.0))
    meta = F.concat(
        _one_of(F.col(lang), LANG_BUCKETS),
        _one_of(F.col(source), SOURCE_BUCKETS),
        F.array(F.log1p(F.greatest(stated, F.lit(0.0))) / 10, F.col(n_chars).isNull().cast("double")),
    )
    narrow = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        row_key(F.col(text)).alias("row"),
        meta.alias("meta"),
        F.col(text).cast("string").alias("text"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [text_view(t) for t in text_bytes(b.column(3))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(found, pa.list_(pa.float64()))],
                names=["doc_id", "row", "meta", "text_view"],
            )

    rows = in_batches(narrow, work, "doc_id long, row long, meta array<double>, text_view array<double>")
    none = F.array(*[F.lit(0.0)] * 6)
    if pages is None:
        page = none
    else:
        found = page_view(pages)
        rows = rows.join(found, F.col("doc_id") == F.col("_page_doc"), "left")
        page = F.coalesce("_page", none)
    return settle(rows.select("doc_id", "row", "text_view", F.concat("meta", page).alias("meta_view")), "views")


@dataclass
class Line:
    """A logistic model over scaled numbers."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias

    def sure(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(x), -40, 40)))


def fit_line(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> Line:
    """Newton steps on the weighted logistic loss."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    a = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    hold = ridge * np.eye(len(w))
    hold[-1, -1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + hold @ w
        step = np.linalg.solve((a * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ a + hold, grad)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return Line(mean, scale, w[:-1], float(w[-1]))


@dataclass
class CoTrained:
    """Both views, their calibration and their combination."""

    text: Line
    meta: Line
    text_line: Line
    meta_line: Line
    both: Line

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        odds = self._odds(text, meta)
        return self.both.sure(odds), *(1 / (1 + np.exp(-np.clip(odds.T, -40, 40))))

    def _odds(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        first = self.text_line.odds(self.text.odds(text)[:, None])
        second = self.meta_line.odds(self.meta.odds(meta)[:, None])
        return np.clip(np.stack([first, second], axis=1), -12, 12)


def co_train(
    text: np.ndarray,
    meta: np.ndarray,
    y: np.ndarray,
    pool_text: np.ndarray,
    pool_meta: np.ndarray,
    rounds: int = ROUNDS,
) -> CoTrained | None:
    """Train on labelled rows and a pool; every fourth labelled row only calibrates.

    Without four rows of each class there is no model.
    """
    if min((y == 0).sum(), (y == 1).sum()) < 4:
        return None
    order = np.argsort(y, kind="stable")
    held = np.zeros(len(y), bool)
    held[order[::4]] = True
    views, pool = (text, meta), (pool_text, pool_meta)
    x = [v[~held] for v in views]
    labels, weights = [y[~held].astype(float)] * 2, [np.ones((~held).sum())] * 2
    free = np.ones(len(pool_text), bool)
    lines = [fit_line(x[i], labels[i], weights[i]) for i in (0, 1)]
    for _ in range(rounds):
        handed = []
        for i in (0, 1):
            sure = np.where(free, lines[i].sure(pool[i]), 0.5)
            best = np.argsort(-sure, kind="stable")[:HANDED]
            least = np.argsort(sure, kind="stable")[:HANDED]
            handed.append((best[sure[best] >= SURE], least[sure[least] <= 1 - SURE]))
        for i, (good, bad) in enumerate(handed):
            other, rows = 1 - i, np.concatenate([good, bad])
            x[other] = np.concatenate([x[other], pool[other][rows]])
            labels[other] = np.concatenate([labels[other], np.ones(len(good)), np.zeros(len(bad))])
            weights[other] = np.concatenate([weights[other], np.full(len(rows), PSEUDO_WEIGHT)])
            free[rows] = False
        if not any(len(r) for pair in handed for r in pair):
            break
        lines = [fit_line(x[i], labels[i], weights[i]) for i in (0, 1)]
    one = np.ones(held.sum())
    known = y[held].astype(float)
    calibrated = [
        fit_line(line.odds(v[held])[:, None], known, one) for line, v in zip(lines, views, strict=True)
    ]
    model = CoTrained(*lines, *calibrated, calibrated[0])
    model.both = fit_line(model._odds(text[held], meta[held]), known, one)
    return model


def _matrix(rows: list, name: str, width: int) -> np.ndarray:
    return np.array([r[name] for r in rows], np.float64).reshape(-1, width)


def _sample(found: DataFrame, labels: DataFrame, key: str, label: str) -> CoTrained | None:
    """Fit on labelled rows outside fold 1 and on a pool, both chosen by the hash of their id."""
    known = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("_id"))
        .agg((F.min(label) > 0).cast("int").alias("_label"))
    )
    rows = found.join(known, F.col("doc_id") == F.col("_id"), "left")
    order = [F.xxhash64("doc_id"), F.col("row")]
    labelled = rows.filter(F.col("_label").isNotNull() & (sample_class(F.col("doc_id")) != 1))
    picked = [
        r
        for value in (0, 1)
        for r in labelled.filter(F.col("_label") == value).orderBy(*order).limit(SAMPLE_DOCS).collect()
    ]
    pool = rows.filter("_label is null").orderBy(*order).limit(POOL_DOCS).collect()
    if not picked:
        return None
    wide = [len(picked[0][n]) for n in ("text_view", "meta_view")]
    known_views, pool_views = (
        [_matrix(part, n, w) for n, w in zip(("text_view", "meta_view"), wide, strict=True)]
        for part in (picked, pool)
    )
    return co_train(*known_views, np.array([r["_label"] for r in picked]), *pool_views)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    pages: DataFrame | None = None,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    n_chars: str = "n_chars",
    label: str = "quality",
    keep: float = KEEP,
) -> DataFrame:
    """``doc_id, row, score, text_score, meta_score, kept`` for every row.

    ``row`` tells apart rows that share an id. Null texts are empty, null metadata is a value of
    its own. Labels are read only outside fold 1 (crc32 of the id as text, modulo 3). With too
    few labels to train on every score is 1 and everything is kept.
    """
    found = views(docs, pages, key, text, lang, source, n_chars)
    model = _sample(found, labels, key, label)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            if model is None:
                scores = [np.ones(n)] * 3
            else:
                x = [np.asarray(b.column(i).flatten()).reshape(n, -1) for i in (2, 3)]
                scores = model.scores(*x)
            yield batch(
                doc_id=b.column(0),
                row=b.column(1),
                score=scores[0],
                text_score=scores[1],
                meta_score=scores[2],
            )

    schema = "doc_id long, row long, score double, text_score double, meta_score double"
    return found.mapInArrow(work, schema).withColumn("kept", F.col("score") >= keep)


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    pages: DataFrame | None = None,
    key: str = "doc_id",
    text: str = "text",
    **settings,
) -> DataFrame:
    """The rows that are kept, with all input columns."""
    good = score_quality(docs, labels, pages, key, text, **settings).filter("kept")
    good = good.select(F.col("doc_id").alias("_good_id"), F.col("row").alias("_good_row"))
    match = F.col(key).cast("long").eqNullSafe(F.col("_good_id")) & (row_key(F.col(text)) == F.col("_good_row"))
    return docs.join(good, match, "left_semi")
