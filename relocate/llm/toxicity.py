"""Toxicity: a support vector machine over a subsequence string kernel, with Nyström landmarks.

The kernel of two words sums over all letter triples that occur in both, in order but with gaps
inside a span of six; every letter skipped costs a factor. So an insult with inserted or doubled
characters keeps most of its triples. Words are folded first: case, marks inside a word, figures
that stand for letters, and letters set apart by spaces.

Landmark words span the feature space (Nyström); a linear machine over it is trained on labelled
sentences. Every word of a clean document's sentences is clean. A toxic document says only that
some sentence is toxic: training starts with the words that set toxic documents apart most, and
moves to the words that the machine itself finds worst until that settles. A sentence is as bad
as its worst word, a document as its worst sentence, and that value is calibrated on documents that
the machine did not see.

A machine over landmarks is a weighted sum of kernels, so it is the same as one weight per
triple: scoring looks triples up in a table and never meets a landmark.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.llm.common import batch, in_batches, row_key, sample_class, whole
from relocate.llm.merge_arrays import mixed
from relocate.session import settle

GRAM = 3
SPAN = 6
DECAY = 0.6
TABLE_BITS = 20
LANDMARKS = 192
#: Labelled documents of each class that training reads, and the longest text among them.
SAMPLE_DOCS = 1200
SAMPLE_BYTES = 6000
ROUNDS = 4
#: Parts of the sample that are judged by a machine of the others, to calibrate the odds.
FOLDS = 3
#: Worst words of a toxic document that training takes as toxic, and clean words it starts with.
WITNESSES = 2
CLEAN_WORDS = 20_000
RIDGE = 1.0
THRESHOLD = 0.7
KEPT_WORDS = 1_000_000

#: Figures and signs that are read as letters.
_LIKE = str.maketrans("013457@$", "oieastas")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_APART = re.compile(r"(?<!\S)(?:\w[^\w\s]?[ \t]+){2,}\w(?!\w)")
_MARKS = re.compile(r"[\W_]+")
_LONG_RUN = re.compile(r"(.)\1\1+")


def folded(token: str) -> str:
    """A word as the kernel sees it: letters only, figures read as letters, long runs as one."""
    return _LONG_RUN.sub(r"\1", _MARKS.sub("", token.lower().translate(_LIKE)))


def sentences(text: str) -> list[list[str]]:
    """Tokens of each sentence; letters set apart by spaces are one token."""
    return [part.split() + _APART.findall(part) for part in _SENTENCE.split(text)]


def tokens(text: str) -> set[str]:
    """All different tokens of all sentences of a text."""
    found = set(text.split())
    found.update(_APART.findall(text))
    return found


def _steps() -> list[tuple[tuple[int, ...], float]]:
    """Offsets of the later letters of a triple, and the weight of their gaps."""
    return [(o, DECAY ** (o[-1] - GRAM + 1)) for o in combinations(range(1, SPAN), GRAM - 1)]


def _norms(lengths: np.ndarray) -> np.ndarray:
    """What a word's kernel with itself is if no triple comes twice; its root scales the word."""
    total = np.zeros(len(lengths))
    for offsets, weight in _steps():
        total += weight**2 * np.maximum(lengths - offsets[-1], 0)
    return np.sqrt(np.maximum(total, 1e-12))


def triples(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each gap pattern: the word and the table place of each triple, and the weight."""
    marked = [f"^{w}$" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(marked)), lengths)
    for offsets, weight in _steps():
        last = offsets[-1]
        if len(codes) <= last:
            continue
        inside = np.flatnonzero(word[:-last] == word[last:])
        key = codes[inside]
        for o in offsets:
            key = key * np.uint64(0x110000) + codes[inside + o]
        yield word[inside], (mixed(key) >> np.uint64(64 - TABLE_BITS)).astype(np.int64), weight


@dataclass
class ToxicModel:
    """Weights of triples, and the line that turns a document's worst sentence into odds."""

    places: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    intercept: float

    def table(self) -> np.ndarray:
        out = np.zeros(1 << TABLE_BITS)
        out[self.places] = self.weights
        return out

    def odds(self, worst: np.ndarray) -> np.ndarray:
        return self.slope * (worst + self.bias) + self.intercept

    def score(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(worst), -40, 40)))


def word_values(words: list[str], table: np.ndarray) -> np.ndarray:
    """What each word adds to its sentence."""
    total = np.zeros(len(words))
    for word, place, weight in triples(words):
        total += weight * np.bincount(word, table[place], len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return total / _norms(lengths)


class Scorer:
    """Scores texts, remembering tokens."""

    def __init__(self, model: ToxicModel):
        self.model, self.table, self.known = model, model.table(), {}

    def learn(self, needed: set[str]) -> None:
        new = list(needed.difference(self.known))
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known.clear()
            new = list(needed)
        self.known.update(zip(new, word_values([folded(t) for t in new], self.table).tolist(), strict=True))

    def worst(self, texts: list[str]) -> np.ndarray:
        cut = [tokens(t) for t in texts]
        self.learn(set().union(*cut))
        return np.array([max(map(self.known.__getitem__, t), default=0.0) for t in cut])

    def score(self, texts: list[str]) -> np.ndarray:
        return self.model.score(self.worst(texts))


def _kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernels of words (rows) and landmarks."""
    place_of, dense = _landmark_features(landmarks)
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for i in range(0, len(words), 1000):
        part = words[i : i + 1000]
        keys = list(triples(part))
        word = np.concatenate([k[0] for k in keys]) if keys else np.zeros(0, np.int64)
        place = np.concatenate([place_of[k[1]] for k in keys]) if keys else word
        weight = np.concatenate([np.full(len(k[0]), k[2]) for k in keys]) if keys else np.zeros(0)
        used = np.flatnonzero(place >= 0)
        used = used[np.argsort(word[used], kind="stable")]
        if len(used):
            rows = dense[place[used]] * weight[used, None].astype(np.float32)
            head = np.flatnonzero(np.diff(word[used], prepend=-1))
            out[i + word[used][head]] = np.add.reduceat(rows, head, axis=0)
        out[i : i + len(part)] /= _norms(np.array([len(w) + 2 for w in part]))[:, None]
    return out


def _landmark_features(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    place_of = np.full(1 << TABLE_BITS, -1, np.int64)
    keys = list(triples(landmarks))
    places = np.unique(np.concatenate([k[1] for k in keys]))
    place_of[places] = np.arange(len(places))
    dense = np.zeros((len(places), len(landmarks)), np.float32)
    for word, place, weight in keys:
        np.add.at(dense, (place_of[place], word), weight)
    return place_of, dense / _norms(np.array([len(w) + 2 for w in landmarks]))[None, :].astype(np.float32)


def _contrast(docs: list[list[str]], labels: np.ndarray) -> dict[str, float]:
    """How much more often a word is in toxic documents, weighed by how sure that is."""
    toxic, clean = Counter(), Counter()
    for words, label in zip(docs, labels, strict=True):
        (toxic if label else clean).update(words)
    n, m = max(1, labels.sum()), max(1, (~labels).sum())
    return {w: np.log((c + 0.5) / n) - np.log((clean[w] + 0.5) / m) for w, c in toxic.items() if c > 1}


def _machine(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A linear machine with squared hinge loss; both classes weigh the same. Last entry: bias."""
    x = np.hstack([z, np.ones((len(z), 1), z.dtype)]).astype(np.float64)
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    beta, active = np.zeros(x.shape[1]), np.ones(len(y), bool)
    for _ in range(25):
        a = x[active] * cost[active, None]
        beta = np.linalg.solve(a.T @ x[active] + RIDGE * np.eye(x.shape[1]), a.T @ y[active])
        now = y * (x @ beta) < 1
        if (now == active).all():
            break
        active = now
    return beta


def _calibrate(worst: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the odds, by Newton steps on the logistic loss."""
    x = np.stack([worst, np.ones(len(worst))], axis=1)
    hits = labels.sum()
    t = np.where(labels, (hits + 1) / (hits + 2), 1 / (len(labels) - hits + 2))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - t) + 1e-3 * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2), grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-6)), float(w[1])


def _garbled(word: str) -> list[str]:
    """A toxic word as it is also written: with a foreign letter at each place inside it."""
    cuts = range(1, len(word)) if len(word) > 3 else ()
    return [f"{word[:cut]}{'xz'[cut % 2]}{word[cut:]}" for cut in cuts]


def fit(texts: list[str], labels: list[int], landmarks: int = LANDMARKS, folds: int = FOLDS) -> ToxicModel:
    """Train on labelled texts. Without both classes every text gets the share of toxic ones.

    The odds are calibrated on texts that the machine did not see: each of ``folds`` parts is judged
    by a machine of the others. Nothing depends on anything but texts and labels in their order.
    """
    y = np.array(labels, bool)
    bags = [sorted({folded(t) for s in sentences(x) for t in s} - {""}) for x in texts]
    if y.all() or not y.any() or not any(bags):
        share = float(np.clip(y.mean() if len(y) else 0.0, 0.01, 0.99))
        return ToxicModel(np.zeros(0, np.int64), np.zeros(0), 0.0, 1e-6, float(np.log(share / (1 - share))))
    model, part = _trained(bags, y, landmarks), np.arange(len(y)) % folds
    seen, told = [], []
    for k in range(folds):
        train, held = np.flatnonzero(part != k), np.flatnonzero(part == k)
        if not len(held) or y[train].all() or not y[train].any():
            continue
        other = _trained([bags[i] for i in train], y[train], landmarks)
        seen.append(Scorer(other).worst([texts[i] for i in held]) + other.bias)
        told.append(y[held])
    if not seen or not np.concatenate(told).any() or np.concatenate(told).all():
        seen, told = [Scorer(model).worst(texts) + model.bias], [y]
    model.slope, model.intercept = _calibrate(np.concatenate(seen), np.concatenate(told))
    return model


def _trained(bags: list[list[str]], y: np.ndarray, landmarks: int) -> ToxicModel:
    """The machine of texts given by their folded words in order, its odds not calibrated yet."""
    contrast = _contrast(bags, y)
    apart = sorted(contrast, key=lambda w: (-contrast[w], w))[: landmarks // 2]
    common = Counter(w for b, label in zip(bags, y, strict=True) if not label for w in b)
    plain = sorted(common, key=lambda w: (-common[w], w))
    chosen = sorted(set(apart) | set(plain[: landmarks - len(apart)]))

    words = sorted(set().union(*bags))
    number = {w: i for i, w in enumerate(words)}
    gram = _kernel(chosen, chosen).astype(np.float64)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
    z = _kernel(words, chosen) @ root.astype(np.float32)

    clean = np.array([w in common for w in words])
    toxic_bags = [np.array([number[w] for w in b]) for b, label in zip(bags, y, strict=True) if label and b]
    value = np.array([contrast.get(w, -1.0) for w in words])
    draw = np.random.default_rng(42).permutation(np.flatnonzero(clean))
    against = draw[:CLEAN_WORDS]
    place_of, dense = _landmark_features(chosen)
    beta = np.zeros(z.shape[1] + 1)
    for _ in range(ROUNDS):
        worst = [b[np.argsort(-value[b], kind="stable")[:WITNESSES]] for b in toxic_bags]
        witness = np.unique(np.concatenate(worst))
        witness = witness[~clean[witness] & (value[witness] > 0)]
        if not len(witness):
            break
        garbled = sorted({g for w in witness for g in _garbled(words[w])} - common.keys())
        odd = _kernel(garbled, chosen) @ root.astype(np.float32)
        x = np.concatenate([z[witness], odd, z[against]])
        beta = _machine(x, np.concatenate([np.ones(len(witness) + len(odd)), -np.ones(len(against))]))
        value = z @ beta[:-1] + beta[-1]
        hard = np.flatnonzero(clean & (value > -0.5))
        against = np.union1d(against, hard[np.argsort(-value[hard], kind="stable")[:CLEAN_WORDS]])
    weights = dense.astype(np.float64) @ (root @ beta[:-1])
    return ToxicModel(np.flatnonzero(place_of >= 0), weights, float(beta[-1]), 1.0, 0.0)


def training_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample_docs: int, sample_bytes: int
) -> tuple[list[str], list[int]]:
    """Up to ``sample_docs`` labelled texts of each class outside the held-out fold, by hash of
    their id, none longer than ``sample_bytes``; longer ones do not count towards the limit. Rows
    equal in id and text count once. Only keys of the sample are sent to the tasks."""
    known = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & (sample_class(F.col(key)) != 1))
        .groupBy(F.col(key).alias("_id"))
        .agg((F.max(label) > 0).cast("int").alias("_label"))
    )
    body = whole(text)
    short = docs.filter(F.octet_length(body) <= sample_bytes).select(F.col(key).alias("_id"), row_key(body).alias("_row"))
    found = settle(short.distinct().join(known, "_id"), "labelled")
    ids = [
        r
        for value in (0, 1)
        for r in found.filter(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id", "_row").limit(sample_docs).collect()
    ]
    if not ids:
        return [], []
    wanted = docs.sparkSession.createDataFrame(ids, found.schema).withColumnsRenamed({"_id": "_own", "_row": "_key"})
    same = (F.col("_id") == F.col("_own")) & (F.col("_row") == F.col("_key"))
    rows = (
        docs.select(F.col(key).alias("_id"), row_key(body).alias("_row"), body.alias("_text"))
        .join(F.broadcast(wanted), same)  # at most 2 * sample_docs keys
        .dropDuplicates(["_id", "_row"])
        .orderBy("_id", "_row")
        .collect()
    )
    return [r["_text"] for r in rows], [r["_label"] for r in rows]


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    threshold: float = THRESHOLD,
    sample_docs: int = SAMPLE_DOCS,
    sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row, from its whole text alone.

    Labels are read only for ids outside fold 1 (crc32 of the id as text, modulo 3). Null texts
    are empty; empty texts score as texts without any toxic word. Rows that repeat score alike.
    """
    texts, known = training_sample(docs, labels, key, text, label, sample_docs, sample_bytes)
    model = fit(texts, known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            found = scorer.score([t or "" for t in b.column(1).to_pylist()])
            yield batch(doc_id=b.column(0), score=found)

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = in_batches(narrow, work, "doc_id long, score double")
    return scored.select(
        "doc_id",
        (sample_class(F.col("doc_id")) == 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
