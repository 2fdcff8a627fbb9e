"""Removal of repeated passages: suffixes ordered by a depth-limited radix sort.

Two suffixes belong to one group when they agree through ``DEPTH`` bytes; a group of two or more
is a repeated window, and every byte under one is removed. The order is built by most-significant
-digit passes, and what a pass leaves alone is out of all later ones:

1. Digit one is the window's anchor: the 41 bytes in it with the least hash (the leftmost of
   equals). Equal windows have the same anchor at the same place, so suffixes are handed on as
   *cells*: all windows around one anchor, in one row.
2. Digit two splits a cell by 16 places of the window start.
3. Digit three is the single window.

In each pass rows are sorted by the digit, which is the part that all windows of a row share, and
then by the bytes under all of them. A row alone in its digit holds no repeated window. Rows with
all bytes equal are wholly repeated. Only digits with more than one content go on, one row of
each content. Bytes are compared through two independent 64-bit hashes.

Rows of a digit stream by in sorted order and only one row is held, so a large group needs no
memory; equal rows are folded in the task that finds them, so that a passage that a third of all
documents share meets the shuffle once per task. A short phrase that very many documents share
among different surroundings is a digit with very many contents: such digits show in a sample, and
their rows are dealt out by content. That they have several contents is known then, so whatever
the sample shows, the result is the same; at worst a row goes on that could have stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.llm.common import batch, in_batches, row_key, text_bytes, whole
from relocate.llm.merge_arrays import mixed
from relocate.session import settle

DEPTH = 200
ANCHOR = 41
SPREAD = DEPTH - ANCHOR + 1  # windows that can share an anchor
STEP = 16
#: Windows looked at together: longer texts are worked off in stretches of this size.
STRETCH = 1 << 18
#: Rows that a task folds before it hands them on.
FOLD_ROWS = 400_000
#: Rows of its source that a pass looks at for crowded digits, the contents that make one, and how
#: many digits are dealt out by content.
SAMPLE_ROWS, CROWD, CROWDED_DIGITS = 4_000, 16, 1_000
ROWS = "digit long, content long, copies int, doc_id long, row long, anchor int, lo int, hi int"
NAMES = [c.split()[0] for c in ROWS.split(", ")]
FOUND = "repeated boolean, doc_id long, row long, anchor int, lo int, hi int"
PLACE = NAMES[3:]

Rows = dict[str, np.ndarray]


class Hashes:
    """Hashes of any stretch of a byte array, from running sums."""

    def __init__(self, size: int):
        draw = np.random.default_rng(20240229)
        self.byte = draw.integers(1, 2**64, (2, 256), dtype=np.uint64)
        self.up, self.down = [], []
        for base in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95):
            self.up.append(self._powers(base, size))
            self.down.append(self._powers(pow(base, -1, 2**64), size))

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def sums(self, data: np.ndarray) -> list[np.ndarray]:
        out = []
        for which in (0, 1):
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.byte[which][data] * self.up[which][: len(data)], out=total[1:])
            out.append(total)
        return out

    def of(self, sums: list[np.ndarray], which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = sums[which]
        return mixed((total[end] - total[start]) * self.down[which][start] + (end - start).astype(np.uint64))


_hashes: list[Hashes] = []


def hashes() -> Hashes:
    """Tables built once in each worker."""
    if not _hashes:
        _hashes.append(Hashes(STRETCH + 2 * DEPTH))
    return _hashes[0]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima of blocks."""
    n = len(values) - width + 1
    blocks = np.concatenate([values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)])
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def cells(data: np.ndarray) -> Rows:
    """Digit one: the cells of one text. A window is named by the byte it starts at."""
    h, out = hashes(), []
    for base in range(0, max(0, len(data) - DEPTH + 1), STRETCH):
        part = data[base : base + STRETCH + DEPTH - 1]
        sums = h.sums(part)
        place = np.arange(len(part) - ANCHOR + 1)
        grams = h.of(sums, 0, place, place + ANCHOR)
        order = (grams >> np.uint64(24) << np.uint64(24)) | place.astype(np.uint64)
        least = _least_in_windows(order, SPREAD)
        lo = _runs(least)
        hi = np.append(lo[1:], len(least)) - 1
        anchor = (least[lo] & np.uint64((1 << 24) - 1)).astype(np.int64)
        inside = ((anchor - lo) * DEPTH + (hi - lo)).astype(np.uint64)
        content = mixed(h.of(sums, 1, lo, hi + DEPTH) + inside)
        out.append((grams[anchor], content, anchor + base, lo + base, hi + base))
    return _rows(out)


def _rows(parts: list[tuple]) -> Rows:
    names = ("digit", "content", "anchor", "lo", "hi")
    if not parts:
        return {n: np.zeros(0, np.int64) for n in names}
    joined = [np.concatenate(c) for c in zip(*parts, strict=True)]
    return dict(zip(names, [_signed(joined[0]), _signed(joined[1]), *joined[2:]], strict=True))


def _stretches(lo: np.ndarray, hi: np.ndarray, step: int) -> tuple[np.ndarray, ...]:
    """Every ``[lo, hi]`` cut at multiples of ``step``: source row, first and last."""
    first, last = lo // step, hi // step
    count = last - first + 1
    row = np.repeat(np.arange(len(lo)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
    return row, np.maximum(number * step, lo[row]), np.minimum(number * step + step - 1, hi[row])


def refine(
    context: list[bytes],
    anchor: np.ndarray,
    lo: np.ndarray,
    hi: np.ndarray,
    begin: np.ndarray,
    step: int,
) -> tuple[np.ndarray, Rows]:
    """Digits two and three: windows ``lo`` to ``hi`` around each anchor, ``step`` starts a row.

    ``context`` holds the bytes from ``begin`` on. Returns the source row of each new row.
    """
    h = hashes()
    data = np.frombuffer(b"".join(context), np.uint8)
    sizes = np.fromiter(map(len, context), np.int64, len(context))
    shift = np.cumsum(sizes) - sizes - begin  # from places in the text to places in data
    sums = h.sums(data)
    row, near, far = _stretches(anchor - hi, anchor - lo, step)  # distances from start to anchor
    start, end = anchor[row] - far, anchor[row] - near
    level = near // step * step
    at = shift[row]
    shared = anchor[row] - level + at
    digit = mixed(h.of(sums, 0, shared, shared + DEPTH - step + 1) + level.astype(np.uint64) * np.uint64(step > 1))
    inside = ((far - level) * step + (near - level)).astype(np.uint64) * np.uint64(step > 1)
    content = mixed(h.of(sums, 1, start + at, end + DEPTH + at) + inside)
    found = {"digit": _signed(digit), "content": _signed(content), "anchor": anchor[row], "lo": start, "hi": end}
    return row, found


def _take(rows: Rows, which: np.ndarray) -> Rows:
    return {n: c[which] for n, c in rows.items()}


def _join(parts: list[Rows], names: list[str] = NAMES) -> Rows:
    return {n: np.concatenate([p[n] for p in parts]) for n in names}


def fold(rows: Rows) -> Rows:
    """One row for equal rows of a task, with ``copies`` 2; their places go along with ``copies`` 0."""
    order = np.lexsort((rows["content"], rows["digit"]))
    rows = _take(rows, order)
    head = _runs(rows["digit"], rows["content"])
    sizes = np.diff(np.append(head, len(order)))
    kept = _take(rows, head)
    kept["copies"] = np.minimum(sizes, 2).astype(np.int32)
    known = _take(rows, np.repeat(sizes > 1, sizes))
    order = np.lexsort((known["lo"], known["row"], known["doc_id"]))
    known = _take(known, order)
    head = _joined_runs(known)
    merged = _take(known, head)
    merged["hi"] = known["hi"][np.append(head[1:], len(order))[: len(head)] - 1]
    merged["copies"] = np.zeros(len(head), np.int32)
    merged["digit"] = _signed(mixed(merged["doc_id"].astype(np.int64).view(np.uint64)))
    return _join([kept, merged])


def _joined_runs(rows: Rows) -> np.ndarray:
    """Where a stretch begins that does not go on from the row before."""
    new = _runs(rows["doc_id"], rows["row"])
    mark = np.zeros(len(rows["lo"]), bool)
    mark[new] = True
    mark[1:] |= rows["lo"][1:] != rows["hi"][:-1] + 1
    return np.flatnonzero(mark)


def _arrow(rows: Rows, names: list[str]) -> pa.RecordBatch:
    small = {"copies", "anchor", "lo", "hi"}
    return batch(**{n: rows[n].astype(np.int32) if n in small else rows[n] for n in names})


def _columns(b: pa.RecordBatch) -> Rows:
    return {n: c.to_numpy(zero_copy_only=False) for n, c in zip(b.schema.names, b.columns, strict=True)}


def judge(batches: Iterator[pa.RecordBatch], crowded: Sequence[int] = ()) -> Iterator[pa.RecordBatch]:
    """One pass over rows in order of digit and content.

    Yields places that are repeated, and one row of each content of a digit that has several;
    digits in ``crowded`` are known to.
    """
    known = np.array(crowded, np.int64)
    held: Rows | None = None
    several = False  # the held row's digit is known to have several contents

    def found(rows: Rows, repeated: bool) -> pa.RecordBatch:
        rows = {**rows, "repeated": np.full(len(rows["lo"]), repeated)}
        return _arrow(rows, ["repeated", *PLACE])

    for b in batches:
        rows = _columns(b)
        passing = rows["copies"] == 0
        if passing.any():
            yield found(_take(rows, passing), True)
            rows = _take(rows, ~passing)
        if not len(rows["lo"]):
            continue
        rows = _join([held, rows]) if held else rows
        head = _runs(rows["digit"], rows["content"])
        sizes = np.diff(np.append(head, len(rows["lo"])))
        copies = np.add.reduceat(rows["copies"], head)
        again = np.repeat(copies > 1, sizes)
        if again.any():
            yield found(_take(rows, again), True)
        digit = _runs(rows["digit"][head])
        contents = np.diff(np.append(digit, len(head)))
        open_digit = np.repeat(contents > 1, contents)
        if several:
            open_digit[: contents[0]] = True
        if len(known):
            open_digit |= np.isin(rows["digit"][head], known)
        done = open_digit[:-1]
        if done.any():
            yield found(_take(rows, head[:-1][done]), False)
        held = _take(rows, head[-1:])
        held["copies"] = np.minimum(copies[-1:], 2).astype(np.int32)
        several = bool(open_digit[-1])
    if held and several:
        yield found(held, False)


def _crowded(sample: DataFrame, produce: Callable[[pa.RecordBatch], list[Rows]]) -> list[int]:
    """Digits with many contents in a sample of a pass's source, the most crowded first."""
    rows = in_batches(sample, _folded(produce), ROWS).filter("copies > 0")
    counts = rows.groupBy("digit").agg(F.countDistinct("content").alias("n")).filter(F.col("n") >= CROWD)
    return [r.digit for r in counts.orderBy(F.desc("n"), "digit").limit(CROWDED_DIGITS).collect()]


def _sampled(rows: DataFrame) -> DataFrame:
    """Some ``SAMPLE_ROWS`` rows; all of a small source."""
    return rows.sample(min(1.0, SAMPLE_ROWS / max(rows.count(), 1)), seed=42)


def _pass(source: DataFrame, sample: DataFrame, produce: Callable[[pa.RecordBatch], list[Rows]], name: str) -> DataFrame:
    crowded = _crowded(sample, produce)
    rows, share = in_batches(source, _folded(produce), ROWS), F.col("digit")
    if crowded:
        share = F.when(F.col("digit").isin(crowded), F.xxhash64("digit", "content")).otherwise(F.col("digit"))
    ordered = rows.repartition(share).sortWithinPartitions("digit", "content")
    return settle(ordered.mapInArrow(lambda batches: judge(batches, crowded), FOUND), name)


def _folded(produce: Callable[[pa.RecordBatch], list[Rows]]):
    """Turn batches into rows, folding what a task finds before it hands them on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for b in batches:
            for rows in produce(b):
                parts.append(rows)
                size += len(rows["lo"])
                if size >= FOLD_ROWS:
                    yield _arrow(fold(_join(parts, [n for n in NAMES if n != "copies"])), NAMES)
                    parts, size = [], 0
        if size:
            yield _arrow(fold(_join(parts, [n for n in NAMES if n != "copies"])), NAMES)

    return work


def _produce_cells(b: pa.RecordBatch) -> list[Rows]:
    out = []
    ids, rows = (c.to_numpy(zero_copy_only=False) for c in b.columns[:2])
    for doc_id, row, text in zip(ids, rows, text_bytes(b.column(2)), strict=True):
        if len(text) >= DEPTH:
            found = cells(np.frombuffer(text, np.uint8))
            size = len(found["lo"])
            out.append(found | {"doc_id": np.full(size, doc_id, np.int64), "row": np.full(size, row, np.int64)})
    return out


def _produce_refined(step: int):
    def produce(b: pa.RecordBatch) -> list[Rows]:
        out = []
        most = STRETCH // (2 * DEPTH)
        for i in range(0, b.num_rows, most):
            part = b.slice(i, most)
            c = _columns(part.select([n for n in part.schema.names if n != "context"]))
            row, found = refine(
                text_bytes(part.column("context")),
                *(c[n].astype(np.int64) for n in ("anchor", "lo", "hi", "begin")),
                step,
            )
            out.append(found | {"doc_id": c["doc_id"][row], "row": c["row"][row]})
        return out

    return produce


def _contexts(docs: DataFrame, open_cells: DataFrame) -> DataFrame:
    """The bytes that the windows of each open cell cover."""
    wanted = open_cells.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(
        F.collect_list(F.struct("anchor", "lo", "hi")).alias("cells")
    )
    joined = docs.join(wanted, (F.col("doc_id") == F.col("_id")) & (F.col("row") == F.col("_row")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = b.column(3)
            sizes = np.diff(cell.offsets.to_numpy())
            flat = [f.to_numpy(zero_copy_only=False) for f in cell.flatten().flatten()]
            source = np.repeat(np.arange(b.num_rows), sizes)
            texts = text_bytes(b.column(2))
            anchor, lo, hi = flat
            yield batch(
                doc_id=b.column(0).to_numpy(zero_copy_only=False)[source],
                row=b.column(1).to_numpy(zero_copy_only=False)[source],
                anchor=anchor,
                lo=lo,
                hi=hi,
                begin=lo,
                context=pa.array(
                    [texts[s][i : j + DEPTH] for s, i, j in zip(*map(list, (source, lo, hi)), strict=True)],
                    pa.binary(),
                ),
            )

    schema = "doc_id long, row long, anchor int, lo int, hi int, begin int, context binary"
    return settle(in_batches(joined.select("doc_id", "row", "text", "cells"), work, schema), "contexts")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc_id, row, lo, hi``: starts of windows that also occur elsewhere.

    ``docs`` has ``doc_id``, ``row`` (tells apart rows with one id) and ``text``.
    """
    first = _pass(docs, _sampled(docs), _produce_cells, "cells")
    contexts = _contexts(docs, first.filter("not repeated"))
    some = _sampled(contexts)
    second = _pass(contexts, some, _produce_refined(STEP), "blocks")
    open_blocks = second.filter("not repeated").select(*[F.col(n).alias(f"_{n}") for n in PLACE])
    same = (F.col("doc_id") == F.col("_doc_id")) & (F.col("row") == F.col("_row"))
    same &= F.col("anchor") == F.col("_anchor")
    inside = (F.col("_lo") >= F.col("lo")) & (F.col("_hi") <= F.col("hi"))

    def blocks(rows: DataFrame) -> DataFrame:
        return rows.join(open_blocks, same & inside).select(
            "doc_id", "row", "anchor", F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), "begin", "context"
        )

    third = _pass(blocks(contexts), blocks(some), _produce_refined(1), "windows")
    found = first.unionByName(second).unionByName(third)
    return found.filter("repeated").select("doc_id", "row", "lo", "hi")


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """A text without the bytes under windows that start in ``spans``, and the runs removed."""
    runs: list[list[int]] = []
    for lo, hi in sorted(spans):
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi + DEPTH)
        else:
            runs.append([lo, hi + DEPTH])
    kept, at = [], 0
    for a, z in runs:
        kept.append(text[at:a])
        at = z
    return b"".join([*kept, text[at:]]), [(a, z) for a, z in runs]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with ``kept_bytes`` (what is left of its text), ``removed`` (start and end of
    each maximal run removed), ``n_bytes``, ``n_removed`` and ``n_spans``.

    Only the id goes along. Null texts are empty, null ids stay null; rows that repeat id and
    text repeat each other's passages; rows that only share an id are different documents.
    """
    null_id = np.iinfo(np.int64).min
    base = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(null_id)).alias("doc_id"),
        row_key(F.col(text).cast("string")).alias("row"),
        whole(F.col(text).cast("string")).alias("text"),
    )
    spans = repeated_windows(base).groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(
        F.collect_list(F.struct("lo", "hi")).alias("spans")
    )
    joined = base.join(spans, (F.col("doc_id") == F.col("_id")) & (F.col("row") == F.col("_row")), "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = text_bytes(b.column(1))
            rows = [
                cut(t, [(s["lo"], s["hi"]) for s in x or []])
                for t, x in zip(texts, b.column(2).to_pylist(), strict=True)
            ]
            yield batch(
                doc_id=b.column(0),
                n_bytes=pa.array(map(len, texts), pa.int64()),
                n_removed=pa.array([len(t) - len(k) for t, (k, _) in zip(texts, rows, strict=True)], pa.int64()),
                n_spans=pa.array([len(r) for _, r in rows], pa.int64()),
                kept_bytes=pa.array([k for k, _ in rows], pa.binary()),
                removed=pa.array(
                    [[{"start": a, "end": z} for a, z in r] for _, r in rows],
                    pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                ),
            )

    schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary, "
        "removed array<struct<start: int, end: int>>"
    )
    out = in_batches(joined.select("doc_id", "text", "spans"), work, schema)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != null_id, F.col("doc_id")))

