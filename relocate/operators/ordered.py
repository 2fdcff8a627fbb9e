"""Ordered computations per key, over whole keys or over spans of them.

A window over a whole key puts all rows of that key into one task. Where keys may be large, the
caller names ``span_rows``: rows of a key are then cut into contiguous spans of that many rows,
windows run per span, and a short table with one row per span carries what earlier spans
contribute, either a running maximum or the few rows just before the span. The plan depends on
that parameter alone, never on counts; results are those of the plain window for any value.

``(keys, order)`` is unique. Keys may be null: null is a key like any other. Spans are cut by the
places of the rows, so a key has as many as it needs and rows far off do not make the others
share one. The cut rows are written to the shared folder: a lost task starts again from there.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from relocate.session import settle

SPAN = "_span"
HALO = "_halo"
_SLICE = "_slice"


@dataclass(frozen=True)
class Ordered:
    """Rows with the keys and the order their windows use; ``split`` if spans are in use."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: str
    split: bool

    @property
    def parts(self) -> list[str]:
        return [*self.keys, SPAN] if self.split else list(self.keys)

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(self.order)

    def having(self, rows: DataFrame) -> Ordered:
        return replace(self, rows=rows)

    def add(self, columns: dict[str, Column]) -> Ordered:
        return self.having(self.rows.withColumns(columns))

    def settled(self) -> Ordered:
        """Write split rows out once, so that later passes do not repeat earlier ones."""
        if not self.split:
            return self
        return self.having(settle(self.rows))

    def done(self) -> DataFrame:
        return self.rows.drop(SPAN, HALO)


def arrange(df: DataFrame, keys: list[str], order: str, span_rows: int | None = None) -> Ordered:
    """Lay rows out by whole keys, or cut every key into spans of ``span_rows`` rows.

    To cut, rows are dealt out by ranges of key and order and written. Each slice counts its rows
    per key; with the counts of the slices before it, places within a slice are places within the
    key. Rows of one place share a span.
    """
    if span_rows is None:
        return Ordered(df, tuple(keys), order, split=False)
    dealt = df.repartitionByRange(*keys, order).withColumn(_SLICE, F.spark_partition_id())
    dealt = settle(dealt, "slices")
    counts = dealt.groupBy(*keys, _SLICE).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_first", _SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    placed = _beside(dealt, counts.select(*keys, _SLICE, before.alias("_before")), [*keys, _SLICE])
    place = F.col("_before") + F.rank().over(Window.partitionBy(*keys, _SLICE).orderBy(order)) - 1
    spanned = placed.withColumn(SPAN, F.floor(place / span_rows).cast("bigint"))
    return Ordered(spanned.drop(_SLICE, "_before"), tuple(keys), order, split=True).settled()


def _beside(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Every row with the columns of the one table row that has its keys; null equals null."""
    other = table.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in table.columns if c not in keys]
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(other, same, "left").drop(*[f"_k_{k}" for k in keys])


def running_max(ordered: Ordered, values: dict[str, Column], *, before: bool = False) -> Ordered:
    """Add the running maximum of each value per key, of earlier rows only if ``before``."""
    frame = ordered.window.rowsBetween(
        Window.unboundedPreceding, -1 if before else Window.currentRow
    )
    if not ordered.split:
        return ordered.add({name: F.max(value).over(frame) for name, value in values.items()})
    keys = list(ordered.keys)
    tops = ordered.rows.groupBy(*ordered.parts).agg(*[F.max(v).alias(n) for n, v in values.items()])
    earlier = Window.partitionBy(*keys).orderBy(SPAN).rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(
        *ordered.parts, *[F.max(name).over(earlier).alias(f"_c_{name}") for name in values]
    )
    joined = _beside(ordered.rows, carried, ordered.parts).withColumns(
        {n: F.greatest(F.max(v).over(frame), F.col(f"_c_{n}")) for n, v in values.items()}
    )
    return ordered.having(joined.drop(*[f"_c_{name}" for name in values]))


def running_sum(ordered: Ordered, name: str, value: Column) -> Ordered:
    """Add the sum of a value over all rows up to each row's place; rows of one place share it.

    Here ``(keys, order)`` need not be unique: a span never ends inside a place.
    """
    frame = ordered.window.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    within = F.sum(value).over(frame)
    if not ordered.split:
        return ordered.add({name: within})
    earlier = (
        Window.partitionBy(*ordered.keys).orderBy(SPAN).rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = ordered.rows.groupBy(*ordered.parts).agg(F.sum(value).alias("_sum"))
    carried = sums.select(*ordered.parts, F.sum("_sum").over(earlier).alias("_carried"))
    joined = _beside(ordered.rows, carried, ordered.parts)
    return ordered.having(
        joined.withColumn(name, within + F.coalesce("_carried", F.lit(0))).drop("_carried")
    )


def running_last(ordered: Ordered, name: str, value: Column) -> Ordered:
    """Add the latest non-null value up to each row."""
    frame = ordered.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = F.last(value, ignorenulls=True).over(frame)
    if not ordered.split:
        return ordered.add({name: within})
    at = F.when(value.isNotNull(), F.col(ordered.order))
    ends = ordered.rows.groupBy(*ordered.parts).agg(F.max_by(value, at).alias("_end"))
    earlier = (
        Window.partitionBy(*ordered.keys).orderBy(SPAN).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = ends.select(
        *ordered.parts, F.last("_end", ignorenulls=True).over(earlier).alias("_carried")
    )
    joined = _beside(ordered.rows, carried, ordered.parts)
    return ordered.having(
        joined.withColumn(name, F.coalesce(within, F.col("_carried"))).drop("_carried")
    )


def look_back(ordered: Ordered, rows: int, columns: list[str]) -> Ordered:
    """Make ready for windows that look back at most ``rows`` rows at ``columns``.

    Each span takes in copies of the ``rows`` rows before it, marked by ``_halo``; drop them
    with :func:`looked_back` after the windows.
    """
    if not ordered.split:
        return ordered
    keys, parts, order = list(ordered.keys), ordered.parts, ordered.order
    newest = Window.partitionBy(*parts).orderBy(F.desc(order))
    tails = (
        ordered.rows.select(*parts, order, *columns)
        .withColumn("_back", F.row_number().over(newest))
        .filter(F.col("_back") <= rows)
        .groupBy(*parts)
        .agg(F.collect_list(F.struct(order, *columns)).alias("_tail"))
    )
    # Every span has a row, so the needed rows lie in the ``rows`` spans before it.
    earlier = Window.partitionBy(*keys).orderBy(SPAN).rowsBetween(-rows, -1)
    gathered = F.sort_array(F.flatten(F.collect_list("_tail").over(earlier)))
    start = F.greatest(F.size("_all") - rows, F.lit(0)) + 1
    halo = (
        tails.select(*parts, gathered.alias("_all"))
        .select(*parts, F.explode(F.slice("_all", start, F.lit(rows))).alias("_row"))
        .select(*parts, "_row.*", F.lit(True).alias(HALO))
    )
    own = ordered.rows.withColumn(HALO, F.lit(False))
    return ordered.having(own.unionByName(halo, allowMissingColumns=True))


def looked_back(ordered: Ordered) -> Ordered:
    if not ordered.split:
        return ordered
    return ordered.having(ordered.rows.filter(~F.col(HALO)).drop(HALO))


def latest_rows(df: DataFrame, keys: list[str], order: str, rows: int) -> DataFrame:
    """The last ``rows`` rows of each key; each task first drops all but its own last ones."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(order))
    return (
        df.withColumn("_back", F.row_number().over(newest))
        .filter(F.col("_back") <= rows)
        .drop("_back")
    )
