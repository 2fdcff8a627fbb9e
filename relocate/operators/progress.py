"""Progress, trend, throughput, delay and stall measures over observation rows.

An observation row is one look at one run: ``run_id, tick, obs_us, …``. ``tick`` orders
the looks and is unique in its run; times are epoch micros; "now" is always ``obs_us``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from relocate import fixed
from relocate.operators.ordered import (
    Ordered,
    arrange,
    latest_rows,
    look_back,
    looked_back,
    running_last,
    running_max,
)

RUN = ["run_id"]
TICK = "tick"


def whole_seconds(micros: Column) -> Column:
    return F.floor(micros / 1_000_000).cast("bigint")


def age_seconds(now_us: Column, then_us: Column) -> Column:
    """Whole seconds between two times, cut towards zero."""
    gap = now_us - then_us
    return (F.signum(gap).cast("bigint") * F.floor(F.abs(gap) / 1_000_000)).cast("bigint")


# --- table and byte progress -------------------------------------------------------


def copy_progress(sizes: DataFrame, completed: DataFrame, status: DataFrame) -> DataFrame:
    """Tables and bytes done of every run that has a status or sizes, in one pass over each.

    ``sizes``: ``run_id, table_name, source_bytes, target_bytes``; ``completed``: remembered and
    detected ``run_id, table_name``; ``status``: ``run_id, tables_in_sync, copy_phase``, one row
    per run. A run without sizes has no tables and no bytes. The reported number may count more
    than tables, so it is used only within the known total.

    Sizes of finished tables count in full; while the copy runs, target sizes capped at source
    sizes may show more; the share of tables done is the last resort.
    """
    source, target = F.col("source_bytes"), F.coalesce(F.col("target_bytes"), F.lit(0))
    done = completed.select("run_id", "table_name").distinct().withColumn("_done", F.lit(1))
    sized = sizes.withColumn("_sized", F.lit(1)).join(done, ["run_id", "table_name"], "full")

    def total_of(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    has_size, is_done = F.col("_sized").isNotNull(), F.col("_done").isNotNull()
    per_run = sized.groupBy("run_id").agg(
        total_of(F.col("_sized")).alias("total_tables"),
        total_of(F.col("_done")).alias("_found"),
        total_of(source).alias("total_bytes"),
        total_of(F.when(has_size & is_done, source)).alias("_finished"),
        total_of(F.when(has_size & (source > 0), F.least(source, target))).alias("_on_target"),
    ).filter(F.col("total_tables") > 0)
    runs = status.select("run_id", "tables_in_sync", "copy_phase").join(per_run, "run_id", "full")
    counts = ("total_tables", "_found", "total_bytes", "_finished", "_on_target")
    runs = runs.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in counts})

    reported, found, tables = F.col("tables_in_sync"), F.col("_found"), F.col("total_tables")
    best = F.when(reported.between(1, tables), F.greatest(found, reported)).otherwise(found)
    complete = F.when(F.col("copy_phase") == fixed.COPY_DONE, tables).otherwise(F.least(best, tables))
    runs = runs.withColumn("tables_completed", complete.cast("bigint"))

    total, finished, on_target = F.col("total_bytes"), F.col("_finished"), F.col("_on_target")
    by_size = (
        F.coalesce(F.col("copy_phase") == fixed.COPY_RUNNING, F.lit(False))
        & (total > 0)
        & (on_target > finished)
    )
    measured = F.when(by_size, on_target).otherwise(finished)
    by_ratio = (measured <= 0) & (total > 0) & (tables > 0) & (F.col("tables_completed") > 0)
    ratio = F.round(F.col("tables_completed") / tables * total).cast("bigint")
    copied = F.when(by_ratio, ratio).otherwise(measured)
    mode = (
        F.when(by_ratio, fixed.MODE_RATIO)
        .when(by_size, fixed.MODE_SIZES)
        .otherwise(fixed.MODE_TABLES)
    )
    return runs.select(
        "run_id",
        "total_tables",
        "tables_completed",
        copied.alias("copied_bytes"),
        "total_bytes",
        percent(copied, total).alias("percent"),
        mode.alias("estimate_mode"),
    )


def tables_completed(sizes: DataFrame, completed: DataFrame, status: DataFrame) -> DataFrame:
    """Tables done per run: ``run_id, total_tables, tables_completed``."""
    return copy_progress(sizes, completed, status).select(
        "run_id", "total_tables", "tables_completed"
    )


def byte_progress(sizes: DataFrame, completed: DataFrame, status: DataFrame) -> DataFrame:
    """Bytes done per run, how they were estimated, and the percentage to one decimal."""
    return copy_progress(sizes, completed, status).drop("total_tables", "tables_completed")


def percent(part: Column, total: Column) -> Column:
    """Share in percent to one decimal, a half rounded up as the doubles are.

    ``round(x, 1)`` would round the digits that x prints as: 567 of 2,000 print as 28.349999999999998.
    """
    return F.when(total > 0, F.round(part / total * 100 * 10) / 10).otherwise(F.lit(0.0))


# --- measures over history ---------------------------------------------------------


def observed(ticks: DataFrame, span_rows: int | None = None) -> Ordered:
    """Observation rows laid out for the measures below."""
    return arrange(ticks, RUN, TICK, span_rows)


def add_copied_bytes(looks: Ordered) -> Ordered:
    """``copied_bytes, estimate_mode``: never below the largest value seen while copying.

    Needs ``raw_copied_bytes, raw_mode, copy_phase``.
    """
    raw, seen = F.col("raw_copied_bytes"), F.coalesce(F.col("_seen"), F.lit(0))
    held = F.coalesce(F.col("copy_phase") == fixed.COPY_RUNNING, F.lit(False)) & (raw < seen)
    mode = F.col("raw_mode")
    kept = F.when(held & (mode == fixed.MODE_SIZES), fixed.MODE_SIZES_HELD)
    high = running_max(looks, {"_seen": raw}, before=True).add(
        {
            "copied_bytes": F.when(held, seen).otherwise(raw),
            "estimate_mode": kept.otherwise(mode),
        }
    )
    return high.having(high.rows.drop("_seen"))


def add_history_measures(looks: Ordered, which: set[str] | None = None) -> Ordered:
    """Measures that look back a fixed number of points, all over one sorted window.

    ``which`` names some of ``advanced``, ``trend``, ``throughput``; all when not given.
    Needs ``tables_completed, copied_bytes, last_good_us, rows_changed, total_bytes``.
    """
    which = which or {"advanced", "trend", "throughput"}
    back, columns = 0, set()
    if "advanced" in which:
        back = max(back, 1)
        columns |= {"tables_completed", "copied_bytes", "last_good_us"}
    if "trend" in which:
        back = max(back, fixed.TREND_POINTS - 1)
        columns |= {"rows_changed"}
    if "throughput" in which:
        back = max(back, fixed.THROUGHPUT_POINTS - 1)
        columns |= {"copied_bytes", "obs_us"}
    wide = look_back(looks, back, sorted(columns))
    order = wide.window
    added: dict[str, Column] = {}
    if "advanced" in which:
        added |= _advanced(order)
    if "trend" in which:
        for k in range(1, fixed.TREND_POINTS):
            added[f"_p{k}"] = F.lag("rows_changed", k).over(order)
    if "throughput" in which:
        added |= _ends(order)
    wide = looked_back(wide.add(added))
    if "trend" in which:
        before = [f"_p{k}" for k in range(1, fixed.TREND_POINTS)]
        wide = wide.add({"backlog_trend": _trend(["rows_changed", *before])})
        wide = wide.having(wide.rows.drop(*before))
    if "throughput" in which:
        wide = _add_throughput(wide)
    return wide


def _advanced(order: WindowSpec) -> dict[str, Column]:
    """More tables, more bytes, or another last good sync than at the point before."""
    has_before = F.lag(F.lit(True)).over(order).isNotNull()

    def before(name: str) -> Column:
        return F.lag(name).over(order)

    rose = [
        F.col(name) > F.coalesce(before(name), F.lit(0))
        for name in ("tables_completed", "copied_bytes")
    ]
    good = ~F.col("last_good_us").eqNullSafe(before("last_good_us"))
    moved = F.coalesce(has_before & (rose[0] | rose[1] | good), F.lit(False))
    return {"advanced": moved, "_opening": ~has_before}


def _trend(names: list[str]) -> Column:
    """growing, shrinking, stable or unknown; ``names`` run from the newest point back."""
    points = F.lit(0)
    rises, falls = F.lit(False), F.lit(False)
    for i, name in enumerate(names):
        point = F.col(name)
        points = points + point.isNotNull().cast("int")
        if i + 1 < len(names):
            earlier = F.coalesce(*names[i + 1 :])
            rises = rises | F.coalesce(point > earlier, F.lit(False))
            falls = falls | F.coalesce(point < earlier, F.lit(False))
    return (
        F.when(points < 3, fixed.TREND_UNKNOWN)
        .when(rises & ~falls, fixed.TREND_GROWING)
        .when(falls & ~rises, fixed.TREND_SHRINKING)
        .otherwise(fixed.TREND_STABLE)
    )


def _ends(order: WindowSpec) -> dict[str, Column]:
    """The oldest of the last points: a fixed way back, or the first point of the run."""
    back = fixed.THROUGHPUT_POINTS - 1
    growing = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return {
        f"_{name}0": F.coalesce(F.lag(name, back).over(order), F.first(name).over(growing))
        for name in ("copied_bytes", "obs_us")
    }


def _add_throughput(looks: Ordered) -> Ordered:
    """``bytes_per_min, mb_per_min, eta_min_minutes, eta_max_minutes``; null when unknown."""
    gained = F.col("copied_bytes") - F.col("_copied_bytes0")
    took = whole_seconds(F.col("obs_us")) - whole_seconds(F.col("_obs_us0"))
    ends = looks.add({"_gained": gained, "_took": took})
    usable = (F.col("total_bytes") > 0) & (F.col("_gained") > 0) & (F.col("_took") > 0)
    rate = F.col("_gained") / F.col("_took") * 60
    rated = ends.add({"_rate": F.when(usable, rate)})
    left = F.greatest(F.col("total_bytes") - F.col("copied_bytes"), F.lit(0))
    eta = left / F.col("_rate")
    told = rated.add(
        {
            "bytes_per_min": F.round("_rate").cast("bigint"),
            "mb_per_min": F.round(F.col("_rate") / 1024 / 1024, 2),
            "eta_min_minutes": F.round(eta * fixed.ETA_LOW).cast("bigint"),
            "eta_max_minutes": F.round(eta * fixed.ETA_HIGH).cast("bigint"),
        }
    )
    return told.having(told.rows.drop("_gained", "_took", "_rate", "_copied_bytes0", "_obs_us0"))


def add_last_progress(looks: Ordered) -> Ordered:
    """``last_progress_us``: time of the latest point that advanced, else of the first point.

    Needs ``advanced`` with its helper column.
    """
    at = F.when(F.col("advanced") | F.col("_opening"), F.col("obs_us"))
    marked = running_last(looks.settled(), "last_progress_us", at)
    return marked.having(marked.rows.drop("_opening"))


def add_stall(df: DataFrame) -> DataFrame:
    """``no_progress_minutes`` to one decimal and ``stalled``; needs ``last_progress_us``.

    Tenths come from whole seconds, so every engine rounds alike (stalled from 597 s).
    """
    seconds = age_seconds(F.col("obs_us"), F.col("last_progress_us"))
    minutes = F.floor((seconds + 3) / 6) / 10
    live = F.col("phase").isin(fixed.LIVE_PHASES)
    return df.withColumn("no_progress_minutes", minutes).withColumn(
        "stalled", live & (F.col("no_progress_minutes") >= fixed.STALL_MINUTES)
    )


def add_replication_delay(df: DataFrame) -> DataFrame:
    """``seconds_since_last_good`` and ``delayed`` when that is more than a minute."""
    return df.withColumn(
        "seconds_since_last_good", age_seconds(F.col("obs_us"), F.col("last_good_us"))
    ).withColumn(
        "delayed",
        F.coalesce(F.col("seconds_since_last_good") > fixed.DELAY_NOTE_SECONDS, F.lit(False)),
    )


# --- the measures one by one -------------------------------------------------------


def monotonic_progress(ticks: DataFrame, span_rows: int | None = None) -> DataFrame:
    rows = add_copied_bytes(observed(ticks, span_rows)).done()
    return rows.withColumn("percent", percent(F.col("copied_bytes"), F.col("total_bytes")))


def history_retention(ticks: DataFrame, points: int = fixed.HISTORY_POINTS) -> DataFrame:
    return latest_rows(ticks, RUN, TICK, points)


def last_progress(ticks: DataFrame, span_rows: int | None = None) -> DataFrame:
    looks = add_copied_bytes(observed(ticks, span_rows))
    return add_last_progress(add_history_measures(looks, {"advanced"})).done()


def backlog_trend(ticks: DataFrame, span_rows: int | None = None) -> DataFrame:
    return add_history_measures(observed(ticks, span_rows), {"trend"}).done()


def throughput_eta(ticks: DataFrame, span_rows: int | None = None) -> DataFrame:
    looks = add_copied_bytes(observed(ticks, span_rows))
    return add_history_measures(looks, {"throughput"}).done()


def stall_detection(ticks: DataFrame, span_rows: int | None = None) -> DataFrame:
    return add_stall(last_progress(ticks, span_rows))


def replication_delay(ticks: DataFrame) -> DataFrame:
    return add_replication_delay(ticks)


def progress_signals(ticks: DataFrame, span_rows: int | None = None) -> DataFrame:
    """All measures at once; over whole runs one shuffle and one sort serve them all."""
    looks = add_history_measures(add_copied_bytes(observed(ticks, span_rows)))
    rows = add_last_progress(looks).done()
    return add_replication_delay(add_stall(rows)).withColumn(
        "percent", percent(F.col("copied_bytes"), F.col("total_bytes"))
    )
