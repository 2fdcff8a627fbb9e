"""Replication health, cutover readiness and the full status record.

Rules are columns over one observation row (``phase, status_seen, state, copy_phase,
last_good_us, last_error`` and the time of the look), so they add no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate import fixed
from relocate.functions.text import strip
from relocate.operators.parse import DONE, completed_of, current_of, fold_log
from relocate.operators.progress import (
    age_seconds,
    copy_progress,
    progress_signals,
)
from relocate.session import settle

def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def status_seen() -> Column:
    return _sure(F.col("status_seen"))


def recent_good_sync(now: str = "obs_us") -> Column:
    """The last good sync is at most two minutes old; one in the future is recent."""
    return _sure(age_seconds(F.col(now), F.col("last_good_us")) <= fixed.RECENT_SYNC_SECONDS)


def replication_healthy(now: str = "obs_us") -> Column:
    """A known good state or a recent good sync, and no error that a recent sync did not outlive."""
    recent = recent_good_sync(now)
    known = _sure(F.col("state").isin(fixed.STATE_NAMES["Good"], fixed.STATE_APPLYING))
    failed = _sure(strip(F.col("last_error")) != "")
    return status_seen() & (known | recent) & (~failed | recent)


def health_state(now: str = "obs_us") -> Column:
    healthy = replication_healthy(now)
    return (
        F.when(healthy & recent_good_sync(now), fixed.HEALTHY)
        .when(healthy, fixed.DEGRADED)
        .otherwise(fixed.BLOCKED)
    )


def add_readiness(df: DataFrame, now: str = "obs_us") -> DataFrame:
    """``readiness, can_force, hard_blockers, soft_blockers``."""
    judged = _sure(F.col("phase").isin("copying", "replicating"))
    unfinished = ~F.col("copy_phase").eqNullSafe(F.lit(fixed.COPY_DONE))
    hard = F.array_compact(
        F.array(
            F.when(judged & ~status_seen(), fixed.STATUS_UNAVAILABLE),
            F.when(judged & status_seen() & unfinished, fixed.COPY_NOT_FINISHED),
        )
    )
    soft = F.array_compact(
        F.array(F.when(judged & status_seen() & ~replication_healthy(now), fixed.NOT_HEALTHY))
    )
    level = (
        F.when(~_sure(F.col("phase").isin(fixed.PHASES_WITH_READINESS)), fixed.NOT_READY)
        .when(F.size("hard_blockers") > 0, fixed.BLOCKED)
        .when(F.size("soft_blockers") > 0, fixed.WARNING)
        .otherwise(fixed.READY)
    )
    return (
        df.withColumn("hard_blockers", hard)
        .withColumn("soft_blockers", soft)
        .withColumn("readiness", level)
        .withColumn("can_force", F.col("readiness").isin(fixed.WARNING, fixed.READY))
    )


def cutover_readiness(df: DataFrame, now: str = "obs_us") -> DataFrame:
    return add_readiness(df, now)


def replication_health(df: DataFrame, now: str = "obs_us") -> DataFrame:
    """``recent_good, replication_ok, health, blocker`` and the readiness columns."""
    judged = (
        add_readiness(df, now)
        .withColumn("recent_good", recent_good_sync(now))
        .withColumn("replication_ok", replication_healthy(now))
        .withColumn("health", health_state(now))
    )
    blocker = F.coalesce(
        F.try_element_at("hard_blockers", F.lit(1)),
        F.when(F.col("health") == fixed.BLOCKED, fixed.NOT_HEALTHY),
    )
    return judged.withColumn("blocker", blocker)


def auto_transition(observations: DataFrame, now: str = "obs_us") -> DataFrame:
    """``next_phase, next_state`` from what a sync reports; null state means nothing to say.

    Needs ``phase`` (local), ``persisted_phase`` and the status columns.
    """
    seen = F.coalesce(F.col("status_seen"), F.lit(False))
    copy = F.col("copy_phase")
    beyond = F.coalesce(F.col("phase").isin(fixed.PHASES_AFTER_COPY), F.lit(False)) | F.coalesce(
        F.col("persisted_phase").isin(fixed.PHASES_AFTER_COPY), F.lit(False)
    )
    copy_began = (
        seen
        & F.col("phase").isin(fixed.PHASES_BEFORE_COPY)
        & (copy == fixed.COPY_RUNNING)
        & ~F.col("state").eqNullSafe(F.lit(fixed.STATE_NOT_STARTED))
        & ~beyond
    )
    in_copy = F.coalesce(copy_began | (seen & (F.col("phase") == "copying")), F.lit(False))
    finished = in_copy & F.coalesce(copy == fixed.COPY_DONE, F.lit(False))
    healthy = replication_healthy(now)
    next_phase = (
        F.when(finished & healthy, "replicating")
        .when(in_copy, "copying")
        .otherwise(F.col("phase"))
    )
    next_state = (
        F.when(finished & healthy, fixed.STATE_RUNNING)
        .when(finished, fixed.STATE_CHECK_FAILED)
        .when(in_copy & (copy == fixed.UNKNOWN), fixed.STATE_AMBIGUOUS)
        .when(F.coalesce(copy_began, F.lit(False)), fixed.STATE_INITIAL_COPY)
    )
    return observations.withColumns({"next_phase": next_phase, "next_state": next_state})


def checklist() -> Column:
    """Five steps as ``array<struct<id, status>>``; needs ``phase, copy_phase, health``."""
    phase = F.col("phase")
    schema_done = _sure(phase.isin(fixed.PHASES_AFTER_SCHEMA))
    copy_done = _sure(phase.isin(fixed.PHASES_AFTER_COPY))
    copying = _sure(F.col("copy_phase") == fixed.COPY_RUNNING)
    copied = _sure(F.col("copy_phase") == fixed.COPY_DONE) | copy_done
    healthy = F.col("health") == fixed.HEALTHY
    complete = F.lit(fixed.STEP_COMPLETE)
    current = F.lit(fixed.STEP_CURRENT)
    pending = F.lit(fixed.STEP_PENDING)
    statuses = [
        F.when(schema_done, complete).otherwise(pending),
        F.when(schema_done, complete).otherwise(pending),
        F.when(copying, current).when(copy_done, complete).otherwise(pending),
        F.when(copied, complete).otherwise(pending),
        F.when(healthy, complete).when(copy_done, current).otherwise(pending),
    ]
    return F.array(
        *[
            F.struct(F.lit(step).alias("id"), status.alias("status"))
            for step, status in zip(fixed.STEPS, statuses, strict=True)
        ]
    )


def observe(
    status: DataFrame, sizes: DataFrame, completed: DataFrame, lines: DataFrame
) -> DataFrame:
    """One look at each run, ready to be appended to its history.

    ``status``: one parsed status row per run; ``sizes``: ``run_id, table_name, source_bytes,
    target_bytes``; ``completed``: tables remembered as done; ``lines``: the log. Tables the log
    reports as done count too. Adds the columns the progress measures take in. The log is read
    once; what it mentions, a row per run and table, is written before the two questions to it.
    """
    known = sizes.select("run_id", "table_name")
    folded = settle(fold_log(lines), "mentions")
    done = completed.select("run_id", "table_name").unionByName(
        completed_of(folded, known).select("run_id", "table_name")
    )
    told = status.select("run_id", "tables_in_sync", "copy_phase")
    measured = copy_progress(sizes, done, told).select(
        "run_id",
        "total_tables",
        "tables_completed",
        "total_bytes",
        F.col("copied_bytes").alias("raw_copied_bytes"),
        F.col("estimate_mode").alias("raw_mode"),
    )
    return status.join(measured, "run_id", "left").join(
        current_of(folded.filter(F.col("kind") != DONE), known), "run_id", "left"
    )


def status_record(observations: DataFrame, span_rows: int | None = None) -> DataFrame:
    """One nested status row per look, from parsed status joined with size measures.

    The run is moved on first, and everything is judged in the phase it has then. Needs the
    columns of the progress and health measures plus ``total_tables``. ``persisted_phase``, what
    is stored of the run (``stored_state, stored_error, started_us``) and ``current_table``
    count when present.
    """
    optional = {
        "persisted_phase": "string", "stored_state": "string", "stored_error": "string",
        "started_us": "bigint", "current_table": "string",
    }
    absent = {c: F.lit(None).cast(kind) for c, kind in optional.items() if c not in observations.columns}
    moved = auto_transition(observations.withColumns(absent) if absent else observations)
    moved = moved.withColumn("phase", F.col("next_phase"))
    rows = replication_health(progress_signals(moved, span_rows))
    rows = rows.withColumn("_steps", checklist())
    finished = F.size(F.filter("_steps", lambda s: s["status"] == fixed.STEP_COMPLETE))
    return rows.select(
        "run_id",
        "tick",
        "obs_us",
        "phase",
        F.coalesce("next_state", "stored_state").alias("state"),
        F.col("stored_error").alias("error"),
        "started_us",
        F.struct(
            "status_seen",
            "state",
            "copy_phase",
            "rows_changed",
            "last_good_us",
            "last_error",
        ).alias("status"),
        F.struct(
            F.col("readiness").alias("level"), "can_force", "hard_blockers", "soft_blockers"
        ).alias("cutover_readiness"),
        F.struct(
            F.struct(
                F.col("copy_phase").alias("phase"),
                "current_table",
                "tables_completed",
                "total_tables",
            ).alias("table_phase"),
            F.struct("copied_bytes", "total_bytes", "percent", "estimate_mode").alias(
                "byte_weighted"
            ),
            F.struct(
                "last_good_us",
                "seconds_since_last_good",
                "backlog_trend",
                F.col("health").alias("health_state"),
                F.col("blocker").alias("blocker_reason"),
            ).alias("replication_delay"),
            F.struct(
                "bytes_per_min", "mb_per_min", "eta_min_minutes", "eta_max_minutes"
            ).alias("throughput_eta"),
            F.struct(
                F.col("_steps").alias("steps"),
                finished.cast("bigint").alias("completed"),
                F.lit(len(fixed.STEPS)).cast("bigint").alias("total"),
            ).alias("event_checklist"),
            F.struct("stalled", "no_progress_minutes").alias("stall_detection"),
        ).alias("progress_signals"),
    )


def status_document(records: DataFrame) -> DataFrame:
    """``run_id, tick, document``: each record as one JSON text, null fields included."""
    whole = F.struct(*[F.col(c) for c in records.columns])
    return records.select("run_id", "tick", F.to_json(whole, {"ignoreNullFields": "false"}).alias("document"))


def status_variant(documents: DataFrame) -> DataFrame:
    """``document`` as VARIANT: fields are read by path, whatever version of the record wrote them.

    A text that is no JSON becomes null.
    """
    return documents.withColumn("document", F.try_parse_json("document"))
