"""Migration phases: persisted state, automatic moves, guards, milestones, the switch gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate import fixed
from relocate.operators.health import auto_transition
from relocate.operators.ordered import arrange, look_back, looked_back

STATE_FIELDS = ["phase", "switched_us", "completed_us", "error"]


def state_upsert(writes: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """One row per run after an ordered log of phase writes.

    ``writes``: ``run_id, seq, at_us, phase`` and, where given, ``started_us, switched_us,
    completed_us, error``. The first write fixes ``started_us``; the last write sets all
    else, so a ``switched_us`` it does not give is lost. ``state`` is an earlier result.
    """
    start = F.coalesce(F.col("started_us"), F.col("at_us"))
    folded = writes.select(
        "run_id",
        "seq",
        F.col("seq").alias("first_seq"),
        start.alias("started_us"),
        F.col("at_us").alias("updated_us"),
        "phase",
        "switched_us",
        "completed_us",
        F.coalesce("error", F.lit("")).alias("error"),
    )
    if state is not None:
        folded = folded.unionByName(state)
    last = F.struct("seq", "updated_us", *STATE_FIELDS)
    return (
        folded.groupBy("run_id")
        .agg(
            F.min("first_seq").alias("first_seq"),
            F.min_by("started_us", "first_seq").alias("started_us"),
            F.max_by(last, "seq").alias("_last"),
        )
        .select("run_id", "first_seq", "started_us", "_last.*")
    )


__all__ = [
    "action_allowed", "action_guard", "auto_transition", "milestones", "state_upsert", "switch_gate",
    "with_previous",
]


def action_allowed(action: Column, phase: Column) -> Column:
    """Whether a phase accepts an action; pause, resume, revert and cleanup always pass."""
    chain = F
    for name, phases in fixed.ACTION_PHASES.items():
        chain = chain.when(action == name, F.coalesce(phase.isin(phases), F.lit(False)))
    return chain.otherwise(F.lit(True))


def action_guard(
    actions: DataFrame, gate: DataFrame | None = None, run: str = "run_id"
) -> DataFrame:
    """Add ``accepted`` to rows with ``action, phase``.

    With ``gate`` (``db_id, all_tables_valid``, the preflight verdict), a start also needs a
    verdict for the run's database that lets it pass.
    """
    allowed = action_allowed(F.col("action"), F.col("phase"))
    if gate is None:
        return actions.withColumn("accepted", allowed)
    verdict = gate.select(F.col("db_id").alias("_db"), F.col("all_tables_valid").alias("_valid"))
    passed = (F.col("action") != fixed.ACTION_START) | F.coalesce("_valid", F.lit(False))
    judged = actions.join(verdict, F.col(run) == F.col("_db"), "left")
    return judged.withColumn("accepted", allowed & passed).drop("_db", "_valid")


def with_previous(
    log: DataFrame, columns: dict[str, str], span_rows: int | None = None
) -> DataFrame:
    """Add columns of the row before, per run by ``seq``: ``columns`` maps new name to column."""
    wide = look_back(
        arrange(log, ["run_id"], "seq", span_rows), 1, sorted(set(columns.values()))
    )
    added = {new: F.lag(old).over(wide.window) for new, old in columns.items()}
    return looked_back(wide.add(added)).done()


def milestones(
    log: DataFrame,
    span_rows: int | None = None,
    max_chars: int | None = fixed.MILESTONE_CHARS,
) -> DataFrame:
    """Phase changes worth telling: ``run_id, seq, at_us, milestone, detail``.

    A row tells only when its phase differs from the row before; ``starting`` only as the
    first row of its run. ``detail`` is the error text, cut to ``max_chars`` unless None;
    ``Unknown error`` without one. ``ready_to_copy`` tells the number of tables where the log
    has ``tables_in_sync``.
    """
    return milestones_of(with_previous(log, {"_before": "phase"}, span_rows), max_chars)


def milestones_of(prior: DataFrame, max_chars: int | None = fixed.MILESTONE_CHARS) -> DataFrame:
    """The milestones of rows that bring the phase of the row before along as ``_before``."""
    changed = ~F.col("phase").eqNullSafe(F.col("_before"))
    told = F.col("phase").isin(fixed.MILESTONE_PHASES) & (
        (F.col("phase") != "starting") | F.col("_before").isNull()
    )
    text = F.when(F.trim("error") != "", F.col("error"))
    text = F.coalesce(text if max_chars is None else F.substring(text, 1, max_chars), F.lit(fixed.NO_ERROR_TEXT))
    detail = F.when(F.col("phase") == "error", text)
    if "tables_in_sync" in prior.columns:
        tables = F.concat(F.col("tables_in_sync").cast("string"), F.lit(" tables"))
        detail = detail.when(F.col("phase") == "ready_to_copy", tables)
    return prior.filter(changed & told).select(
        "run_id", "seq", "at_us", F.col("phase").alias("milestone"), detail.alias("detail")
    )


def switch_gate(requests: DataFrame) -> DataFrame:
    """``decision, http_status`` of switch requests with ``phase, readiness, force``.

    ``force`` is the request's text; 1, true and yes override warnings, never blockers.
    """
    forced = F.coalesce(F.lower("force").isin(fixed.FORCE_VALUES), F.lit(False))
    decision = (
        F.when(~F.col("phase").eqNullSafe(F.lit("replicating")), fixed.SWITCH_WRONG_PHASE)
        .when(F.col("readiness") == fixed.BLOCKED, fixed.SWITCH_BLOCKED)
        .when((F.col("readiness") == fixed.WARNING) & ~forced, fixed.SWITCH_NEEDS_OVERRIDE)
        .otherwise(fixed.SWITCH_ALLOWED)
    )
    status = F.when(F.col("decision") == fixed.SWITCH_ALLOWED, fixed.HTTP_OK).otherwise(
        fixed.HTTP_CONFLICT
    ).cast("bigint")
    return requests.withColumn("decision", decision).withColumn("http_status", status)
