"""Apply an ordered change log to a table; split off what a write fence blocks.

A change row holds the key columns, ``seq`` (unique and rising per key), ``op`` (``I``,
``U`` or ``D``) and the full row image. An insert on an existing key replaces the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relocate.operators.ordered import arrange, running_sum
from relocate.session import settle

DELETE = "D"


def latest_changes(
    changes: DataFrame, keys: list[str], payload: list[str], seq: str = "seq", op: str = "op"
) -> DataFrame:
    """The last change of each key.

    An aggregate, so each task first folds its own rows: a key that holds a third of the log
    reaches the shuffle as one row per task.
    """
    image = F.struct(F.col(seq), F.col(op), *[F.col(c) for c in payload])
    return (
        changes.groupBy(*keys)
        .agg(F.max_by(image, F.col(seq)).alias("_last"))
        .select(*keys, F.col(f"_last.{seq}"), F.col(f"_last.{op}"), *[f"_last.{c}" for c in payload])
    )


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    payload: list[str],
    seq: str = "seq",
    op: str = "op",
    settle_changes: bool = False,
) -> DataFrame:
    """The target after all changes: target and log are each read once and meet in one join.

    A null key is a key like any other. With ``settle_changes`` the folded log is written first;
    Spark then knows its true size, and when it is small broadcasts it instead of shuffling the
    target. Use it when the target is far larger than the log.
    """
    last = latest_changes(changes, keys, payload, seq, op)
    old = target.select(*keys, *payload).alias("old")
    if settle_changes:
        new = settle(last).alias("new")
        kept = old.join(new, _same_keys(keys), "left_anti")
        return kept.unionByName(new.filter(F.col(op) != DELETE).select(*keys, *payload))
    new = last.alias("new")
    touched = F.col(f"new.{op}").isNotNull()
    columns = [
        F.when(touched, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
        for c in [*keys, *payload]
    ]
    gone = F.coalesce(F.col(f"new.{op}") == DELETE, F.lit(False))
    return old.join(new, _same_keys(keys), "full_outer").filter(~gone).select(*columns)


def _same_keys(keys: list[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}"))
    return same


def apply_counts(
    target: DataFrame, changes: DataFrame, keys: list[str], seq: str = "seq", op: str = "op"
) -> DataFrame:
    """What applying does to the target: keys changed, rows removed or replaced, rows written."""
    last = changes.groupBy(*keys).agg(F.max_by(op, seq).alias(op))
    held = target.select(*keys).withColumn("_held", F.lit(True))
    wrote = F.col(op) != DELETE
    return last.alias("old").join(held.alias("new"), _same_keys(keys), "left").agg(
        F.count(F.lit(1)).alias("keys_changed"),
        F.count_if(F.col("_held")).alias("rows_deleted"),
        F.count_if(wrote).alias("rows_inserted"),
        F.count_if(wrote & F.col("_held").isNull()).alias("rows_new"),
    )


def resume_from_snapshot(
    snapshot: DataFrame,
    changes: DataFrame,
    snapshot_seq: int | Column,
    keys: list[str],
    payload: list[str],
    seq: str = "seq",
    op: str = "op",
) -> DataFrame:
    """Go on without a new copy: the snapshot already holds all changes up to ``snapshot_seq``."""
    bound = snapshot_seq if isinstance(snapshot_seq, Column) else F.lit(snapshot_seq)
    return apply_changes(snapshot, changes.filter(F.col(seq) > bound), keys, payload, seq, op)


#: Positions that one folder of a stored log spans.
LOG_SPAN = 10_000_000
_SPAN = "_span"


def write_log(changes: DataFrame, path: str, span: int = LOG_SPAN, seq: str = "seq") -> None:
    """Append changes to a log that is clustered by position: a folder per span, sorted within.

    Tasks get equal shares by ranges of ``seq``, however uneven the spans are filled.
    """
    placed = changes.withColumn(_SPAN, F.floor(F.col(seq) / span).cast("bigint"))
    in_order = placed.repartitionByRange(seq).sortWithinPartitions(_SPAN, seq)
    in_order.write.mode("append").partitionBy(_SPAN).parquet(path)


def read_log_after(
    spark: SparkSession, path: str, position: int, span: int = LOG_SPAN, seq: str = "seq"
) -> DataFrame:
    """The changes after ``position``. Folders before it are not opened, and in the one that holds
    it only the row groups that reach beyond."""
    tail = (F.col(_SPAN) >= position // span) & (F.col(seq) > position)
    return spark.read.parquet(path).filter(tail).drop(_SPAN)


def overlay(base: DataFrame, last: DataFrame, keys: list[str]) -> DataFrame:
    """Of two states with one row per key, the row with the larger ``seq``; ties go to ``base``.

    Both joins test ``base`` against ``last``, so while ``last`` is small Spark broadcasts it
    and the base is read in place, never shuffled.
    """
    old, new = base.alias("old"), last.alias("new")
    same, newer = _same_keys(keys), F.col("new.seq") > F.col("old.seq")
    kept = old.join(new, same & newer, "left_anti")
    late = old.join(new, same & ~newer).select(*[F.col(f"old.{k}").alias(k) for k in keys])
    fresh = last.alias("new").join(late.alias("old"), same, "left_anti")
    return kept.unionByName(fresh)


def merge_versions(
    state: DataFrame, changes: DataFrame, keys: list[str], payload: list[str]
) -> DataFrame:
    """Fold changes into a state that remembers ``seq`` and ``op`` of each key's last change.

    Deleted keys stay as tombstones, so a repeated or late change (``seq`` not above the one
    held) changes nothing, whatever order batches arrive in.
    """
    return overlay(state, latest_changes(changes, keys, payload), keys)


def live_rows(state: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    return state.filter(F.col("op") != DELETE).select(*keys, *payload)


def pending_backlog(changes: DataFrame, applied: DataFrame, group: list[str]) -> DataFrame:
    """Queue depth per group: changes after ``applied.last_seq``; groups never applied wait whole.

    ``applied`` has one row per group; Spark broadcasts it when it is small and otherwise
    splits a hot group's side of the join. Only counts are shuffled after that.
    """
    queue = changes.join(applied, group, "left").filter(
        F.col("seq") > F.coalesce(F.col("last_seq"), F.lit(-1))
    )
    return queue.groupBy(*group).agg(
        F.count(F.lit(1)).alias("pending"),
        F.count_if(F.col("op") == DELETE).alias("pending_deletes"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
    )


# --- write fence -------------------------------------------------------------------


def write_fence_split(
    changes: DataFrame,
    fences: DataFrame,
    run: str = "run_id",
    at: str = "commit_us",
    span_rows: int | None = None,
) -> DataFrame:
    """All changes with ``quarantined``: committed while the run's writes were fenced off.

    ``fences`` has ``from_us`` (inside) and ``to_us`` (outside, null while still up). A sweep: edges of
    fences and changes lie in one order per run, and a running count tells how many fences are up at
    a change, however many, long or overlapping they are. The log is read once. ``span_rows`` cuts
    runs of very many changes into spans. A change without a time is not quarantined.
    """
    up = fences.filter(F.col("to_us").isNull() | (F.col("from_us") < F.col("to_us")))

    def edge(time: str, step: int) -> DataFrame:
        return up.filter(F.col(time).isNotNull()).select(run, (F.col(time) * 2).alias("_time"), F.lit(step).alias("_edge"))

    # Edges come before changes of the same time.
    edges = edge("from_us", 1).unionByName(edge("to_us", -1))
    timed = changes.withColumns({"_time": F.col(at) * 2 + 1, "_edge": F.lit(0)})
    both = timed.unionByName(edges, allowMissingColumns=True)
    swept = running_sum(arrange(both, [run], "_time", span_rows), "_up", F.col("_edge")).done()
    fenced = F.col("_time").isNotNull() & (F.coalesce(F.col("_up"), F.lit(0)) > 0)
    return swept.filter("_edge = 0").withColumn("quarantined", fenced).select(*changes.columns, "quarantined")


def cleanup_residue(
    databases: DataFrame, triggers: DataFrame, schemas: DataFrame, prefix: str, schema: str
) -> DataFrame:
    """Leftovers of a torn-down sync per database; both counts must be 0.

    ``prefix`` goes into a LIKE pattern as it is, so ``_`` in it stands for any character.
    """
    left_triggers = (
        triggers.filter(F.col("trigger_name").like(prefix + "%"))
        .groupBy("db_id")
        .agg(F.count(F.lit(1)).alias("triggers_left"))
    )
    left_schemas = (
        schemas.filter(F.col("schema_name") == schema)
        .groupBy("db_id")
        .agg(F.count(F.lit(1)).alias("schemas_left"))
    )
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("triggers_left", "schemas_left")]
    return (
        databases.join(left_triggers, "db_id", "left")
        .join(left_schemas, "db_id", "left")
        .select("db_id", *counts)
        .withColumn("clean", (F.col("triggers_left") == 0) & (F.col("schemas_left") == 0))
    )
