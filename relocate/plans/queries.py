"""The registered queries: every operator over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relocate.functions import text as tx
from relocate.functions.hashing import hex_number, row_text
from relocate.operators import (
    cdc,
    copy,
    digests,
    health,
    lifecycle,
    parse,
    preflight,
    progress,
    reconcile,
    sizing,
)
from relocate.plans.inputs import CANDIDATES, RESIDUE_PREFIX, broken_text, status_text, table, view
from relocate.session import configure, fresh_path, settle
from relocate.sources import paths
from relocate.sources.documents import read_document_texts, write_document_texts
from relocate.sources.snapshot import (
    read_snapshot,
    snapshot_copy as copy_tables,
    snapshot_position,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = ["c_custkey"]
PAYLOAD = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def query(work: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return work(configure(spark), sf_dir)

    QUERIES[work.__name__] = run
    return run


# --- move --------------------------------------------------------------------------


@query
def scan_source(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet")
    return (
        rows.filter((F.col("l_quantity") >= 25) & (F.col("l_returnflag") == "R"))
        .groupBy("l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("price_cents"),
        )
    )


GROUP = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@query
def snapshot_copy(spark, sf):
    root = fresh_path(spark, "snapshot")
    copy_tables(spark, {name: table(spark, sf, name) for name in GROUP}, root)
    parts = []
    for name, rows in read_snapshot(spark, root).items():
        image = hex_number(F.md5(row_text(rows, sorted(rows.columns))), 1, 8)
        parts.append(
            rows.select(image.alias("_i"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("_i").cast("string").alias("fingerprint"))
            .select(F.lit(name).alias("table_name"), "*")
        )
    told = settle(preflight.union_all(parts), "copied")
    paths.delete(spark, root)
    return told


@query
def generated_recompute(spark, sf):
    declared = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount"
    ).withColumns({"net_cents": F.lit(0).cast("bigint"), "l_code": F.lit("")})
    return copy.copy_with_generated(
        declared,
        {
            "net_cents": "cast(round(l_extendedprice * 100) as bigint)"
            " * (100 - cast(round(l_discount * 100) as bigint))",
            "l_code": "concat(l_orderkey, '-', l_linenumber)",
        },
    ).drop("l_extendedprice", "l_discount")


@query
def copy_column_list(spark, sf):
    return copy.copy_column_list(view(spark, sf, "cat_columns"))


@query
def cdc_apply(spark, sf):
    return cdc.apply_changes(
        view(spark, sf, "snapshot"), view(spark, sf, "changes"), KEY, PAYLOAD
    )


@query
def cdc_apply_counts(spark, sf):
    return cdc.apply_counts(view(spark, sf, "snapshot"), view(spark, sf, "changes"), KEY)


@query
def sequence_high_water(spark, sf):
    source = {
        "customer": (table(spark, sf, "customer"), "c_custkey"),
        "orders": (table(spark, sf, "orders"), "o_orderkey"),
        "events": (table(spark, sf, "events"), "event_id"),
    }
    target = {
        "customer": (view(spark, sf, "snapshot"), "c_custkey"),
        "orders": (view(spark, sf, "orders_target"), "o_orderkey"),
    }
    return copy.sequence_high_water(source, target)


@query
def cdc_resume_from_snapshot(spark, sf):
    changes, start = view(spark, sf, "changes"), view(spark, sf, "snapshot")
    half = table(spark, sf, "events").agg(F.floor(F.max("event_id") / 2).cast("bigint")).first()[0]
    held = cdc.apply_changes(start, changes.filter(F.col("seq") <= half), KEY, PAYLOAD)
    root = fresh_path(spark, "snapshot")
    copy_tables(spark, {"customer": held}, root, position=half)
    copied, position = read_snapshot(spark, root)["customer"], snapshot_position(spark, root)
    return cdc.resume_from_snapshot(copied, changes, position, KEY, PAYLOAD)


@query
def cdc_resume_from_log(spark, sf):
    """The same from a log stored by position: only what lies after the snapshot is read."""
    changes, start = view(spark, sf, "changes"), view(spark, sf, "snapshot")
    half = table(spark, sf, "events").agg(F.floor(F.max("event_id") / 2).cast("bigint")).first()[0]
    root, span = fresh_path(spark, "log"), max(half // 8, 1)
    cdc.write_log(changes, root, span)
    whole = cdc.read_log_after(spark, root, -1, span)
    held = cdc.apply_changes(start, whole.filter(F.col("seq") <= half), KEY, PAYLOAD)
    tail = cdc.read_log_after(spark, root, half, span)
    told = settle(cdc.apply_changes(held, tail, KEY, PAYLOAD), "resumed")
    paths.delete(spark, root)
    return told


@query
def pending_backlog(spark, sf):
    return cdc.pending_backlog(
        view(spark, sf, "changes"), view(spark, sf, "applied"), ["run_id"]
    )


@query
def write_fence_split(spark, sf):
    changes = view(spark, sf, "changes").select("run_id", "seq", "commit_us", "c_custkey", "op")
    return cdc.write_fence_split(changes, view(spark, sf, "fences"))


@query
def cleanup_residue(spark, sf):
    return cdc.cleanup_residue(
        view(spark, sf, "databases"),
        view(spark, sf, "triggers"),
        view(spark, sf, "db_schemas"),
        RESIDUE_PREFIX,
        "audit",
    )


# --- preflight ---------------------------------------------------------------------


@query
def tables_without_key(spark, sf):
    return preflight.tables_without_key(
        view(spark, sf, "cat_tables"), view(spark, sf, "cat_indexes")
    )


@query
def tables_without_key_public(spark, sf):
    return preflight.tables_without_key(
        view(spark, sf, "cat_tables"), view(spark, sf, "cat_indexes"), public_only=True
    )


@query
def key_violations(spark, sf):
    lineitem = ["l_orderkey", "l_linenumber"]
    return preflight.key_violations(
        {
            "lineitem": (
                table(spark, sf, "lineitem"),
                [lineitem, [*lineitem, "l_partkey", "l_suppkey"]],
            ),
            "orders": (table(spark, sf, "orders"), [["o_orderkey"], ["o_custkey"]]),
            "conversations": (table(spark, sf, "conversations"), [["conv_id", "turn"]]),
            "documents": (table(spark, sf, "documents"), [["doc_id"]]),
        }
    )


@query
def candidate_keys(spark, sf):
    """Many candidates at once: sketches in one scan of each table, exact counts for the likely ones."""
    return preflight.candidate_keys(
        {
            "lineitem": (table(spark, sf, "lineitem"), [k.split(",") for k in CANDIDATES["lineitem"]]),
            "orders": (table(spark, sf, "orders"), [k.split(",") for k in CANDIDATES["orders"]]),
            "events": (table(spark, sf, "events"), [k.split(",") for k in CANDIDATES["events"]]),
        }
    )


@query
def preflight_gate(spark, sf):
    return preflight.preflight_gate(
        view(spark, sf, "cat_tables"),
        view(spark, sf, "cat_indexes"),
        view(spark, sf, "cat_columns"),
    )


@query
def preflight_findings(spark, sf):
    return preflight.preflight_findings(
        view(spark, sf, "cat_tables"),
        view(spark, sf, "cat_indexes"),
        view(spark, sf, "cat_columns"),
    )


@query
def generated_columns(spark, sf):
    return preflight.generated_columns(view(spark, sf, "cat_columns")).withColumn(
        "columns", F.array_join("columns", ",")
    )


@query
def relation_size(spark, sf):
    names = ["customer", "orders", "lineitem", "events", "documents", "embeddings"]
    return preflight.relation_size({n: table(spark, sf, n) for n in names})


@query
def relation_files(spark, sf):
    names = ["customer", "orders", "lineitem", "events", "documents", "embeddings"]
    return preflight.relation_files(spark, {n: f"{sf}/{n}.parquet" for n in names})


@query
def object_diff(spark, sf):
    return preflight.object_diff(
        view(spark, sf, "objects_source"),
        view(spark, sf, "objects_target"),
        ["db_id", "kind", "schema_name", "name"],
    )


@query
def invalid_encoding(spark, sf):
    return preflight.invalid_encoding(
        {
            "documents": (broken_text(table(spark, sf, "documents")), "doc_id", ["text"]),
            "pages": (table(spark, sf, "pages"), "page_id", ["url", "html"]),
        }
    )


@query
def normalize_names(spark, sf):
    return view(spark, sf, "raw_names").select(
        "row_id", tx.normalize_table_name(F.col("raw_name")).alias("table_name")
    )


# --- parse -------------------------------------------------------------------------


def _parsed(spark, sf, odd=False):
    return parse.parse_status(status_text(view(spark, sf, "ticks"), odd))


@query
def parse_status(spark, sf):
    return _parsed(spark, sf, odd=True).select(
        "run_id", "tick", "status_seen", "active", "state_raw", "state", "copy_phase_raw",
        "copy_phase", "rows_deleted", "rows_inserted", "rows_changed", "last_good_us",
        "last_error", "tables_in_sync",
    )


@query
def normalize_state(spark, sf):
    return view(spark, sf, "ticks").select(
        "run_id", "tick", tx.normalize_state(F.col("state_raw")).alias("state")
    )


@query
def rows_changed(spark, sf):
    return (
        status_text(view(spark, sf, "ticks"), odd=True)
        .select("run_id", "tick", parse.rows_changed(F.col("block")).alias("_r"))
        .select("run_id", "tick", "_r.*")
    )


@query
def last_error_clean(spark, sf):
    raw = F.concat(F.lit(" :  "), F.coalesce("last_error", F.lit("")))
    return view(spark, sf, "ticks").select(
        "run_id", "tick", tx.last_error_clean(raw).alias("last_error")
    )


@query
def safe_time(spark, sf):
    at = F.col("ts")
    printed = (
        F.when(F.col("event_id") % 4 == 0, F.date_format(at, "MMM dd, yyyy HH:mm:ss"))
        .when(F.col("event_id") % 4 == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit("at "), F.col("event_type")))
        .otherwise("  ")
    )
    return table(spark, sf, "events").select(
        "event_id", F.unix_seconds(tx.safe_time(printed)).alias("epoch_s")
    )


@query
def log_completed_tables(spark, sf):
    return parse.log_completed_tables(
        view(spark, sf, "log_lines"), view(spark, sf, "known_tables")
    ).select("run_id", "table_name", "pattern_no", "line_no")


@query
def log_current_table(spark, sf):
    return parse.log_current_table(view(spark, sf, "log_lines"), view(spark, sf, "known_tables"))


@query
def log_current_table_fallback(spark, sf):
    return parse.log_current_table(view(spark, sf, "vague_lines"), view(spark, sf, "known_tables"))


@query
def filter_warnings(spark, sf):
    return parse.filter_warnings(view(spark, sf, "log_lines"))


@query
def error_digest(spark, sf):
    return parse.error_digest(view(spark, sf, "log_lines"), 20)


@query
def log_tail(spark, sf):
    return parse.log_tail(view(spark, sf, "log_lines"), 20)


# --- measure -----------------------------------------------------------------------


@query
def tables_completed(spark, sf):
    return progress.tables_completed(
        view(spark, sf, "table_sizes"),
        view(spark, sf, "remembered"),
        view(spark, sf, "run_status"),
    )


@query
def byte_progress(spark, sf):
    return progress.byte_progress(
        view(spark, sf, "table_sizes"),
        view(spark, sf, "remembered"),
        view(spark, sf, "run_status"),
    )


@query
def monotonic_progress(spark, sf):
    return progress.monotonic_progress(view(spark, sf, "ticks")).select(
        "run_id", "tick", "copied_bytes", "estimate_mode", "percent"
    )


@query
def history_retention(spark, sf):
    return progress.history_retention(
        view(spark, sf, "ticks").select("run_id", "tick", "obs_us", "raw_copied_bytes")
    )


@query
def last_progress(spark, sf):
    return progress.last_progress(view(spark, sf, "ticks")).select(
        "run_id", "tick", "advanced", "last_progress_us"
    )


@query
def backlog_trend(spark, sf):
    return progress.backlog_trend(view(spark, sf, "ticks")).select(
        "run_id", "tick", "backlog_trend"
    )


@query
def throughput_eta(spark, sf):
    return progress.throughput_eta(view(spark, sf, "ticks")).select(
        "run_id", "tick", "bytes_per_min", "mb_per_min", "eta_min_minutes", "eta_max_minutes"
    )


@query
def stall_detection(spark, sf):
    return progress.stall_detection(view(spark, sf, "ticks")).select(
        "run_id", "tick", "no_progress_minutes", "stalled"
    )


@query
def replication_delay(spark, sf):
    return progress.replication_delay(view(spark, sf, "ticks")).select(
        "run_id", "tick", "seconds_since_last_good", "delayed"
    )


@query
def progress_signals_split(spark, sf):
    """All measures over spans of some fifty looks, with the rows of whole runs."""
    return progress.progress_signals(view(spark, sf, "ticks"), span_rows=50).select(
        "run_id", "tick", "copied_bytes", "estimate_mode", "percent", "advanced",
        "last_progress_us", "backlog_trend", "bytes_per_min", "no_progress_minutes", "stalled",
    )


@query
def replication_health(spark, sf):
    return health.replication_health(view(spark, sf, "all_looks")).select(
        "run_id", "tick", "recent_good", "replication_ok", "health", "blocker"
    )


@query
def cutover_readiness(spark, sf):
    return health.cutover_readiness(view(spark, sf, "all_looks")).select(
        "run_id",
        "tick",
        "readiness",
        "can_force",
        F.array_join("hard_blockers", ",").alias("hard_blockers"),
        F.array_join("soft_blockers", ",").alias("soft_blockers"),
    )


@query
def observation(spark, sf):
    """Status, sizes, remembered tables and log of each run joined into one look."""
    return health.observe(
        view(spark, sf, "run_status"),
        view(spark, sf, "table_sizes"),
        view(spark, sf, "remembered"),
        view(spark, sf, "log_lines"),
    )


def _records(spark, sf):
    """Records from printed status text. What is stored of a run lags behind or is ahead of it."""
    stored = (
        F.when((F.col("tick") % 5 == 1) & (F.col("phase") == "replicating"), "copying")
        .when(F.col("tick") % 11 == 3, "switched")
        .when(F.col("tick") % 11 == 5, "ready_to_copy")
        .otherwise(F.col("phase"))
    )
    looks = _parsed(spark, sf).withColumns({"phase": stored, "started_us": F.col("tick") * 2})
    return health.status_record(looks)


@query
def status_record(spark, sf):
    """From printed status text to the nested record, flattened for comparison."""
    s = "progress_signals"
    steps = F.col(f"{s}.event_checklist.steps")
    return _records(spark, sf).select(
        "run_id",
        "tick",
        "phase",
        "state",
        "started_us",
        F.col("status.state").alias("reported_state"),
        "status.rows_changed",
        "status.last_error",
        F.col("cutover_readiness.level").alias("readiness"),
        f"{s}.table_phase.tables_completed",
        f"{s}.byte_weighted.copied_bytes",
        f"{s}.byte_weighted.percent",
        f"{s}.byte_weighted.estimate_mode",
        f"{s}.replication_delay.seconds_since_last_good",
        f"{s}.replication_delay.backlog_trend",
        f"{s}.replication_delay.health_state",
        f"{s}.replication_delay.blocker_reason",
        f"{s}.throughput_eta.bytes_per_min",
        f"{s}.stall_detection.stalled",
        f"{s}.event_checklist.completed",
        F.array_join(steps["status"], ",").alias("steps"),
    )


@query
def status_document(spark, sf):
    """Records written as JSON, read back as VARIANT and asked by path; two parts stay JSON texts."""
    root = fresh_path(spark, "documents")
    record = health.status_document(_records(spark, sf))
    write_document_texts(record, root)
    found = health.status_variant(read_document_texts(spark, root))
    signals = "$.progress_signals"

    def at(path: str, kind: str):
        return F.variant_get("document", path, kind)

    told = found.select(
        at("$.run_id", "bigint").alias("run_id"),
        at("$.tick", "bigint").alias("tick"),
        at("$.phase", "string").alias("phase"),
        at("$.state", "string").alias("state"),
        at("$.started_us", "bigint").alias("started_us"),
        at("$.status.state", "string").alias("reported_state"),
        at("$.status.rows_changed", "bigint").alias("rows_changed"),
        at("$.status.last_error", "string").alias("last_error"),
        at("$.cutover_readiness.level", "string").alias("readiness"),
        at(f"{signals}.byte_weighted.percent", "double").alias("percent"),
        at(f"{signals}.replication_delay.blocker_reason", "string").alias("blocker_reason"),
        at(f"{signals}.throughput_eta.bytes_per_min", "bigint").alias("bytes_per_min"),
        at(f"{signals}.stall_detection.stalled", "boolean").alias("stalled"),
        at(f"{signals}.event_checklist.steps[4].status", "string").alias("last_step"),
        F.to_json(at(f"{signals}.byte_weighted", "variant")).alias("byte_weighted"),
    )
    kept = settle(told, "documents")
    paths.delete(spark, root)
    return kept


# --- lifecycle ---------------------------------------------------------------------


@query
def state_upsert(spark, sf):
    return lifecycle.state_upsert(view(spark, sf, "phase_log"))


@query
def auto_transition(spark, sf):
    return lifecycle.auto_transition(view(spark, sf, "moves")).select(
        "run_id", "tick", "next_phase", "next_state"
    )


@query
def action_guard(spark, sf):
    """Actions against the phase the run was in, which is that of the row before."""
    log = lifecycle.with_previous(view(spark, sf, "action_log"), {"_before": "phase"})
    now = log.withColumn("phase", F.coalesce("_before", F.lit("unknown"))).drop("_before")
    gate = preflight.preflight_gate(
        view(spark, sf, "cat_tables"), view(spark, sf, "cat_indexes"), view(spark, sf, "cat_columns")
    )
    judged = lifecycle.action_guard(now, gate)
    return judged.select("run_id", "seq", "action", "phase", "accepted")


@query
def milestones(spark, sf):
    return lifecycle.milestones(view(spark, sf, "phase_log"))


@query
def switch_gate(spark, sf):
    judged = health.cutover_readiness(view(spark, sf, "requests"))
    return lifecycle.switch_gate(judged).select("run_id", "tick", "decision", "http_status")


# --- validate and size -------------------------------------------------------------


@query
def reconcile_counts(spark, sf):
    return reconcile.reconcile_counts(
        {
            "customer": table(spark, sf, "customer"),
            "orders": table(spark, sf, "orders"),
            "lineitem": table(spark, sf, "lineitem"),
        },
        {
            "customer": view(spark, sf, "snapshot"),
            "orders": view(spark, sf, "orders_target"),
            "events": table(spark, sf, "events"),
        },
    )


def _orders(spark, sf):
    return table(spark, sf, "orders"), view(spark, sf, "orders_target")


@query
def reconcile_sample(spark, sf):
    return reconcile.reconcile_sample(*_orders(spark, sf), ["o_orderkey"], 4)


@query
def reconcile_fingerprint(spark, sf):
    return reconcile.reconcile_fingerprint(*_orders(spark, sf), ["o_orderkey"], 256)


@query
def reconcile_diff(spark, sf):
    return reconcile.reconcile_unequal_buckets(*_orders(spark, sf), ["o_orderkey"], 1024)


@query
def reconcile_rows(spark, sf):
    """The same diff without fingerprints first: one pass, better when much differs."""
    return reconcile.reconcile_diff(*_orders(spark, sf), ["o_orderkey"])


@query
def reconcile_tree(spark, sf):
    """The same diff from two copies with digest trees: rows are read below unequal digests only."""
    root = fresh_path(spark, "digested")
    source, target = (
        digests.write_digested(rows, ["o_orderkey"], f"{root}/{name}", depth=3, folder_digits=1)
        for name, rows in zip(("source", "target"), _orders(spark, sf), strict=True)
    )
    told = settle(digests.reconcile_tree(source, target, spark), "diff")
    paths.delete(spark, root)
    return told


@query
def reconcile_after_apply(spark, sf):
    """Source and target differ only where the change log has not touched the row yet."""
    applied = cdc.apply_changes(
        view(spark, sf, "snapshot"), view(spark, sf, "changes"), KEY, PAYLOAD
    )
    return reconcile.reconcile_diff(
        table(spark, sf, "customer").select(*KEY, *PAYLOAD), applied, KEY
    )


@query
def capacity_plan(spark, sf):
    return sizing.capacity_plan(view(spark, sf, "fleet"))


@query
def capacity_totals(spark, sf):
    return sizing.capacity_totals(sizing.capacity_plan(view(spark, sf, "fleet")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot, then changes, then balance by nation in cents."""
    configure(spark)
    moved = cdc.apply_changes(
        view(spark, sf_dir, "snapshot"), view(spark, sf_dir, "changes"), KEY, PAYLOAD
    )
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    totals = moved.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("customers"), F.sum(cents).alias("balance_cents")
    )
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name"
    )
    return totals.join(nation, "c_nationkey").select("n_name", "customers", "balance_cents")


QUERIES["balance_after_move"] = flagship
