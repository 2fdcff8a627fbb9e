"""Copy, change apply, fences and reconciliation: properties and small cases."""

import itertools
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.operators import cdc, copy, preflight, reconcile, sizing
from relocate.sources import documents, paths, tables
from relocate.sources.snapshot import (
    read_snapshot,
    snapshot_copy,
    snapshot_position,
    snapshot_rows,
    versions,
)

CHANGE = "id bigint, seq bigint, op string, v string"
KEYS, PAYLOAD = ["id"], ["v"]


def changes(seed, n=400, ids=30):
    """A third of all changes hit one key."""
    rng = random.Random(seed)
    return [
        (0 if rng.random() < 0.34 else rng.randrange(ids), i, rng.choice("IUUD"), f"v{i}")
        for i in range(n)
    ]


def replay(start, log):
    state = dict(start)
    for key, _, op, value in sorted(log, key=lambda c: c[1]):
        if op == "D":
            state.pop(key, None)
        else:
            state[key] = value
    return state


def as_dict(df):
    rows = df.collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: r.v for r in rows}


START = {i: "old" for i in range(0, 40, 2)}


@pytest.fixture
def target(spark):
    return spark.createDataFrame(list(START.items()), "id bigint, v string")


@pytest.mark.parametrize("seed", [1, 2])
def test_apply_equals_replay(spark, target, seed):
    log = changes(seed)
    df = spark.createDataFrame(log, CHANGE)
    assert as_dict(cdc.apply_changes(target, df, KEYS, PAYLOAD)) == replay(START, log)
    settled = cdc.apply_changes(target, df, KEYS, PAYLOAD, settle_changes=True)
    assert as_dict(settled) == replay(START, log)


def test_apply_in_batches_equals_apply_at_once(spark, target):
    log = changes(3)
    parts = [spark.createDataFrame(log[i : i + 150], CHANGE) for i in range(0, 400, 150)]
    state = target
    for part in parts:
        state = cdc.apply_changes(state, part, KEYS, PAYLOAD)
    again = cdc.apply_changes(state, parts[-1], KEYS, PAYLOAD)
    assert as_dict(state) == replay(START, log) == as_dict(again)


def test_merge_ignores_repeats_and_order(spark):
    log = changes(4, 90, 8)
    parts = [log[:30], log[30:60], log[60:]]
    empty = spark.createDataFrame([], CHANGE)
    for order in itertools.permutations(range(3)):
        state = empty
        for i in [*order, order[0]]:
            state = cdc.merge_versions(
                state, spark.createDataFrame(parts[i], CHANGE), KEYS, PAYLOAD
            )
        assert as_dict(cdc.live_rows(state, KEYS, PAYLOAD)) == replay({}, log)


def test_resume_skips_what_the_snapshot_holds(spark):
    log = changes(5)
    snapshot = spark.createDataFrame(
        list(replay(START, log[:200]).items()), "id bigint, v string"
    )
    df = spark.createDataFrame(log, CHANGE)
    got = cdc.resume_from_snapshot(snapshot, df, 199, KEYS, PAYLOAD)
    assert as_dict(got) == replay(START, log)


def test_counts(spark, target):
    log = [(0, 1, "U", "a"), (0, 2, "D", "a"), (1, 3, "I", "b"), (2, 4, "U", "c"), (5, 5, "D", "x")]
    row = cdc.apply_counts(target, spark.createDataFrame(log, CHANGE), KEYS).first()
    assert (row.keys_changed, row.rows_deleted, row.rows_inserted, row.rows_new) == (4, 2, 2, 1)


def test_backlog_of_groups_never_applied(spark):
    log = spark.createDataFrame([(1, 1, "I"), (1, 2, "D"), (2, 3, "U")], "g int, seq bigint, op string")
    applied = spark.createDataFrame([(1, 1)], "g int, last_seq bigint")
    rows = {r.g: (r.pending, r.pending_deletes) for r in cdc.pending_backlog(log, applied, ["g"]).collect()}
    assert rows == {1: (1, 1), 2: (1, 0)}


def test_fence_split_is_a_partition(spark):
    rng = random.Random(6)
    fences = [
        (run, a, None if rng.random() < 0.2 else a + rng.randint(-3, 40))
        for run in range(3)
        for a in [rng.randrange(300) for _ in range(6)]
    ]
    rows = [(i, rng.randrange(4), rng.randrange(320)) for i in range(500)]
    log = spark.createDataFrame(rows, "seq bigint, run_id bigint, commit_us bigint")
    up = spark.createDataFrame(fences, "run_id bigint, from_us bigint, to_us bigint")
    for span_rows in (None, 7):
        got = cdc.write_fence_split(log, up, span_rows=span_rows).collect()
        assert len(got) == len(rows)
        for r in got:
            inside = any(
                f[0] == r.run_id and f[1] <= r.commit_us and (f[2] is None or r.commit_us < f[2])
                for f in fences
            )
            assert r.quarantined == inside


def test_very_many_short_fences(spark):
    """100,000 fences of one run, each up for two of every ten micros, and a log read once."""
    fences = spark.range(100_000).selectExpr("1 AS run_id", "id * 10 AS from_us", "id * 10 + 2 AS to_us")
    log = spark.range(0, 1_000_000, 3).selectExpr("1 AS run_id", "id AS seq", "id AS commit_us")
    for span_rows in (None, 50_000):
        got = cdc.write_fence_split(log, fences, span_rows=span_rows)
        assert got.filter("quarantined <> (commit_us % 10 < 2)").isEmpty()
        assert got.count() == 333_334
    plan = cdc.write_fence_split(log, fences)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 1000000") == 1 and "Join" not in plan


def scanned(df):
    """Files and rows that the scan of a DataFrame's only table brought in."""
    plan = df._jdf.queryExecution().executedPlan()
    while plan.nodeName() not in ("Scan parquet ",):
        plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.children().apply(0)
    return tuple(plan.metrics().apply(name).value() for name in ("numFiles", "numOutputRows"))


def test_resume_reads_only_the_tail_of_the_log(spark, tmp_path):
    log = spark.range(100_000).selectExpr("id * 7919 % 100000 AS seq", "'U' AS op", "id AS k", "uuid() AS v")
    path = str(tmp_path / "log")
    for part in (0, 1):  # appended twice
        cdc.write_log(log.filter(f"seq div 50000 = {part}"), path, span=10_000)
    for position, rows in ((94_999, 5_000), (-1, 100_000), (99_999, 0), (60_000, 39_999)):
        tail = cdc.read_log_after(spark, path, position, span=10_000)
        found = tail.collect()
        assert sorted(r.seq for r in found) == list(range(position + 1, 100_000)) and len(found) == rows
        files, read = scanned(tail)
        folders = 10 - max(position, 0) // 10_000
        assert files <= 2 * folders + 2 and read <= 10_000 * folders
    assert cdc.read_log_after(spark, path, 94_999, span=10_000).columns == ["seq", "op", "k", "v"]


def test_diff_counts_copies_without_pairing_them(spark):
    source = spark.createDataFrame([(1, "a")] * 5 + [(2, "b"), (3, "c"), (4, None)], "id bigint, v string")
    target = spark.createDataFrame([(1, "a")] * 3 + [(2, "x"), (5, "e"), (4, None)], "id bigint, v string")
    rows = {r.id: r[1:] for r in reconcile.reconcile_diff(source, target, KEYS).collect()}
    assert rows == {1: ("missing", 2, 0), 2: ("changed", 1, 1), 3: ("missing", 1, 0), 5: ("extra", 0, 1)}
    assert reconcile.reconcile_diff(source, source, KEYS).count() == 0
    both = reconcile.reconcile_unequal_buckets(source, target, KEYS, 7).collect()
    assert {r.id: r[1:] for r in both} == rows


def test_row_text_keeps_columns_apart(spark):
    left = spark.createDataFrame([(1, "a|1:b", "c")], "id bigint, v string, w string")
    right = spark.createDataFrame([(1, "a", "1:b|1:c")], "id bigint, v string, w string")
    assert reconcile.reconcile_diff(left, right, KEYS).count() == 1
    nulls = spark.createDataFrame([(1, None, "~")], "id bigint, v string, w string")
    words = spark.createDataFrame([(1, "~", None)], "id bigint, v string, w string")
    assert reconcile.reconcile_diff(nulls, words, KEYS).count() == 1


def test_sample_picks_the_same_keys_on_both_sides(spark):
    rows = spark.range(2000).select("id", F.lit("a").alias("v"))
    other = rows.filter("id % 100 <> 0")
    got = reconcile.reconcile_sample(rows, other, KEYS, 5)
    assert 0 < got.count() < 20 and {r.difference for r in got.collect()} == {"missing"}


def test_columns_that_are_all_generated(spark):
    columns = spark.createDataFrame(
        [(1, "public", "a", 1, "x", True), (1, "public", "b", 2, "Y", False),
         (1, "public", "b", 1, "id", False), (1, "public", "b", 3, "g", True),
         (1, "public", "c", 1, "id", False)],
        "db_id bigint, schema_name string, table_name string, pos bigint, column_name string, "
        "is_generated boolean",
    )
    rows = {r.table_name: (r.columns, r.skipped) for r in copy.copy_column_list(columns).collect()}
    assert rows == {"a": (None, True), "b": ('id, "Y"', False)}
    assert {r.table_name for r in preflight.generated_columns(columns).collect()} == {"a", "b"}


def test_key_violations_with_null_keys(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id bigint")
    row = preflight.key_violations({"t": (rows, [["id"]])}).first()
    assert (row.rows, row.duplicate_groups, row.duplicate_rows, row.null_key_rows) == (5, 1, 2, 2)


def test_invalid_encoding_keys(spark):
    rows = spark.createDataFrame(
        [(1, bytearray(b"ok")), (2, bytearray(b"caf\xe9")), (3, None)], "id bigint, t binary"
    )
    assert [r.id for r in preflight.invalid_encoding_keys(rows, ["id"], "t").collect()] == [2]


def test_residue_pattern_takes_any_character_for_underscore(spark):
    triggers = spark.createDataFrame(
        [(1, "sync_a"), (1, "syncXb"), (1, "other"), (2, "sync")], "db_id bigint, trigger_name string"
    )
    schemas = spark.createDataFrame([(2, "syncer")], "db_id bigint, schema_name string")
    dbs = spark.createDataFrame([(1,), (2,), (3,)], "db_id bigint")
    rows = cdc.cleanup_residue(dbs, triggers, schemas, "sync_", "syncer").orderBy("db_id").collect()
    assert [tuple(r) for r in rows] == [(1, 2, 0, False), (2, 0, 1, False), (3, 0, 0, True)]


def test_capacity_tiers_at_their_limits(spark):
    gb = sizing.KB_PER_GB
    sizes = [(1, gb, 10, 5), (2, gb, 10**7, 5), (3, 50 * gb, 1, 1), (4, 100 * gb, 1, 1),
             (5, 500 * gb + 1, 1, 1), (6, 1000 * gb + 1, 1, 1), (7, 1025 * gb, 1, 1)]
    fleet = spark.createDataFrame(sizes, "db_id bigint, size_kb bigint, row_count bigint, table_count bigint")
    rows = sizing.capacity_plan(fleet).orderBy("db_id").collect()
    assert [(r.app_tier, r.instance_tier, r.needs_steady_host) for r in rows] == [
        ("512 MB", "xlarge", False), ("1 GB", "xlarge", False), ("2.5 GB", "xlarge", False),
        ("2.5 GB", "2xlarge", False), ("14 GB", "4xlarge", False), ("14 GB", "8xlarge", False),
        ("14 GB", "8xlarge", True),
    ]


# --- sources -----------------------------------------------------------------------


def test_snapshot_shows_only_finished_copies(spark, target, tmp_path):
    root = str(tmp_path / "copy")
    bad = target.select(F.raise_error(F.lit("lost")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        snapshot_copy(spark, {"a": target, "b": bad}, root)
    assert versions(spark, root) == []
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root)
    assert snapshot_copy(spark, {"a": target}, root) == 1
    assert snapshot_copy(spark, {"a": target.limit(0), "b": target}, root) == 2
    assert as_dict(read_snapshot(spark, root)["b"]) == START
    assert read_snapshot(spark, root)["a"].count() == 0
    assert as_dict(read_snapshot(spark, root, 1)["a"]) == START


def test_schema_drift_fails(spark, target):
    expected = T.StructType.fromDDL("v string, id bigint")
    assert tables.require_schema(target, expected).columns == ["v", "id"]
    with pytest.raises(ValueError, match="drift"):
        tables.require_schema(target.withColumn("id", F.col("id").cast("int")), expected)


def test_jdbc_options():
    options = tables.jdbc_options(
        "jdbc:postgresql://h:5433/db", "t", user="u", password="p:@/", split_column="id",
        lower=0, upper=9, partitions=4,
    )
    assert options["password"] == "p:@/" and options["numPartitions"] == "4"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", split_column="id")


def test_log_lines_keep_file_order_across_splits(spark, tmp_path):
    for name, n in (("a.log", 3000), ("b.log", 10)):
        (tmp_path / name).write_text("".join(f"{name} line {i}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = documents.read_log_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 3010
    for name, n in (("a.log", 3000), ("b.log", 10)):
        mine = sorted((r.line_no, r.line) for r in rows if r.file.endswith(name))
        assert [line for _, line in mine] == [f"{name} line {i}" for i in range(n)]
        assert len({no for no, _ in mine}) == n


def test_documents_round_trip(spark, tmp_path):
    progress = {
        "captured_at": "2025-01-01T00:00:00Z", "table_sizes": {"a": 10, "b": 20},
        "total_tables": 2, "total_bytes": 30, "completed_tables": ["public.a"],
        "history": [{"ts": "2025-01-01T00:00:05Z", "tables_completed": 1, "copied_bytes": 10,
                     "rows_changed_last_sync": None, "last_good_sync": "x"}],
        "last_progress_at": None, "max_copied_bytes_seen": 10,
    }
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "one.json").write_text(json.dumps(progress))
    docs = documents.read_progress_documents(spark, str(tmp_path / "p"))
    sizes = {(r.table_name, r.source_bytes, r.completed) for r in documents.progress_sizes(docs).collect()}
    assert sizes == {("a", 10, True), ("b", 20, False)}
    point = documents.progress_history(docs).first()
    assert (point.tick, point.obs_us, point.copied_bytes) == (0, 1735689605000000, 10)
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "status.json").write_text('{"phase": "copying", "state": "initial_copy"}')
    status = documents.read_status_documents(spark, str(tmp_path / "s")).first()
    assert status.phase == "copying" and status.error is None
    out = str(tmp_path / "out")
    documents.write_documents(docs.drop("file"), out)
    assert documents.read_progress_documents(spark, out).first().table_sizes == {"a": 10, "b": 20}
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.txt").write_text("Status : Active\nTables in sync : 3\n")
    assert documents.read_status_blocks(spark, str(tmp_path / "t")).first().block.count("\n") == 2


def test_byte_length(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"x" * 77)
    assert paths.byte_length(spark, str(tmp_path)) == 77
    assert paths.child_names(spark, str(tmp_path / "none")) == []
    assert os.path.exists(tmp_path / "f")


def test_a_copy_remembers_its_position(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(10)], "id int, v string")
    changes = spark.createDataFrame(
        [(1, 5, "U", "stale"), (2, 9, "U", "new"), (3, 10, "D", None)],
        "id int, seq long, op string, v string",
    )
    root = str(tmp_path / "copy")
    snapshot_copy(spark, {"t": rows}, root, position=7)
    assert snapshot_position(spark, root) == 7 and snapshot_rows(spark, root) == {"t": 10}
    copied = read_snapshot(spark, root)["t"]
    got = cdc.resume_from_snapshot(copied, changes, snapshot_position(spark, root), ["id"], ["v"])
    assert {r.id: r.v for r in got.collect()} == {
        **{i: f"v{i}" for i in range(10) if i not in (2, 3)}, 2: "new",
    }
    snapshot_copy(spark, {"t": rows}, root)
    assert snapshot_position(spark, root) is None


def test_a_fence_until_the_end_of_time(spark):
    year_9999 = 253_370_764_800_000_000
    log = spark.createDataFrame([(1, 86_400_000_000 * d) for d in range(20)], "run_id int, commit_us long")
    fences = spark.createDataFrame(
        [(1, 86_400_000_000 * 5, year_9999), (1, 0, 1), (2, 0, None), (1, -(10**17), -5)],
        "run_id int, from_us long, to_us long",
    )
    got = cdc.write_fence_split(log, fences)
    assert [r.quarantined for r in got.orderBy("commit_us").collect()] == [True] + [False] * 4 + [True] * 15


def test_pruned_diff_sees_nulls_and_maps(spark):
    source = spark.sql(
        "select id, if(id = 3, null, 'a') as x, if(id = 4, 'a', null) as y, map('k', id, 'l', 2L) as m from range(500)"
    )
    target = spark.sql(
        "select id, if(id = 4, null, 'a') as x, if(id = 3, 'a', null) as y, map('l', 2L, 'k', id) as m from range(1, 500)"
    )
    want = reconcile.reconcile_diff(source, target, ["id"])
    got = reconcile.reconcile_unequal_buckets(source, target, ["id"], 64)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r.id for r in got.collect()} == {0, 3, 4}
