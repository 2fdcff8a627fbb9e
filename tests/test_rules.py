"""Golden cases for status text, logs, health, readiness and phases."""

import pytest
from pyspark.sql import functions as F

from relocate import fixed
from relocate.functions import text as tx
from relocate.operators import health, lifecycle, parse
from relocate.plans.queries import QUERIES

NOW_US = 1_800_000_000_000_000
RECENT = "Jan 15, 2027 07:59:58"  # two seconds before NOW_US
OLD = "Jan 01, 2025 00:00:00"


def block(copy="No", state="Good", good=RECENT, error="", rows=None):
    lines = [
        "=" * 70,
        "Sync name                : main",
        f"Current state            : {state}",
        "Source relgroup/database : main / source",
        "Tables in sync           : 10",
        "Status                   : Active",
        f"Onetimecopy              : {copy}",
    ]
    if rows:
        lines.append(f"Rows deleted/inserted    : {rows}")
    lines += [f"Last good                : {good} (time to run: 2s)", f"Last error:              : {error}"]
    return "\n".join([*lines, "=" * 70, ""])


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(column(F.col("v"))).collect()]


def parsed(spark, *texts, phase="replicating"):
    df = spark.createDataFrame(
        [(i, t, phase, NOW_US) for i, t in enumerate(texts)],
        "run_id bigint, block string, phase string, obs_us bigint",
    )
    return parse.parse_status(df)


def judge(spark, text, phase="replicating", force=None):
    rows = health.replication_health(parsed(spark, text, phase=phase))
    return lifecycle.switch_gate(rows.withColumn("force", F.lit(force).cast("string"))).first()


def test_copy_running_blocks_the_switch(spark):
    row = judge(spark, block(copy="Yes"))
    assert (row.readiness, row.decision, row.http_status) == ("blocked", "cutover_blocked", 409)
    assert judge(spark, block(copy="Yes"), force="1").decision == "cutover_blocked"


def test_stale_sync_with_error_needs_override(spark):
    text = block(good=OLD, error="Ended (CTL 999)")
    row = judge(spark, text)
    assert row.decision == "cutover_override_required" and row.http_status == 409
    assert row.soft_blockers == ["replication_not_healthy"] and row.blocker == "replication_not_healthy"
    for force in ("1", "true", "YES"):
        assert judge(spark, text, force=force).decision == "allowed"
    assert judge(spark, text, force="on").decision == "cutover_override_required"


@pytest.mark.parametrize(
    "text",
    [block(), block(error="Ended (CTL 14640)"), block(state="Syncing")],
    ids=["clean", "old error, recent sync", "unknown state, recent sync"],
)
def test_ready(spark, text):
    row = judge(spark, text)
    assert (row.readiness, row.can_force, row.health) == ("ready", True, "healthy")


def test_switch_only_while_replicating(spark):
    row = judge(spark, block(), phase="copying")
    assert (row.readiness, row.decision) == ("ready", "phase_not_allowed")


def test_readiness_without_status(spark):
    for phase, level in (
        ("replicating", "blocked"), ("switched", "ready"), ("waiting", "not_ready"),
    ):
        row = judge(spark, "  \n ", phase=phase)
        assert row.readiness == level and row.health == "blocked"
        assert row.hard_blockers == (["status_unavailable"] if level == "blocked" else [])


def test_retry_only_from_error(spark):
    actions = spark.createDataFrame(
        [("retry", "error"), ("retry", "replicating"), ("start", None), ("start", "unknown"),
         ("abort", "configuring"), ("abort", "switched"), ("pause", "copying"), ("revert", None)],
        "action string, phase string",
    )
    got = [r.accepted for r in lifecycle.action_guard(actions).collect()]
    assert got == [True, False, False, True, True, False, True, True]


def test_parse_status_fields(spark):
    row = parsed(spark, block(rows="1,234 / 5,678,901")).first()
    assert (row.active, row.state, row.copy_phase, row.tables_in_sync) == (
        "Active", "good", "finished", 10,
    )
    assert (row.rows_deleted, row.rows_inserted, row.rows_changed) == (1234, 5678901, 5680135)
    assert row.last_error is None and row.last_good_us == NOW_US - 2_000_000


def test_last_line_wins_and_blank_text_is_null(spark):
    twice = block(state="Bad") + block(state="Good", copy="Maybe")
    rows = parsed(spark, twice, " \n\t", None).orderBy("run_id").collect()
    assert (rows[0].state, rows[0].copy_phase) == ("good", "unknown")
    assert [r.status_seen for r in rows] == [True, False, False]
    assert rows[1].state is None and rows[1].rows_changed is None


def test_empty_label_does_not_take_the_next_line(spark):
    row = parsed(spark, "Current state : \nStatus : Active\nLast error: :\n").first()
    assert row.state_raw is None and row.active == "Active" and row.last_error is None


def test_earlier_error_stays_when_a_later_line_is_empty(spark):
    row = parsed(spark, "Last error : : boom\nLast error: :\n").first()
    assert row.last_error == "boom"


@pytest.mark.parametrize(
    "text,state",
    [
        ("Current state : Good\nCurrent state :  \n", ""),
        ("Current state : Good\nCurrent state :\n", "Good"),
        ("Current state : Good\nCurrent state unclear", "Good"),
        ("Current state : Good\n  Current state : Bad", "Good"),
        ("the Current state : Good", None),
        ("Current state\t:\tGood\r\nx", "Good"),
    ],
)
def test_last_fitting_line_counts(spark, text, state):
    row = parsed(spark, text).first()
    assert row.state_raw == state


def test_rows_line_that_does_not_fit_is_passed_over(spark):
    text = "Rows deleted/inserted : 1 / 2\nRows deleted/inserted : - / -\n"
    row = parsed(spark, text).first()
    assert (row.rows_deleted, row.rows_inserted) == (1, 2)


def test_states(spark):
    got = one(
        spark, tx.normalize_state,
        "No records found", "Good", "good", "Bad", "INSERT public.t1", "inserted", "begin txn 4",
        "delta_check", "", None,
    )
    assert got == [
        "not-yet-started", "good", "unknown", "bad", "applying_changes", "unknown",
        "applying_changes", "applying_changes", "unknown", None,
    ]


def test_names(spark):
    got = one(
        spark, tx.normalize_table_name,
        ' "public.users" ', "Public.Users", "audit.t", '""', "", None, "publicusers",
        '"public"."t"',
    )
    assert got == ["users", "Users", "audit.t", None, None, None, "publicusers", 'public"."t']


def test_quoting(spark):
    got = one(spark, tx.quote_ident, "id", "Id", 'a"b', "1st", "order", "orders", "a$")
    assert got == ["id", '"Id"', '"a""b"', '"1st"', '"order"', "orders", '"a$"']


def test_times(spark):
    got = one(
        spark, lambda c: F.unix_seconds(tx.safe_time(c)),
        "Jan 01, 2025 00:00:00 (time to run: 2s)", "Jan 1, 2025 00:00:00", "2025-01-01T00:00:00Z",
        "2025-01-01 00:00:00", "12:30", "none", "Foo 01, 2025 00:00:00", "  ", None,
    )
    assert got == [1735689600] * 4 + [None] * 5


def test_errors(spark):
    got = one(spark, tx.last_error_clean, " : ", ":: x ", "plain", "", None)
    assert got == [None, "x", "plain", None, None]


def log(spark, *lines):
    return spark.createDataFrame(
        [(1, i, line) for i, line in enumerate(lines)], "run_id bigint, line_no bigint, line string"
    )


def known(spark, *names):
    return spark.createDataFrame([(1, n) for n in names], "run_id bigint, table_name string")


def test_completed_tables_order_by_pattern_first(spark):
    lines = log(
        spark, 'table "b" done', 'Finished table "public.a"', 'copied table c"',
        "finished table plain", 'done with table "zz"', 'finished table "a"',
    )
    rows = parse.log_completed_tables(lines, known(spark, "a", "b", "c", "plain")).orderBy(
        "pattern_no", "line_no"
    )
    assert [r.table_name for r in rows.collect()] == ["a", "c", "b"]
    assert parse.log_completed_tables(lines).count() == 4


def test_current_table(spark):
    names = known(spark, "a", "b", "c")

    def current(*lines):
        return parse.log_current_table(log(spark, *lines), names).first().current_table

    # A later pattern beats a later line, and only first mentions count.
    assert current('table "b" copy started', 'copying table "a"') == "b"
    assert current('copying table "a"', 'copying table "b"', 'copying table "a"') == "b"
    # Nothing named outright: the last line with both words, its last known word.
    assert current("copy of table a", "table c then b then c copy", "other a") == "b"
    assert current("nothing here") is None


def test_warnings_and_digest(spark):
    lines = log(
        spark, "one", 'WARNING:  no privileges were granted for "x"',
        ' WARNING:  no privileges were granted for "x"', "WARNING: disk", "y" * 600,
    )
    assert [r.line_no for r in parse.filter_warnings(lines).orderBy("line_no").collect()] == [0, 2, 3, 4]
    digest = parse.error_digest(lines, 2).first().digest
    assert digest.startswith("WARNING: disk yyy") and len(digest) == 500
    assert parse.log_tail(lines, 2).count() == 2


def test_auto_transitions(spark):
    rows = spark.createDataFrame(
        [
            ("ready_to_copy", None, "applying_changes", "in-progress", True),
            ("ready_to_copy", "replicating", "applying_changes", "in-progress", True),
            ("starting", None, "not-yet-started", "in-progress", True),
            ("copying", None, "good", "finished", True),
            ("copying", None, "bad", "finished", True),
            ("copying", None, "good", "unknown", True),
            ("copying", None, None, None, False),
            ("switched", None, "good", "finished", True),
        ],
        "phase string, persisted_phase string, state string, copy_phase string, status_seen boolean",
    ).withColumns(
        {
            "last_good_us": F.lit(None).cast("bigint"),
            "last_error": F.lit(None).cast("string"),
            "obs_us": F.lit(NOW_US),
        }
    )
    got = [(r.next_phase, r.next_state) for r in lifecycle.auto_transition(rows).collect()]
    assert got == [
        ("copying", "initial_copy"), ("ready_to_copy", None), ("starting", None),
        ("replicating", "running"), ("copying", "copy_health_check_failed"),
        ("copying", "copy_status_ambiguous"), ("copying", None), ("switched", None),
    ]


WRITE = (
    "run_id bigint, seq bigint, at_us bigint, phase string, started_us bigint, "
    "switched_us bigint, completed_us bigint, error string"
)


def test_state_keeps_start_and_drops_switch_time(spark):
    writes = [
        (1, 1, 10, "starting", 9, None, None, None),
        (1, 2, 20, "switched", 99, 20, None, None),
        (1, 3, 30, "cleaning_up", 99, None, None, None),
        (2, 1, 5, "error", None, None, None, "boom"),
    ]
    whole = lifecycle.state_upsert(spark.createDataFrame(writes, WRITE))
    rows = {r.run_id: r for r in whole.collect()}
    assert (rows[1].phase, rows[1].started_us, rows[1].switched_us, rows[1].error) == (
        "cleaning_up", 9, None, "",
    )
    assert (rows[2].started_us, rows[2].error) == (5, "boom")
    first = lifecycle.state_upsert(spark.createDataFrame(writes[:2], WRITE))
    again = lifecycle.state_upsert(spark.createDataFrame(writes[2:], WRITE), first)
    assert sorted(map(str, again.collect())) == sorted(map(str, whole.collect()))


def test_milestones(spark):
    phases = ["starting", "starting", "copying", "starting", "error", "error", "aborted", "copying"]
    log_rows = spark.createDataFrame(
        [(1, i, i * 10, p, "e" * 300 if p == "error" else None) for i, p in enumerate(phases)],
        "run_id bigint, seq bigint, at_us bigint, phase string, error string",
    )
    rows = lifecycle.milestones(log_rows).orderBy("seq").collect()
    assert [(r.seq, r.milestone) for r in rows] == [
        (0, "starting"), (2, "copying"), (4, "error"), (7, "copying"),
    ]
    assert len(rows[2].detail) == 200


def test_queries_reach_every_outcome(spark):
    """Readiness, blockers and decisions that the rules know all occur in registered queries."""
    def values(name, column):
        return {r[0] for r in QUERIES[name](spark, "/root/testdata/sf0.01").select(column).distinct().collect()}

    assert values("cutover_readiness", "readiness") == {"ready", "warning", "blocked", "not_ready"}
    assert values("cutover_readiness", "hard_blockers") == {"", fixed.STATUS_UNAVAILABLE, fixed.COPY_NOT_FINISHED}
    assert values("replication_health", "health") == {"healthy", "degraded", "blocked"}
    assert values("switch_gate", "decision") == {
        fixed.SWITCH_ALLOWED, fixed.SWITCH_BLOCKED, fixed.SWITCH_NEEDS_OVERRIDE, fixed.SWITCH_WRONG_PHASE,
    }
