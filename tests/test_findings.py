"""Inputs that registered queries hardly meet: missing sides, twins, null keys, nested values."""

import os
import re

import duckdb
from compare import differences
from pyspark.sql import functions as F

from relocate.functions.hashing import row_text
from relocate.operators import cdc, health, lifecycle, parse, preflight, progress
from relocate.plans.inputs import view
from relocate.plans.oracles import oracles
from relocate.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_without_sizes_or_status_stay(spark):
    sizes = spark.createDataFrame(
        [(1, "a", 10, 5), (1, "b", 30, 30), (3, "a", 7, None)],
        "run_id int, table_name string, source_bytes long, target_bytes long",
    )
    done = spark.createDataFrame([(1, "a"), (2, "x"), (4, "y")], "run_id int, table_name string")
    status = spark.createDataFrame(
        [(1, 1, "in-progress"), (2, 5, "finished")], "run_id int, tables_in_sync long, copy_phase string"
    )
    counted = {r.run_id: r[1:] for r in progress.tables_completed(sizes, done, status).collect()}
    assert counted == {1: (2, 1), 2: (0, 0), 3: (1, 0)}
    measured = {r.run_id: r[1:] for r in progress.byte_progress(sizes, done, status).collect()}
    assert measured == {
        1: (35, 40, 87.5, "target_size_estimate"),
        2: (0, 0, 0.0, "completed_tables"),
        3: (0, 7, 0.0, "completed_tables"),
    }


def test_a_run_without_a_list_accepts_every_table(spark):
    lines = spark.createDataFrame(
        [(1, 1, 'finished table "a" ok'), (1, 2, 'finished table "z" ok'), (2, 1, 'finished table "z" ok'),
         (1, 3, 'copying table "a" now'), (2, 4, 'copying table "q" now')],
        "run_id int, line_no long, line string",
    )
    known = spark.createDataFrame([(1, "a")], "run_id int, table_name string")
    done = {(r.run_id, r.table_name) for r in parse.log_completed_tables(lines, known).collect()}
    assert done == {(1, "a"), (2, "z")}
    current = {r.run_id: r.current_table for r in parse.log_current_table(lines, known).collect()}
    assert current == {1: "a", 2: "q"}


def test_the_tail_has_as_many_lines_as_asked(spark):
    lines = spark.range(3000).select(F.lit(1).alias("run_id"), F.col("id").alias("line_no"), F.lit("x" * 300).alias("line"))
    assert parse.log_tail(lines, 2500).count() == 2500
    assert len(parse.error_digest(lines, 5).first().digest) == 500
    assert len(parse.error_digest(lines, 5, max_chars=None).first().digest) == 5 * 300 + 4


def test_a_twin_s_key_does_not_count(spark):
    tables = spark.createDataFrame(
        [(1, "public", "users"), (1, "audit", "users"), (2, "public", "t")],
        "db_id int, schema_name string, table_name string",
    )
    indexes = spark.createDataFrame(
        [(1, "audit", "users", True, True), (2, "public", "t", False, True), (2, "public", "t", True, True)],
        "db_id int, schema_name string, table_name string, is_primary boolean, is_unique boolean",
    )
    columns = spark.createDataFrame(
        [(2, "public", "t", 1, "c", False)],
        "db_id int, schema_name string, table_name string, pos int, column_name string, is_generated boolean",
    )
    assert [tuple(r) for r in preflight.tables_without_key(tables, indexes).collect()] == [(1, "public", "users")]
    gate = {r.db_id: r for r in preflight.preflight_gate(tables, indexes, columns).collect()}
    assert (gate[1].tables, gate[1].tables_without_key, gate[1].all_tables_valid) == (2, 1, False)
    assert (gate[2].tables, gate[2].tables_without_key, gate[2].all_tables_valid) == (1, 0, True)
    findings = preflight.preflight_findings(tables, indexes, columns)
    assert [(r.db_id, r.table_name) for r in findings.collect()] == [(1, "users")]
    actions = spark.createDataFrame(
        [(1, "start", "waiting"), (2, "start", "waiting"), (2, "start", "copying"), (1, "retry", "error"), (9, "start", "waiting")],
        "run_id int, action string, phase string",
    )
    judged = lifecycle.action_guard(actions, preflight.preflight_gate(tables, indexes, columns))
    accepted = {(r.run_id, r.action, r.phase): r.accepted for r in judged.collect()}
    assert accepted == {
        (1, "start", "waiting"): False, (2, "start", "waiting"): True, (2, "start", "copying"): False,
        (1, "retry", "error"): True, (9, "start", "waiting"): False,
    }


def test_gate_counts_what_findings_name(spark):
    gate = QUERIES["preflight_gate"](spark, SF_DIR).agg(F.sum("tables_without_key")).first()[0]
    named = QUERIES["preflight_findings"](spark, SF_DIR).filter("finding = 'no_key'").count()
    assert gate == named > 0


def test_null_keys_are_applied_like_others(spark):
    target = spark.createDataFrame([(None, "old"), (1, "a"), (2, "b")], "id int, v string")
    changes = spark.createDataFrame(
        [(None, 1, "U", "new"), (1, 2, "D", None), (3, 3, "I", "c"), (None, 4, "U", "newer")],
        "id int, seq long, op string, v string",
    )
    for settle in (False, True):
        rows = cdc.apply_changes(target, changes, ["id"], ["v"], settle_changes=settle).collect()
        assert sorted(map(str, rows)) == sorted(map(str, [(None, "newer"), (2, "b"), (3, "c")])) or {
            (r.id, r.v) for r in rows
        } == {(None, "newer"), (2, "b"), (3, "c")}
        assert len(rows) == 3


def test_the_log_is_read_once(spark, tmp_path):
    view(spark, SF_DIR, "changes").write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    applied = cdc.apply_changes(view(spark, SF_DIR, "snapshot"), log, ["c_custkey"], ["c_name"])
    applied.collect()
    assert len(re.findall(r"FileScan parquet \[[^\]]*seq", plan_of(applied).split("Initial Plan")[0])) == 1


def test_an_observation_reads_the_log_twice_at_most(spark, tmp_path):
    lines = view(spark, SF_DIR, "log_lines")
    lines.write.parquet(str(tmp_path / "log"))
    seen = health.observe(
        view(spark, SF_DIR, "run_status"), view(spark, SF_DIR, "table_sizes"),
        view(spark, SF_DIR, "remembered"), spark.read.parquet(str(tmp_path / "log")),
    )
    assert len(re.findall(r"FileScan parquet \[[^\]]*\bline#", plan_of(seen))) <= 2


def test_equal_maps_have_one_text(spark):
    a = spark.sql("select map('x', 1, 'y', 2) as m, 1 as k")
    b = spark.sql("select map('y', 2, 'x', 1) as m, 1 as k")
    c = spark.sql("select map('y', 2, 'x', 3) as m, 1 as k")
    texts = [d.select(row_text(d, ["k", "m"])).first()[0] for d in (a, b, c)]
    assert texts[0] == texts[1] != texts[2]


def test_nested_values_have_a_size(spark):
    rows = spark.sql(
        "select 1L as id, array('ab', null, 'cde') as s, map('k', 2) as m, named_struct('x', 1, 'y', array(1L, null)) as t"
        " union all select 2L, null, null, null"
    )
    sizes = {r.table_name: (r.rows, r.bytes) for r in preflight.relation_size({"t": rows}).collect()}
    assert sizes == {"t": (2, 16 + 5 + 5 + 12), None: (2, 38)}


def test_sizes_from_the_listing(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 AS part").repartition(3).write.partitionBy("part").parquet(str(tmp_path / "t"))
    # A file without rows has a footer and counts; one without bytes is not listed.
    spark.range(0).write.mode("append").parquet(str(tmp_path / "t" / "part=1"))
    (tmp_path / "t" / "part=1" / "nothing.txt").touch()
    (tmp_path / "none").mkdir()
    files = [f for f in (tmp_path / "t").glob("*/*.parquet")]
    stored = sum(os.stat(f).st_size for f in files)
    where = {"t": str(tmp_path / "t"), "none": str(tmp_path / "none")}
    sized = preflight.relation_files(spark, where)
    assert {r.table_name: (r.files, r.bytes) for r in sized.collect()} == {
        "t": (len(files), stored), "none": (0, 0), None: (len(files), stored),
    }
    assert "binaryFile" in plan_of(sized) and "parquet" not in plan_of(sized).split("ReadSchema")[0].lower().replace("/t", "")
    folders = {r.folder: (r.files, r.bytes) for r in preflight.relation_folders(spark, where).collect()}
    assert folders == {
        f"part={p}": (
            len([f for f in files if f.parent.name == f"part={p}"]),
            sum(os.stat(f).st_size for f in files if f.parent.name == f"part={p}"),
        )
        for p in range(3)
    }
    one = str(files[0])
    assert [tuple(r) for r in preflight.relation_folders(spark, {"f": one}).collect()] == [("f", "", 1, os.stat(one).st_size)]


def test_many_candidates_take_one_scan(spark, tmp_path):
    spark.range(5000).selectExpr("id", "id % 50 AS a", "id div 50 AS b", "if(id % 9 = 0, null, id) AS c").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    keys = [["id"], ["a"], ["b"], ["a", "b"], ["c"], ["a", "c"]]
    sketches = preflight.key_sketches(rows, keys)
    assert plan_of(sketches).count("FileScan parquet") == 1 and "Expand" not in plan_of(sketches)
    near = {r.key: r.distinct for r in sketches.collect()}
    assert abs(near["id"] - 5000) < 300 and abs(near["a"] - 50) < 5
    found = {r.key: (r.rows, r.null_key_rows, r.unique) for r in preflight.candidate_keys({"t": (rows, keys)}).collect()}
    nulls = 556
    assert found == {
        "id": (5000, 0, True), "a": (5000, 0, False), "b": (5000, 0, False), "a,b": (5000, 0, True),
        "c": (5000, nulls, True), "a,c": (5000, nulls, True),
    }
    empty = preflight.candidate_keys({"t": (rows.limit(0), [["id"]])}).collect()
    assert [tuple(r) for r in empty] == [("t", "id", 0, 0, True)]


def test_nested_keys_share_one_count(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 AS a", "id % 2 AS b").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    found = preflight.key_violations({"t": (rows, [["a"], ["a", "b"], ["b"], ["a", "b", "id"]])})
    assert {r.key: (r.rows, r.duplicate_groups) for r in found.collect()} == {
        "a": (100, 7), "a,b": (100, 14), "b": (100, 2), "a,b,id": (100, 0),
    }


def test_a_document_that_is_no_json(spark):
    rows = spark.createDataFrame([('{"a": {"b": [1, null]}}',), ("{broken",), (None,)], "document string")
    found = health.status_variant(rows).selectExpr("variant_get(document, '$.a.b[0]', 'int') AS x").collect()
    assert [r.x for r in found] == [1, None, None]


def test_the_record_judges_the_phase_moved_to(spark):
    row = {
        "run_id": 1, "tick": 1, "obs_us": 200_000_000, "phase": "copying", "status_seen": True, "state": "good",
        "copy_phase": "finished", "last_good_us": 199_000_000, "last_error": None, "rows_changed": 4,
        "tables_completed": 2, "total_tables": 2, "raw_copied_bytes": 10, "raw_mode": "completed_tables",
        "total_bytes": 10, "stored_error": "kept", "started_us": 7, "stored_state": "initial_copy",
    }
    schema = ", ".join(
        f"{k} {'boolean' if isinstance(v, bool) else 'long' if isinstance(v, int) else 'string'}" for k, v in row.items()
    )
    record = health.status_record(spark.createDataFrame([tuple(row.values())], schema)).first()
    assert (record.phase, record.state, record.error, record.started_us) == ("replicating", "running", "kept", 7)
    assert record.cutover_readiness.level == "ready" and record.status.rows_changed == 4


def test_milestone_details(spark):
    log = spark.createDataFrame(
        [(1, 1, 0, "ready_to_copy", None, 12), (1, 2, 0, "error", None, None), (1, 3, 0, "copying", None, None), (1, 4, 0, "error", "x" * 300, 1)],
        "run_id int, seq long, at_us long, phase string, error string, tables_in_sync long",
    )
    told = [r.detail for r in lifecycle.milestones(log).orderBy("seq").collect()]
    assert told == ["12 tables", "Unknown error", None, "x" * 200]
    assert lifecycle.milestones(log, max_chars=None).orderBy("seq").collect()[-1].detail == "x" * 300


def test_percent_of_a_half_rounds_as_in_sql(spark, tmp_path):
    shares = spark.range(1, 2000).select("id", progress.percent(F.col("id"), F.lit(2000)).alias("percent"))
    sql = "SELECT id, round(CAST(id AS DOUBLE) / 2000 * 100, 1) AS percent FROM range(1, 2000) t(id)"
    assert differences(shares, duckdb.connect(), sql) == []

    # One run, two hours: 5.67 of 20.00 are 28.35 percent.
    con = duckdb.connect()
    con.execute(f"""
        COPY (SELECT * FROM (VALUES
            (CAST(1 AS BIGINT), TIMESTAMP '2024-01-01 00:10:00', CAST(7 AS BIGINT), 'view', CAST(5.67 AS DOUBLE), '{{}}'),
            (2, TIMESTAMP '2024-01-01 01:10:00', 7, 'view', 14.33, '{{}}'))
          t(event_id, ts, user_id, event_type, value, props)) TO '{tmp_path}/events.parquet'""")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    found = QUERIES["status_document"](spark, str(tmp_path))
    assert differences(found, con, oracles()["status_document"]) == []
    assert sorted(r.percent for r in found.collect()) == [28.4, 100.0]
