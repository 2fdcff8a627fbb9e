"""What the physical plans must and must not hold."""

import re

import pytest

from relocate.operators import health, lifecycle, parse, progress, reconcile
from relocate.plans.inputs import status_text, table, view
from relocate.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert banned not in plan


def test_scan_prunes_and_pushes_down(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(QUERIES["scan_source"](spark, SF_DIR))
    assert "GreaterThanOrEqual(l_quantity,25.0)" in plan and "EqualTo(l_returnflag,R)" in plan
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
    }


def test_tails_are_cut_before_the_shuffle(spark):
    for name in ("log_tail", "error_digest"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_changes_are_folded_before_the_shuffle(spark):
    plan = plan_of(QUERIES["cdc_apply"](spark, SF_DIR))
    assert "partial_max_by" in plan


def test_all_measures_share_one_shuffle_and_sort(spark, tmp_path):
    view(spark, SF_DIR, "ticks").write.parquet(str(tmp_path / "ticks"))
    stored = spark.read.parquet(str(tmp_path / "ticks"))
    plan = plan_of(progress.progress_signals(stored))
    assert plan.count("Exchange") == 1 and len(re.findall(r"\bSort \[", plan)) == 1


def test_parsing_and_rules_add_no_shuffle(spark, tmp_path):
    view(spark, SF_DIR, "ticks").write.parquet(str(tmp_path / "ticks"))
    stored = spark.read.parquet(str(tmp_path / "ticks"))
    parsed = health.replication_health(parse.parse_status(status_text(stored)))
    gated = lifecycle.switch_gate(parsed.withColumn("force", parsed.state_raw))
    assert "Exchange" not in plan_of(gated)


def test_diff_joins_nothing(spark):
    orders = table(spark, SF_DIR, "orders")
    plan = plan_of(reconcile.reconcile_diff(orders, orders, ["o_orderkey"]))
    assert "Join" not in plan and plan.count("Exchange") <= 2


def test_a_look_reads_the_log_once_and_folds_it_by_hashing(spark, tmp_path):
    """The fold scans the log once without sorting; the look itself does not meet the log again."""
    view(spark, SF_DIR, "log_lines").write.parquet(str(tmp_path / "log"))
    lines = spark.read.parquet(str(tmp_path / "log"))
    folded = plan_of(parse.fold_log(lines, every_run=True))
    assert folded.count("FileScan parquet") == 1 and "SortAggregate" not in folded and "HashAggregate" in folded
    look = plan_of(
        health.observe(
            view(spark, SF_DIR, "run_status"), view(spark, SF_DIR, "table_sizes"), view(spark, SF_DIR, "remembered"), lines
        )
    )
    assert str(tmp_path / "log") not in look and "SortAggregate" not in look


def test_rows_line_is_matched_once(spark, tmp_path):
    view(spark, SF_DIR, "ticks").write.parquet(str(tmp_path / "ticks"))
    blocks = status_text(spark.read.parquet(str(tmp_path / "ticks")))
    plan = plan_of(blocks.select(parse.rows_changed(blocks.block).alias("rows")))
    assert plan.count("regexp_extract_all(") == 1
