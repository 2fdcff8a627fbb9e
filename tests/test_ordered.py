"""Split and plain plans of the ordered measures give the same rows."""

import random

import pytest
from pyspark.sql import functions as F

from relocate.operators import lifecycle, progress
from relocate.operators.ordered import SPAN, arrange

COLUMNS = (
    "run_id bigint, tick bigint, obs_us bigint, last_good_us bigint, rows_changed bigint, "
    "total_bytes bigint, raw_copied_bytes bigint, raw_mode string, copy_phase string, "
    "phase string, tables_completed bigint"
)


def looks(seed, gap):
    """One run holds most rows; ticks are dense or far apart and uneven."""
    rng = random.Random(seed)
    rows = []
    for run, n in ((1, 260), (2, 40), (3, 1), (4, 25)):
        tick, copied, good = 0, 0, None
        for i in range(n):
            tick += rng.randint(1, gap) if rng.random() < 0.9 else gap * 50
            copied += rng.choice([0, 0, 500, 9000]) - rng.choice([0, 0, 4000])
            if rng.random() < 0.3:
                good = tick * 1_000_000
            phase = "in-progress" if i < n // 2 else "finished"
            rows.append(
                (
                    run, tick, tick * 7_000_000 + rng.randint(0, 20_000_000), good,
                    rng.choice([None, 1, 2, 3, 5]), 100_000, max(copied, 0),
                    rng.choice(["target_size_estimate", "completed_tables"]), phase,
                    "copying" if i < n // 2 else "replicating", min(i // 20, 12),
                )
            )
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,gap,span", [(1, 1, 7), (2, 900, 16), (3, 40, 1), (4, 5, 100)])
def test_spans_change_nothing(spark, seed, gap, span):
    ticks = spark.createDataFrame(looks(seed, gap), COLUMNS)
    plain = progress.progress_signals(ticks)
    split = progress.progress_signals(ticks, span_rows=span)
    assert sorted(map(str, plain.collect())) == sorted(
        map(str, split.select(*plain.columns).collect())
    )


def test_spans_are_bounded_for_dense_order(spark):
    rows = spark.range(100_000).select(F.lit(1).alias("run_id"), F.col("id").alias("tick"))
    cut = arrange(rows, ["run_id"], "tick", 10_000)
    sizes = [r["count"] for r in cut.rows.groupBy(SPAN).count().collect()]
    assert sum(sizes) == 100_000 and max(sizes) <= 10_200 and len(sizes) == 10


@pytest.mark.parametrize("span_rows", [1000, 300])
def test_one_row_far_off_does_not_join_the_others(spark, span_rows):
    at = F.when(F.col("id") == 9999, F.lit(10**15)).otherwise(F.col("id"))
    rows = spark.range(10_000).select(F.lit(None).cast("int").alias("run_id"), at.alias("tick"))
    cut = arrange(rows, ["run_id"], "tick", span_rows)
    sizes = [r["count"] for r in cut.rows.groupBy(SPAN).count().collect()]
    assert sum(sizes) == 10_000 and max(sizes) <= 2 * span_rows


def test_the_plan_depends_on_the_parameter_alone(spark):
    rows = spark.range(1000).select((F.col("id") % 10).alias("run_id"), F.col("id").alias("tick"))
    assert not arrange(rows, ["run_id"], "tick").split
    small = arrange(rows, ["run_id"], "tick", 100)
    assert small.split and small.rows.filter(F.col(SPAN) > 0).count() == 0


@pytest.mark.parametrize("span", [1, 3, 10, 1000])
def test_null_keys_and_far_rows_stay(spark, span):
    rows = [(None if r[0] == 3 else r[0], *r[1:]) for r in looks(5, 2)]
    rows += [(None, 10**9 + i, *r[2:]) for i, r in enumerate(looks(6, 1)[:5])]
    ticks = spark.createDataFrame(rows, COLUMNS)
    plain = progress.progress_signals(ticks)
    split = progress.progress_signals(ticks, span_rows=span).select(*plain.columns)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    assert plain.count() == len(rows)


def test_progress_by_hand(spark):
    """Brute force over the rows of each run."""
    rows = looks(9, 3)
    ticks = spark.createDataFrame(rows, COLUMNS)
    got = {
        (r.run_id, r.tick): r
        for r in progress.progress_signals(ticks, span_rows=11).collect()
    }
    for run in {r[0] for r in rows}:
        high, history, last, shown = 0, [], None, None
        for r in sorted(r for r in rows if r[0] == run):
            _, tick, obs, good, changed, total, raw, mode, copy, phase, tables = r
            copied = high if copy == "in-progress" and raw < high else raw
            high = max(high, copied)
            if shown is None or tables > shown[0] or copied > shown[1] or good != shown[2]:
                last = obs
            shown = (tables, copied, good)
            history.append((obs // 1_000_000, copied, changed))
            points = [h[2] for h in history[-6:] if h[2] is not None]
            steps = [b - a for a, b in zip(points, points[1:])]
            trend = "stable"
            if len(points) < 3:
                trend = "unknown"
            elif all(s >= 0 for s in steps) and any(steps):
                trend = "growing"
            elif all(s <= 0 for s in steps) and any(steps):
                trend = "shrinking"
            first = history[-20:][0]
            took, gained = history[-1][0] - first[0], copied - first[1]
            row = got[(run, tick)]
            assert row.copied_bytes == copied
            assert row.backlog_trend == trend
            assert row.last_progress_us == last
            if took > 0 and gained > 0:
                assert abs(row.bytes_per_min - gained / took * 60) <= 0.5
            else:
                assert row.bytes_per_min is None


def test_previous_row_across_spans(spark):
    rows = [(run, s, f"p{s}") for run, n in ((1, 50), (2, 3)) for s in range(0, n * 3, 3)]
    log = spark.createDataFrame(rows, "run_id bigint, seq bigint, phase string")
    got = lifecycle.with_previous(log, {"before": "phase"}, span_rows=4).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.before == (None if r.seq == 0 else f"p{r.seq - 3}")
