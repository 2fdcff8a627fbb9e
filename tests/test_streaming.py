"""Streams over a growing folder against the batch operators."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.operators import cdc, lifecycle
from relocate.plans.inputs import view
from relocate.streaming.apply import apply_stream, first_of_repeats, milestone_stream, read_changes, silence_stream
from relocate.streaming.buckets import BucketedTable

SF_DIR = "/root/testdata/sf0.001"
KEYS = ["c_custkey"]
PAYLOAD = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def setup(spark, tmp_path):
    log = view(spark, SF_DIR, "changes").select("seq", "op", *KEYS, *PAYLOAD)
    schema = T.StructType([log.schema[c] for c in [*KEYS, "seq", "op", *PAYLOAD]])
    table = BucketedTable(spark, str(tmp_path / "table"), tuple(KEYS), tuple(PAYLOAD), schema, buckets=8)
    return log, table, str(tmp_path / "in"), str(tmp_path / "checkpoint")


def listing(table):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{table.path}/rows/*/*/*.parquet")}


def local(path):
    return path.removeprefix("file:")


def folded(spark, table, log):
    empty = spark.createDataFrame([], T.StructType([table.schema[c] for c in table.columns]))
    return cdc.live_rows(cdc.merge_versions(empty, log.select(*table.columns), KEYS, PAYLOAD), KEYS, PAYLOAD)


def test_kicks_equal_batch_apply(spark, setup):
    log, table, folder, checkpoint = setup
    snapshot = view(spark, SF_DIR, "snapshot")
    table.load(snapshot, seq=-1)
    stream = None
    bounds = [0, 200, 650, 10_000]
    for lower, upper in zip(bounds, bounds[1:]):
        part = log.filter(f"seq >= {lower} AND seq < {upper}")
        part.repartition(3).write.mode("append").parquet(folder)
        stream = read_changes(spark, folder, log.schema, files_per_batch=2)
        apply_stream(stream, table, checkpoint).awaitTermination()
        done = cdc.apply_changes(snapshot, log.filter(f"seq < {upper}"), KEYS, PAYLOAD)
        assert rows(table.read()) == rows(done.select(*KEYS, *PAYLOAD))
    # A kick with nothing queued, as after a restart, changes nothing.
    before = table.versions()
    apply_stream(stream, table, checkpoint).awaitTermination()
    assert table.versions() == before


def test_a_batch_rewrites_only_its_buckets(spark, setup):
    log, table, _, _ = setup
    table.apply(0, log)
    first, files = table.files(), listing(table)
    assert len(first) == 8
    one = log.filter("seq = 0").withColumn("seq", F.col("seq") + 100_000)
    assert table.apply(1, one)
    second, after = table.files(), listing(table)
    changed = [b for b in first if first[b] != second[b]]
    assert len(changed) == 1 and second[changed[0]].endswith("_version=2")
    assert {f: after[f] for f in files} == files
    assert all(f.startswith(local(second[changed[0]])) for f in set(after) - set(files))
    table.expire()
    assert set(listing(table)) == {f for b in second for f in glob.glob(f"{local(second[b])}/*.parquet")}
    assert rows(table.read()) == rows(folded(spark, table, log.unionByName(one)))


def test_repeated_and_late_batches_change_nothing(spark, setup):
    log, table, _, _ = setup
    assert table.apply(0, log.filter("seq >= 300"))
    files = listing(table)
    assert not table.apply(0, log)
    assert listing(table) == files
    assert table.apply(1, log.filter("seq < 600"))
    assert rows(table.read()) == rows(folded(spark, table, log))
    now = rows(table.state())
    assert table.apply(2, log.filter("seq < 600"))
    assert rows(table.state()) == now


def test_a_broken_batch_counts_for_nothing_and_runs_again(spark, setup, monkeypatch):
    log, table, _, _ = setup
    table.apply(0, log.filter("seq < 500"))
    before = rows(table.read())

    def lost(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr("relocate.sources.paths.write_text", lost)
        with pytest.raises(OSError):
            table.apply(1, log.filter("seq >= 500"))
    assert rows(table.read()) == before
    table.expire()  # what does not count yet is not touched
    assert table.apply(1, log.filter("seq >= 500"))
    assert rows(table.read()) == rows(folded(spark, table, log))


def test_drift_and_a_second_load_are_refused(spark, setup):
    log, table, _, _ = setup
    with pytest.raises(ValueError, match="drift"):
        table.apply(0, log.withColumnRenamed("c_name", "name"))
    table.load(view(spark, SF_DIR, "snapshot"), seq=-1)
    with pytest.raises(ValueError, match="not empty"):
        table.load(view(spark, SF_DIR, "snapshot"), seq=-1)


def test_repeated_changes_go_and_what_is_remembered_ages_out(spark, tmp_path):
    folder, hour = str(tmp_path / "in"), 3_600_000_000
    schema = "seq long, commit_us long"
    parts = [[(i + 100 * n, (n + 1) * hour + i) for i in range(100)] for n in range(6)]
    states = []
    for part in parts:
        spark.createDataFrame(part + part[:50], schema).coalesce(1).write.mode("append").parquet(folder)
        stream = read_changes(spark, folder, T._parse_datatype_string(schema))
        told = first_of_repeats(stream, "10 minutes").writeStream.format("parquet")
        told = told.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        query = told.trigger(availableNow=True).start()
        query.awaitTermination()
        states.append(max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert rows(found) == rows(spark.createDataFrame([r for part in parts for r in part], schema))
    assert max(states) <= 200


@pytest.mark.parametrize("bounds", [(0, 10_000), (0, 300, 700, 10_000), (0, 1, 2, 650, 651, 10_000)])
def test_milestones_stream_equals_batch(spark, tmp_path, bounds):
    """However the log is cut into batches; every kick is a restart from the checkpoint."""
    log = view(spark, SF_DIR, "phase_log").select("run_id", "seq", "at_us", "phase", "error")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for lower, upper in zip(bounds, bounds[1:]):
        part = log.filter(f"seq >= {lower} AND seq < {upper}")
        part.coalesce(1).write.mode("append").parquet(folder)
        stream = read_changes(spark, folder, log.schema)
        milestone_stream(stream, out, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(f"{out}/batch=*")
    want = lifecycle.milestones(log)
    assert rows(got.select(*want.columns)) == rows(want)


def test_late_phase_rows_are_kept_apart(spark, tmp_path):
    log = view(spark, SF_DIR, "phase_log").select("run_id", "seq", "at_us", "phase", "error")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    tardy = log.filter("seq % 7 = 3 AND seq < 500")
    for part in (log.exceptAll(tardy), tardy):
        part.coalesce(1).write.mode("append").parquet(folder)
        stream = read_changes(spark, folder, log.schema)
        milestone_stream(stream, out, str(tmp_path / "cp")).awaitTermination()
    kept = spark.read.parquet(f"{out}-late/batch=*").select(*log.columns)
    newest = log.exceptAll(tardy).groupBy("run_id").agg({"seq": "max"}).toDF("run_id", "newest")
    late = tardy.join(newest, "run_id").filter("seq <= newest").drop("newest")
    assert rows(kept) == rows(late.select(*log.columns)) and late.count() > 0


def test_a_run_that_stops_is_told_once(spark, tmp_path):
    minute = 60_000_000
    schema = "run_id long, tick long, obs_us long, phase string"
    kicks = [
        [(1, 1, 1, "copying"), (2, 1, 1, "replicating"), (3, 1, 1, "completed")],
        [(1, 2, 5 * minute, "copying"), (2, 2, 5 * minute, "replicating")],
        # Run 2 stops looking after five minutes, run 1 goes on.
        [(1, i, i * 3 * minute, "copying") for i in range(3, 9)],
        [(1, 9, 27 * minute, "copying"), (2, 3, 27 * minute, "replicating")],
        [(1, 10, 60 * minute, "completed")],
        [(1, 11, 120 * minute, "completed")],
    ]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for kick in kicks:
        spark.createDataFrame(kick, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = read_changes(spark, folder, T._parse_datatype_string(schema))
        silence_stream(stream, out, str(tmp_path / "cp")).awaitTermination()
    found = sorted(tuple(r) for r in spark.read.parquet(f"{out}/batch=*").select("run_id", "tick", "silent_from_us").collect())
    assert (2, 2, 15 * minute) in found and (2, 3, 37 * minute) in found
    assert [f for f in found if f[0] == 3] == []
    assert len(found) == len(set(found))
