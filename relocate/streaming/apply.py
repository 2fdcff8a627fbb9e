"""Streaming apply of a change log, milestones of a phase log, and runs that fall silent."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from relocate import fixed
from relocate.operators.lifecycle import milestones_of
from relocate.streaming.buckets import BucketedTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_changes(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000
) -> DataFrame:
    """A growing folder of Parquet files as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def _start(writer, interval: str | None) -> StreamingQuery:
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def first_of_repeats(
    changes: DataFrame, delay: str, at: str = "commit_us", names: tuple[str, ...] = ("seq",)
) -> DataFrame:
    """Drop changes that came before, where ``names`` agree and no more than ``delay`` lies between.

    What the stream remembers of a change ages out with the watermark, so state does not grow with
    the log. The watermark also drops any change committed more than ``delay`` before the newest
    one of earlier batches: choose ``delay`` above the disorder of the log, or leave this step out;
    a table that changes are applied to ignores repeats by itself.
    """
    timed = changes.withColumn("_at", F.timestamp_micros(at)).withWatermark("_at", delay)
    return timed.dropDuplicatesWithinWatermark(list(names)).drop("_at")


def apply_stream(
    changes: DataFrame, table: BucketedTable, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keep ``table`` up to date with a change stream.

    Without ``interval`` this is one kick: it drains what is queued and ends. Not kicking is
    the pause; the log keeps filling, and the next kick goes on from the checkpoint.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch_id, batch.select(*table.columns))

    return _start(changes.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint), interval)


class PhaseBefore(StatefulProcessor):
    """Per run, the newest ``seq`` and its phase; rows leave with the phase before them.

    Rows of one run and batch are sorted here; a batch is as large as its files.
    """

    def init(self, handle) -> None:
        self.newest = handle.getValueState("newest", "seq long, phase string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen = self.newest.get() if self.newest.exists() else None
        last, before = seen or (None, None)
        for r in sorted(rows, key=lambda r: r.seq):
            late = last is not None and r.seq <= last
            yield Row(**r.asDict(), _before=None if late else before, _late=late)
            if not late:
                last, before = r.seq, r.phase
        if last is not None:
            self.newest.update((last, before))

    def close(self) -> None:
        pass


def milestone_stream(
    log: DataFrame, out: str, checkpoint: str, interval: str | None = None, late: str | None = None
) -> StreamingQuery:
    """Write milestones of ``run_id, seq, at_us, phase, error`` rows to ``out``, a folder per batch.

    A row whose ``seq`` is not above the last one seen of its run came late: milestones told since
    then would have to be taken back, so it goes to ``late`` (``out`` with ``-late`` unless named) as
    it is, and the batch operator over the whole log tells what it means. What a run was last seen
    in is state of the stream. A batch that runs again writes the same folder again.
    """
    names = ["run_id", "seq", "at_us", "phase", "error"]
    spark = log.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = log.select(*names)
    schema = T.StructType([*rows.schema.fields, T.StructField("_before", T.StringType()), T.StructField("_late", T.BooleanType())])
    prior = rows.groupBy("run_id").transformWithState(PhaseBefore(), schema, "append", "none")

    def work(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            tardy = held.filter("_late").select(*names)
            tardy.write.mode("overwrite").parquet(f"{late or out + '-late'}/batch={batch_id}")
            told = milestones_of(held.filter("not _late"))
            told.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        finally:
            held.unpersist()

    return _start(prior.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint), interval)


class Silence(StatefulProcessor):
    """Per run, the newest look; a timer fires when no other look follows it in time."""

    def __init__(self, minutes: float):
        self.wait_ms = int(minutes * 60_000)

    def init(self, handle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "tick long, obs_us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = max(rows, key=lambda r: r.tick)
        if self.newest.exists() and self.newest.get()[0] >= newest.tick:
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.newest.update((newest.tick, newest.obs_us))
        if newest.phase in fixed.LIVE_PHASES:
            self.handle.registerTimer(newest.obs_us // 1000 + self.wait_ms)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        tick, obs_us = self.newest.get()
        yield Row(run_id=key[0], tick=tick, obs_us=obs_us, silent_from_us=expiredTimerInfo.getExpiryTimeInMs() * 1000)

    def close(self) -> None:
        pass


def silence_stream(
    looks: DataFrame,
    out: str,
    checkpoint: str,
    minutes: float = fixed.STALL_MINUTES,
    delay: str = "0 seconds",
    interval: str | None = None,
) -> StreamingQuery:
    """Write ``run_id, tick, obs_us, silent_from_us`` of runs that no look came from for ``minutes``.

    The batch measure sees a stall when a look says so; this one needs no look. Time is that of the
    looks of all runs, ``delay`` behind the newest. A run is told once per silence, and only if its
    last look had it copying or replicating.
    """
    spark = looks.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = looks.select("run_id", "tick", "obs_us", "phase", F.timestamp_micros("obs_us").alias("_at"))
    schema = "run_id long, tick long, obs_us long, silent_from_us long"
    silent = timed.withWatermark("_at", delay).groupBy("run_id").transformWithState(
        Silence(minutes), schema, "append", "eventTime"
    )

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return _start(silent.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint), interval)
