"""A keyed table in hash buckets on plain Parquet; a batch rewrites the buckets it touches.

Rows lie under ``_bucket=<hash of the key>/_version=<batch>``. A batch folds its changes to one row per
key, lays them over the buckets they fall into and writes these buckets anew, by dynamic partition
overwrite, into partitions of its own version; all others stay as they are. A version counts once
its mark is written. So a batch that broke off changes nothing and writes the same partitions when
it runs again, a batch that is repeated finds its mark, and readers keep the files they opened.

Deleted keys stay as rows with their ``seq``, so that late changes lose against them. One writer at
a time, as a streaming query is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.operators.cdc import latest_changes, live_rows, overlay
from relocate.session import settle
from relocate.sources import paths
from relocate.sources.tables import require_schema

BUCKET, VERSION = "_bucket", "_version"


@dataclass(frozen=True)
class BucketedTable:
    """``schema`` covers keys, ``seq``, ``op`` and payload. A bucket of a few GB is a good size."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    payload: tuple[str, ...]
    schema: T.StructType
    buckets: int = 64

    @property
    def columns(self) -> list[str]:
        return [*self.keys, "seq", "op", *self.payload]

    @property
    def _fields(self) -> T.StructType:
        return T.StructType([self.schema[c] for c in self.columns])

    def versions(self) -> list[int]:
        """Versions that count, in order."""
        return sorted(int(n) for n in paths.child_names(self.spark, f"{self.path}/done") if n.isdigit())

    def files(self) -> dict[int, str]:
        """The folder of each bucket's newest version that counts."""
        done, newest = set(self.versions()), {}
        for found in paths.matching(self.spark, f"{self.path}/rows/{BUCKET}=*/{VERSION}=*"):
            bucket, version = (int(part.split("=")[1]) for part in found.split("/")[-2:])
            if version in done and version >= newest.get(bucket, (-1,))[0]:
                newest[bucket] = (version, found)
        return {bucket: folder for bucket, (_, folder) in newest.items()}

    def _scan(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._fields)
        return self.spark.read.schema(self._fields).parquet(*folders)

    def state(self) -> DataFrame:
        """The last change of each key, deletes included."""
        return self._scan(list(self.files().values()))

    def read(self) -> DataFrame:
        return live_rows(self.state(), list(self.keys), list(self.payload))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, version: int) -> None:
        placed = rows.select(*self.columns, self._bucket().alias(BUCKET), F.lit(version).alias(VERSION))
        # Even files per bucket: large buckets are split, small ones share a task.
        writer = placed.hint("rebalance", BUCKET).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, VERSION)
        writer.parquet(f"{self.path}/rows")
        paths.write_text(self.spark, f"{self.path}/done/{version}", "")

    def load(self, rows: DataFrame, seq: int) -> None:
        """Start from a snapshot that holds all changes up to ``seq``."""
        if self.versions():
            raise ValueError("the table is not empty")
        held = [F.lit(seq).cast("bigint").alias("seq"), F.lit("I").alias("op")]
        self._write(rows.select(*self.keys, *held, *self.payload), 0)

    def applied(self, batch: int) -> bool:
        return batch + 1 in self.versions()

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Lay the changes of a batch over the table; false if the batch was applied before.

        Of the changes and what is held of a key the largest ``seq`` counts.
        """
        if self.applied(batch):
            return False
        keys = list(self.keys)
        changes = require_schema(changes, self._fields)
        folded = latest_changes(changes, keys, list(self.payload)).select(*self.columns)
        last = settle(folded.withColumn(BUCKET, self._bucket()), "batch")
        # Numbers of buckets, at most as many as there are buckets.
        touched = {r[0] for r in last.select(BUCKET).distinct().collect()}
        held = self._scan([folder for bucket, folder in self.files().items() if bucket in touched])
        self._write(overlay(held, last.drop(BUCKET), keys), batch + 1)
        return True

    def expire(self) -> None:
        """Remove what newer versions have replaced; no reader may still have it open."""
        kept, done = set(self.files().values()), set(self.versions())
        for found in paths.matching(self.spark, f"{self.path}/rows/{BUCKET}=*/{VERSION}=*"):
            if found not in kept and int(found.split("=")[-1]) in done:
                paths.delete(self.spark, found)
