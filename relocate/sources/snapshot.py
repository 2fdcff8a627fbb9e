"""One-time copy of a group of tables into a fresh version; a manifest makes it visible."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from relocate.sources import paths


def versions(spark: SparkSession, root: str) -> list[int]:
    names = paths.child_names(spark, f"{root}/manifest")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def snapshot_copy(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    jobs: int = 4,
    position: int | None = None,
) -> int:
    """Copy every row of every table; returns the new version.

    ``position`` is the ``seq`` of the last change the tables already hold; it is kept with the
    copy, so that a later run knows where to go on. Row counts are kept as well.

    Nothing points at the files until all tables are written. A copy that broke off left
    no manifest, and running again starts over in another folder, so no row doubles. Tables
    are copied ``jobs`` at a time, each as one distributed job.
    """
    attempt = uuid.uuid4().hex

    def copy(item: tuple[str, DataFrame]) -> dict[str, str | int]:
        name, rows = item
        path = f"{root}/data/{attempt}/{name}"
        rows.write.parquet(path)
        count = spark.read.schema(rows.schema).parquet(path).count()
        return {"table": name, "path": path, "schema": rows.schema.json(), "rows": count}

    with ThreadPoolExecutor(max_workers=jobs) as pool:
        entries = list(pool.map(copy, tables.items()))
    version = max(versions(spark, root), default=0) + 1
    paths.write_text(spark, f"{root}/manifest/{version}.json", json.dumps({"position": position, "tables": entries}))
    return version


def _manifest(spark: SparkSession, root: str, version: int | None) -> dict:
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(f"no finished copy under {root}")
    chosen = known[-1] if version is None else version
    return json.loads(paths.read_text(spark, f"{root}/manifest/{chosen}.json"))


def snapshot_position(spark: SparkSession, root: str, version: int | None = None) -> int | None:
    """The ``seq`` a version holds changes up to, the newest version by default."""
    return _manifest(spark, root, version)["position"]


def snapshot_rows(spark: SparkSession, root: str, version: int | None = None) -> dict[str, int]:
    """Rows of each table of a version."""
    return {e["table"]: e["rows"] for e in _manifest(spark, root, version)["tables"]}


def read_snapshot(
    spark: SparkSession, root: str, version: int | None = None
) -> dict[str, DataFrame]:
    """The tables of a version, the newest by default."""
    return {
        e["table"]: spark.read.schema(T.StructType.fromJson(json.loads(e["schema"]))).parquet(
            e["path"]
        )
        for e in _manifest(spark, root, version)["tables"]
    }
