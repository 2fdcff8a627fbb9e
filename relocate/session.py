"""Session settings and the shared folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on (UTC) and the adaptive ones plans rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, app: str = "relocate", **conf: str) -> SparkSession:
    """A session for tests and benches on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Only a local master may go without it, and then gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="relocate-")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "step") -> DataFrame:
    """Write rows to the shared folder and go on from there: no lineage, nothing computed twice."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
