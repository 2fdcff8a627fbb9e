"""Text and JSON inputs: status blocks, logs, status and copy-progress documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relocate.functions.text import normalize_table_name, safe_time

STATUS_SCHEMA = (
    "phase string, state string, message string, error string, "
    "started_at string, switched_at string, completed_at string"
)
PROGRESS_SCHEMA = (
    "captured_at string, table_sizes map<string,bigint>, total_tables bigint, "
    "total_bytes bigint, completed_tables array<string>, "
    "history array<struct<ts:string,tables_completed:bigint,copied_bytes:bigint,"
    "rows_changed_last_sync:bigint,last_good_sync:string>>, "
    "last_progress_at string, max_copied_bytes_seen bigint"
)


def read_status_blocks(spark: SparkSession, path: str) -> DataFrame:
    """One row per status file: ``file, block``."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("block")
    )


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, line`` of large log files, read in parallel splits.

    ``line_no`` rises down each file and is unique in it: the byte offset of the split
    plus the line's place in the split. It is an order, not a count from one.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )
    firsts = lines.groupBy("file", "_start").agg(F.min("_id").alias("_first"))
    return lines.join(firsts, ["file", "_start"]).select(
        "file", (F.col("_start") + F.col("_id") - F.col("_first")).alias("line_no"), "line"
    )


def read_status_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATUS_SCHEMA).json(path, multiLine=True)


def read_progress_documents(spark: SparkSession, path: str) -> DataFrame:
    """Copy-progress documents with the file each came from."""
    return (
        spark.read.schema(PROGRESS_SCHEMA)
        .json(path, multiLine=True)
        .withColumn("file", F.col("_metadata.file_path"))
    )


def progress_sizes(documents: DataFrame) -> DataFrame:
    """``file, table_name, source_bytes, completed`` of each progress document."""
    done = F.transform("completed_tables", normalize_table_name)
    return documents.select(
        "file", F.explode("table_sizes").alias("table_name", "source_bytes"), done.alias("_done")
    ).select(
        "file",
        "table_name",
        "source_bytes",
        F.coalesce(F.array_contains("_done", F.col("table_name")), F.lit(False)).alias("completed"),
    )


def progress_history(documents: DataFrame) -> DataFrame:
    """History points as rows: ``file, tick, obs_us, …``."""
    return documents.select("file", F.posexplode("history").alias("tick", "p")).select(
        "file",
        F.col("tick").cast("bigint").alias("tick"),
        F.unix_micros(safe_time(F.col("p.ts"))).alias("obs_us"),
        "p.tables_completed",
        "p.copied_bytes",
        F.col("p.rows_changed_last_sync").alias("rows_changed"),
        F.col("p.last_good_sync").alias("last_good_text"),
    )


def write_documents(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON document per row."""
    df.write.mode(mode).json(path)


def write_document_texts(documents: DataFrame, path: str, column: str = "document", mode: str = "errorifexists") -> None:
    """Documents that are JSON texts already, one per line."""
    documents.select(column).write.mode(mode).text(path)


def read_document_texts(spark: SparkSession, path: str, column: str = "document") -> DataFrame:
    """One JSON text per line, not parsed."""
    return spark.read.text(path).select(F.col("value").alias(column))
