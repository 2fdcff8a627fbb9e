"""File-system look-ups through Hadoop, so that any shared store works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none when it is missing."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path))


def qualified(spark: SparkSession, path: str) -> str:
    """The path as listings print it, with its scheme and without a slash at the end."""
    fs, hadoop_path = _open(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern with ``*`` fits."""
    fs, hadoop_path = _open(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in fs.globStatus(hadoop_path) or [])


def byte_length(spark: SparkSession, path: str) -> int:
    """Stored bytes of a file or folder, from file metadata only."""
    fs, hadoop_path = _open(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote, with all in it."""
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small control file as a string."""
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small control file whole: readers see all of it or none of it."""
    fs, hadoop_path = _open(spark, path)
    _, draft = _open(spark, path + ".draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.rename(draft, hadoop_path):
        raise OSError(f"could not publish {path}")
