"""What the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of one Arrow batch: bounds what a Python worker holds when texts are long.
BATCH_BYTES = "2m"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The whole ``documents`` table, or some of its columns."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(*columns) if columns else docs


def whole(text: str | Column) -> Column:
    """A text, with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Runs of characters other than the six separators, in order; none for a blank text."""
    trimmed = F.btrim(whole(text), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN)
    )


def row_key(text: Column) -> Column:
    """Tells rows with the same ``doc_id`` apart by their text."""
    return F.xxhash64(F.octet_length(whole(text)), whole(text))


def in_batches(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` with small batches, so that long texts do not pile up in a worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(work, schema)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def batch(**columns) -> pa.RecordBatch:
    """A record batch from named arrays or Arrow arrays."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()],
        names=list(columns),
    )


def unsigned_less(a: Column, b: Column) -> Column:
    """Order of two longs read as unsigned numbers."""
    sign = F.lit(np.iinfo(np.int64).min).cast("long")
    return a.bitwiseXOR(sign) < b.bitwiseXOR(sign)


def sample_class(doc_id: Column) -> Column:
    """The fold of a document: crc32 of its id as text, modulo 3. Fold 1 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def fresh_names(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns that an operator is about to add under the same name, in any case."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rename input columns that an operator would replace, and how to get the input's columns back."""
    columns, taken = df.columns, {n.lower() for n in names}
    held = {c: f"_own_{c}" for c in columns if c.lower() in taken}

    def back(found: DataFrame) -> DataFrame:
        return found.select(*[F.col(f"`{held.get(c, c)}`").alias(c) for c in columns])

    return df.withColumnsRenamed(held), back
