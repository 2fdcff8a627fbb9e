"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Only documents that share a length and a prefix with another one have their whole text hashed.
Each step is an aggregate with a partial sum in every task, so a length or a text that a third
of all rows share leaves each task as one row. The short tables that come out are written first:
the way back to the rows is then a join of two plain scans, whose large keys Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate.llm.common import fresh_names, lower_ascii, set_aside, whole
from relocate.session import settle

#: Characters of a text that the second step hashes.
PREFIX_CHARS = 64
ADDED = ["keep_id", "group_size", "kept", "n_bytes", "full_hash"]
_STEP = ["_dedup_bytes", "_dedup_prefix"]


def same_text(text: Column) -> Column:
    """Texts are equal when this is: A-Z lower-cased, null as empty."""
    return lower_ascii(whole(text))


def _measured(docs: DataFrame, text: str, prefix_chars: int) -> DataFrame:
    start = F.substring(whole(text), 1, prefix_chars)
    return docs.withColumns(
        {
            "_dedup_bytes": F.octet_length(whole(text)).cast("long"),
            "_dedup_prefix": F.xxhash64(same_text(start)),
        }
    )


def suspects(
    docs: DataFrame, key: str = "doc_id", text: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """Ids, lengths and prefix hashes of rows that share both with another row."""
    narrow = _measured(docs.select(key, text), text, prefix_chars).drop(text)
    lengths = narrow.groupBy("_dedup_bytes").count().filter("count > 1").drop("count")
    narrow = narrow.join(settle(lengths, "lengths"), "_dedup_bytes", "left_semi")
    prefixes = narrow.groupBy(*_STEP).count().filter("count > 1").drop("count")
    prefixes = settle(prefixes, "prefixes")
    return narrow.join(prefixes, _STEP, "left_semi").select(key, *_STEP).distinct()


def identified(
    docs: DataFrame, key: str = "doc_id", text: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """The input with ``n_bytes`` and ``full_hash``, which is null where two steps told the text apart."""
    docs = fresh_names(docs, ADDED)
    found = suspects(docs, key, text, prefix_chars).select(
        F.col(key).alias("_dedup_id"),
        *[F.col(c).alias(f"{c}_2") for c in _STEP],
        F.lit(True).alias("_dedup_suspect"),
    )
    match = F.col(key).eqNullSafe(F.col("_dedup_id"))
    for c in _STEP:
        match &= F.col(c) == F.col(f"{c}_2")
    rows = _measured(docs, text, prefix_chars).join(found, match, "left")
    full = F.sha2(same_text(F.col(text)).cast("binary"), 256)
    return rows.select(
        *docs.columns,
        F.col("_dedup_bytes").alias("n_bytes"),
        F.when(F.col("_dedup_suspect"), full).alias("full_hash"),
    )


def split_groups(rows: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Identified rows that are alone, and the others, both with their group.

    Adds ``keep_id`` (largest id of the equal texts), ``group_size`` and ``kept``.
    """
    alone = rows.filter(F.col("full_hash").isNull()).withColumns(
        {
            "keep_id": F.col(key),
            "group_size": F.lit(1).cast("long"),
            "kept": F.lit(True),
        }
    )
    read = rows.filter(F.col("full_hash").isNotNull())
    groups = read.groupBy("full_hash").agg(
        F.max(key).alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    kept = F.col(key).eqNullSafe(F.col("keep_id"))
    shared = read.join(settle(groups, "groups"), "full_hash").withColumn("kept", kept)
    return alone, shared.select(*alone.columns)


def grouped(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Identified rows with their group; see :func:`split_groups`."""
    alone, shared = split_groups(rows, key)
    return alone.unionByName(shared)


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """Every row with its group of equal texts.

    All input columns and ``n_bytes``, ``full_hash``, ``keep_id``, ``group_size`` and ``kept``;
    input columns of these names are replaced. Null texts are empty texts; null ids sort below
    all others. Rows equal in id and text cannot be told apart and share a verdict.
    """
    return grouped(identified(docs, key, text, prefix_chars), key)


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts: the one with the largest id. All columns stay.

    Rows that repeat both id and text leave one row too.
    """
    docs, own = set_aside(docs, ADDED)
    alone, shared = split_groups(settle(identified(docs, key, text), "identified"), key)
    one = shared.filter("kept").dropDuplicates(["full_hash"])
    return own(alone).unionByName(own(one))
