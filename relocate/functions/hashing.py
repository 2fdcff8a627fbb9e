"""Row images and hashes that any SQL engine can repeat (md5 over canonical text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(df: DataFrame, column: str) -> Column:
    """Exact text of a value: unequal values never share one.

    Timestamps become epoch micros, strings carry their length so that neighbouring columns
    cannot run together, bytes become hex, nested values JSON, null becomes ``~``.
    """
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp"))
    elif isinstance(kind, T.BinaryType):
        value = F.hex(value)
    elif isinstance(kind, T.MapType):
        # Entries in order of their keys: equal maps have one text however they were built.
        entries = F.array_sort(
            F.map_entries(value), lambda x, y: F.when(x["key"] < y["key"], -1).otherwise(1)
        )
        value = F.to_json(entries, {"ignoreNullFields": "false"})
    elif isinstance(kind, (T.ArrayType, T.StructType)):
        value = F.to_json(value, {"ignoreNullFields": "false"})
    elif isinstance(kind, T.StringType):
        value = F.concat(F.length(value).cast("string"), F.lit(":"), value)
    return F.coalesce(value.cast("string"), F.lit("~"))


def row_text(df: DataFrame, columns: list[str]) -> Column:
    return F.concat_ws("|", *[canonical(df, c) for c in columns])


def hex_number(digest: Column, start: int, digits: int) -> Column:
    """The number that ``digits`` hex digits of a digest spell out."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def key_hash(df: DataFrame, keys: list[str]) -> Column:
    """A 32-bit non-negative hash of the key."""
    return hex_number(F.md5(row_text(df, keys)), 1, 8)
