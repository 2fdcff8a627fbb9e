"""Checks that decide whether tables can be replicated, over catalogs of many databases."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.functions.text import is_user_schema
from relocate.session import settle
from relocate.sources import paths

TABLE = ["db_id", "schema_name", "table_name"]

FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
    T.DecimalType: 16,
}


def union_all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def tables_without_key(
    tables: DataFrame, indexes: DataFrame, public_only: bool = False
) -> DataFrame:
    """Tables with neither a primary key nor any unique index (nullable columns allowed).

    A table is known by database, schema and name: equal names in two schemas never meet.
    """
    if public_only:
        tables = tables.filter(F.col("schema_name") == "public")
    usable = indexes.filter(F.col("is_primary") | F.col("is_unique")).select(*TABLE)
    return tables.join(usable, TABLE, "left_anti").select(*TABLE)


def generated_columns(columns: DataFrame, replicator_schema: str | None = None) -> DataFrame:
    """``db_id, table_name, columns`` of every table with generated columns.

    Tables outside ``public`` are schema-qualified, so equal names do not collide. Names come
    in column order, each once. A list is at most as long as a table is wide.
    """
    shown = F.when(F.col("schema_name") == "public", F.col("table_name")).otherwise(
        F.concat_ws(".", "schema_name", "table_name")
    )
    in_order = F.sort_array(F.collect_list(F.struct("pos", "column_name")))["column_name"]
    return (
        columns.filter("is_generated")
        .filter(is_user_schema(F.col("schema_name"), replicator_schema))
        .groupBy("db_id", shown.alias("table_name"))
        .agg(F.array_distinct(in_order).alias("columns"))
    )


def preflight_gate(
    tables: DataFrame, indexes: DataFrame, columns: DataFrame, public_only: bool = False
) -> DataFrame:
    """One verdict per database: start only if every table has a key.

    Counts only. The names are the rows of :func:`preflight_findings` with the same
    ``public_only``, which stay rows however many tables one database has.
    """
    keyed = (
        indexes.filter(F.col("is_primary") | F.col("is_unique"))
        .groupBy(*TABLE)
        .agg(F.lit(True).alias("_keyed"))
    )
    judged = F.lit(True) if not public_only else F.col("schema_name") == "public"
    n = F.count(F.lit(1))
    all_tables = (
        tables.join(keyed, TABLE, "left")
        .groupBy("db_id")
        .agg(
            n.alias("tables"),
            F.count_if(F.col("_keyed").isNull() & judged).alias("tables_without_key"),
        )
    )
    generated = (
        columns.filter("is_generated")
        .filter(is_user_schema(F.col("schema_name")))
        .select("db_id", "schema_name", "table_name")
        .distinct()
        .groupBy("db_id")
        .agg(n.alias("tables_with_generated_columns"))
    )
    zero = F.lit(0)
    return (
        all_tables.join(generated, "db_id", "left")
        .select(
            "db_id",
            "tables",
            "tables_without_key",
            F.coalesce("tables_with_generated_columns", zero).alias(
                "tables_with_generated_columns"
            ),
        )
        .withColumn("all_tables_valid", F.col("tables_without_key") == 0)
    )


def preflight_findings(
    tables: DataFrame, indexes: DataFrame, columns: DataFrame, public_only: bool = False
) -> DataFrame:
    """The names behind the verdict as rows: ``db_id, finding, table_name, columns``.

    ``no_key`` blocks the start; ``generated_columns`` only informs.
    """
    shown = F.when(F.col("schema_name") == "public", F.col("table_name")).otherwise(
        F.concat_ws(".", "schema_name", "table_name")
    )
    no_key = tables_without_key(tables, indexes, public_only).select(
        "db_id",
        F.lit("no_key").alias("finding"),
        shown.alias("table_name"),
        F.lit(None).cast("string").alias("columns"),
    )
    generated = generated_columns(columns).select(
        "db_id",
        F.lit("generated_columns").alias("finding"),
        "table_name",
        F.array_join("columns", ",").alias("columns"),
    )
    return no_key.unionByName(generated)


def _null_in(keys: list[str]) -> Column:
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    return any_null


def _copies(rows: DataFrame, candidates: list[list[str]]) -> list[DataFrame]:
    """Rows per key of every candidate: a key whose columns are in a larger one is counted from it."""
    counted: dict[int, DataFrame] = {}
    for i in sorted(range(len(candidates)), key=lambda i: -len(set(candidates[i]))):
        wider = [j for j in counted if set(candidates[i]) < set(candidates[j])]
        held, number = rows, F.count(F.lit(1))
        if wider:
            held, number = counted[min(wider, key=lambda j: len(candidates[j]))], F.sum("_n")
        counted[i] = held.groupBy(*candidates[i]).agg(number.alias("_n"))
    return [counted[i] for i in range(len(candidates))]


def key_violations(tables: Mapping[str, tuple[DataFrame, list[list[str]]]]) -> DataFrame:
    """Does a declared key identify rows? Per key: rows, duplicate groups, rows in them, null keys.

    Nested keys of a table share one count of its rows.
    """
    parts = []
    for name, (rows, candidates) in tables.items():
        for keys, copies in zip(candidates, _copies(rows, candidates), strict=True):
            any_null = _null_in(keys)
            repeated = (F.col("_n") > 1) & ~any_null
            parts.append(
                copies.agg(
                    F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
                    F.count_if(repeated).alias("duplicate_groups"),
                    F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0)).alias(
                        "duplicate_rows"
                    ),
                    F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).alias(
                        "null_key_rows"
                    ),
                ).select(
                    F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key"), "*"
                )
            )
    return union_all(parts)


#: Size of a sketch (its binary logarithm) and the standard deviations it is trusted within.
SKETCH_BITS = 14
SKETCH_TRUST = 6.0


def key_sketches(rows: DataFrame, candidates: list[list[str]]) -> DataFrame:
    """``key, rows, null_key_rows, distinct``, a row per candidate: one scan for all of them.

    ``distinct`` is the estimate of a sketch over the rows without a null in the key.
    """
    parts = []
    for keys in candidates:
        full = F.when(~_null_in(keys), F.xxhash64(*keys))
        parts.append(
            F.struct(
                F.lit(",".join(keys)).alias("key"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(_null_in(keys)).alias("null_key_rows"),
                F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(full, SKETCH_BITS)), F.lit(0)).alias("distinct"),
            )
        )
    return rows.agg(F.array(*parts).alias("_keys")).select(F.inline("_keys"))


def candidate_keys(tables: Mapping[str, tuple[DataFrame, list[list[str]]]]) -> DataFrame:
    """Which of many candidate keys identify rows: ``table_name, key, rows, null_key_rows, unique``.

    A key that a sketch puts six standard deviations below the number of rows has repeats; only
    the others are counted exactly. Rows with a null in the key are left out of the question.
    """
    trust = 1 - SKETCH_TRUST * 1.04 / 2 ** (SKETCH_BITS / 2)
    parts = []
    for name, (rows, candidates) in tables.items():
        told = settle(key_sketches(rows, candidates), "sketches")
        open_keys = told.filter("distinct > 0").filter(F.col("distinct") >= (F.col("rows") - F.col("null_key_rows")) * trust)
        names = {r.key for r in open_keys.select("key").collect()}  # at most the candidates
        maybe = [keys for keys in candidates if ",".join(keys) in names]
        verdict = F.col("rows") == F.col("null_key_rows")
        if maybe:
            exact = key_violations({name: (rows, maybe)}).select("key", (F.col("duplicate_groups") == 0).alias("_unique"))
            told = told.join(settle(exact, "counted"), "key", "left")
            verdict = F.coalesce("_unique", verdict)
        parts.append(
            told.select(F.lit(name).alias("table_name"), "key", "rows", "null_key_rows", verdict.alias("unique"))
        )
    return union_all(parts)


def _width(kind: T.DataType, value: Column) -> Column:
    """Bytes of a value; nested values are the sum of what they hold, nulls nothing."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        width = F.octet_length(value).cast("bigint")
    elif isinstance(kind, T.ArrayType) and type(kind.elementType) in FIXED_WIDTH:
        held = F.size(F.filter(value, lambda x: x.isNotNull())) if kind.containsNull else F.size(value)
        width = held.cast("bigint") * FIXED_WIDTH[type(kind.elementType)]
    elif isinstance(kind, T.ArrayType):
        sizes = F.transform(value, lambda x: _width(kind.elementType, x))
        width = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, b: a + b)
    elif isinstance(kind, T.MapType):
        parts = [
            _width(T.ArrayType(kind.keyType), F.map_keys(value)),
            _width(T.ArrayType(kind.valueType), F.map_values(value)),
        ]
        width = parts[0] + parts[1]
    elif isinstance(kind, T.StructType):
        width = F.lit(0).cast("bigint")
        for field in kind.fields:
            width = width + _width(field.dataType, value[field.name])
    elif type(kind) in FIXED_WIDTH:
        width = F.lit(FIXED_WIDTH[type(kind)]).cast("bigint")
    else:
        raise TypeError(f"no size is known for {kind.simpleString()}")
    return F.coalesce(F.when(value.isNotNull(), width), F.lit(0)).cast("bigint")


def relation_size(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and value bytes per table, and a total row with a null table name.

    Strings count their UTF-8 bytes, other types their width, nested values what they hold,
    nulls nothing. This reads every value; :func:`relation_files` does not.
    """
    parts = []
    for name, rows in tables.items():
        size = F.lit(0).cast("bigint")
        for field in rows.schema.fields:
            size = size + _width(field.dataType, F.col(field.name))
        parts.append(
            rows.agg(
                F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")
            ).select(F.lit(name).alias("table_name"), "*")
        )
    return (
        union_all(parts)
        .rollup("table_name")
        .agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    )


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """``path, length`` of the files below a path, from the listing; no file is opened.

    Files without rows count; files without a single byte, which hold no table, are not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.load(path).select("path", "length")


def relation_folders(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """``table_name, folder, files, bytes`` per folder of tables stored as files.

    ``folder`` is relative to the table's path; '' is the path itself.
    """
    parts = []
    for name, path in tables.items():
        inside = F.substring("path", len(paths.qualified(spark, path)) + 2, 2**31 - 1)
        rows = _listed(spark, path).withColumn("folder", F.regexp_replace(inside, "/?[^/]*$", ""))
        folders = rows.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        parts.append(folders.select(F.lit(name).alias("table_name"), "*"))
    return union_all(parts)


def relation_files(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Files and stored bytes per table stored as files, and a total row with a null name."""
    parts = [
        _listed(spark, path)
        .agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        .select(F.lit(name).alias("table_name"), "*")
        for name, path in tables.items()
    ]
    return (
        union_all(parts)
        .rollup("table_name")
        .agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))
    )


def object_diff(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Every object with ``only_source``, ``only_target`` or ``both``: one shuffle, no join."""
    sides = source.select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target.select(*keys, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    where = (
        F.when(F.col("_s") + F.col("_t") == 2, "both")
        .when(F.col("_s") == 1, "only_source")
        .otherwise("only_target")
    )
    return (
        sides.groupBy(*keys)
        .agg(F.max("_s").alias("_s"), F.max("_t").alias("_t"))
        .select(*keys, where.alias("side"))
    )


def invalid_encoding(tables: Mapping[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Rows whose text is not valid UTF-8: ``table_name, column_name, bad_rows, first_key``.

    Maps a table to its rows, key column and text columns (binary, or strings read as such). A
    table is read once for all its columns.
    """
    parts = []
    for name, (rows, key, columns) in tables.items():
        found = []
        for column in columns:
            bad = ~F.is_valid_utf8(F.col(column).cast("binary"))
            found.append(
                F.struct(
                    F.lit(column).alias("column_name"),
                    F.count_if(bad).alias("bad_rows"),
                    F.min(F.when(bad, F.col(key))).cast("string").alias("first_key"),
                )
            )
        told = rows.agg(F.array(*found).alias("_found"))
        parts.append(told.select(F.lit(name).alias("table_name"), F.inline("_found")))
    return union_all(parts)


def invalid_encoding_keys(rows: DataFrame, key: list[str], column: str) -> DataFrame:
    """The keys of all rows with invalid text."""
    return rows.filter(~F.is_valid_utf8(F.col(column).cast("binary"))).select(*key)
