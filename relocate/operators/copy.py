"""What a copy reads and recomputes: column lists, generated columns, sequences."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.functions.text import is_user_schema, quote_ident


def copy_with_generated(df: DataFrame, generated: Mapping[str, str]) -> DataFrame:
    """Leave generated columns out of the read and compute them again on the copy.

    ``generated`` maps a column to its SQL expression over ordinary columns.
    """
    plain = df.select(*[c for c in df.columns if c not in generated])
    return plain.withColumns({name: F.expr(sql) for name, sql in generated.items()})


def copy_column_list(columns: DataFrame, replicator_schema: str | None = None) -> DataFrame:
    """Per table with generated columns, the column list a copy must select.

    ``columns``: ``db_id, schema_name, table_name, pos, column_name, is_generated``. A table
    whose columns are all generated is marked ``skipped``. One list is at most as long as a
    table is wide, and databases bound that (1,600 columns).
    """
    plain = F.when(
        ~F.col("is_generated"), F.struct(F.col("pos"), quote_ident(F.col("column_name")).alias("c"))
    )
    table = ["db_id", "schema_name", "table_name"]
    own = columns.filter(is_user_schema(F.col("schema_name"), replicator_schema))
    wanted = own.filter("is_generated").select(*table).distinct()
    return (
        own.join(wanted, table, "left_semi")
        .groupBy(*table)
        .agg(F.collect_list(plain).alias("_plain"))
        .select(
            "db_id",
            "schema_name",
            "table_name",
            F.nullif(F.array_join(F.sort_array("_plain")["c"], ", "), F.lit("")).alias("columns"),
            (F.size("_plain") == 0).alias("skipped"),
        )
    )


def sequence_high_water(
    source: Mapping[str, tuple[DataFrame, str]], target: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Per sequence, the value the target must continue from.

    Both sides map a table to its rows and key column; the larger last value wins.
    """
    sides = []
    for side, tables in (("source_last", source), ("target_last", target)):
        for table, (rows, column) in tables.items():
            last = rows.agg(F.max(F.col(column).cast("bigint")).alias("_last"))
            sides.append(
                last.select(F.lit(table).alias("table_name"), F.lit(side).alias("_side"), "_last")
            )
    both = sides[0]
    for one in sides[1:]:
        both = both.unionByName(one)
    return (
        both.groupBy("table_name")
        .agg(
            F.max(F.when(F.col("_side") == "source_last", F.col("_last"))).alias("source_last"),
            F.max(F.when(F.col("_side") == "target_last", F.col("_last"))).alias("target_last"),
        )
        .withColumn(
            "next_value",
            F.coalesce(F.greatest("source_last", "target_last"), F.lit(0)).cast("bigint") + 1,
        )
    )
