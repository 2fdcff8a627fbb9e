"""A copy of a table with digests beside it, and diffs that read only where digests differ.

A row's place is the hash of its key as hex digits. Rows lie in one folder per first digits, sorted
by place. Beside them lies a tree of digests: for the whole table and for every prefix of a place
down to ``depth`` digits, the number of rows and the sum of their hashes, from one ``rollup``. Two
copies are compared from the root: only prefixes below unequal ones are looked at, and rows are
read from the folders of unequal leaves alone. A side that did not change keeps its digests and is
not read again for them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.operators.reconcile import plain_values, reconcile_diff
from relocate.session import settle

PLACE, FOLDER = "_place", "_folder"


@dataclass(frozen=True)
class Digested:
    """Where a copy lies: its rows under ``rows``, its digests under ``digests``, and how it is cut.

    ``depth`` digits of a place have digests, 16 times as many with each; ``folder_digits`` of them
    name a folder. A folder of some GB is a good size, and a leaf of some thousand rows.
    """

    path: str
    keys: tuple[str, ...]
    schema: T.StructType
    depth: int
    folder_digits: int

    @property
    def rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def digests(self) -> str:
        return f"{self.path}/digests"

    def tree(self, spark: SparkSession, depth: int) -> DataFrame:
        """``prefix, rows, digest`` of all prefixes of ``depth`` digits; other depths are not read."""
        tree = spark.read.schema("prefix string, rows long, digest decimal(38,0), depth int").parquet(self.digests)
        return tree.filter(F.col("depth") == depth).drop("depth")

    def read(self, spark: SparkSession, folders: list[str] | None = None) -> DataFrame:
        """All rows, or those of some folders, with their place."""
        schema = T.StructType([*self.schema.fields, T.StructField(PLACE, T.StringType())])
        reader = spark.read.schema(schema)
        if folders is None:
            return reader.parquet(self.rows)
        if not folders:
            return spark.createDataFrame([], schema)
        return reader.parquet(*[f"{self.rows}/{FOLDER}={f}" for f in folders])


def _place(df: DataFrame, keys: list[str]) -> Column:
    return F.lower(F.lpad(F.hex(F.xxhash64(*plain_values(df, keys))), 16, "0"))


def digest_tree(placed: DataFrame, columns: list[str], depth: int) -> DataFrame:
    """``prefix, rows, digest, depth``: leaves are folded in each task, then rolled up digit by digit."""
    image = F.xxhash64(*plain_values(placed, sorted(columns))).cast("decimal(20,0)")
    leaves = placed.groupBy(F.substring(PLACE, 1, depth).alias("_leaf")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(image).alias("_sum")
    )
    digits = [F.substring("_leaf", i + 1, 1).alias(f"_d{i}") for i in range(depth)]
    rolled = leaves.rollup(*digits).agg(F.sum("_n").alias("rows"), F.sum("_sum").cast("decimal(38,0)").alias("digest"))
    names = [F.col(f"_d{i}") for i in range(depth)]
    known = sum((name.isNotNull().cast("int") for name in names), F.lit(0))
    return rolled.select(F.concat_ws("", *names).alias("prefix"), "rows", "digest", known.alias("depth"))


def write_digested(
    df: DataFrame, keys: list[str], path: str, depth: int = 4, folder_digits: int = 2
) -> Digested:
    """Copy a table with its digests. The digests are those of the rows as they were written.

    Rows of one key share a folder; the files of a folder are split where it is large, so a key
    that very many rows have is no single task.
    """
    if not 0 < folder_digits <= depth <= 16:
        raise ValueError("folder_digits must lie between 1 and depth, depth at most 16")
    spark, place = df.sparkSession, _place(df, keys)
    copy = Digested(path.rstrip("/"), tuple(keys), df.schema, depth, folder_digits)
    placed = df.withColumns({PLACE: place, FOLDER: F.substring(place, 1, folder_digits)})
    laid_out = placed.hint("rebalance", FOLDER).sortWithinPartitions(FOLDER, PLACE)
    laid_out.write.partitionBy(FOLDER).parquet(copy.rows)
    tree = digest_tree(copy.read(spark), df.columns, depth)
    tree.repartition("depth").write.partitionBy("depth").parquet(copy.digests)
    return copy


def unequal_prefixes(source: Digested, target: Digested, spark: SparkSession) -> DataFrame | None:
    """``prefix``: the leaves whose digests differ, found from the root down; None if nothing does."""
    if (source.depth, source.folder_digits, source.keys) != (target.depth, target.folder_digits, target.keys):
        raise ValueError("both copies must be cut alike")
    found = None
    for depth in range(source.depth + 1):
        left, right = (
            side.tree(spark, depth).select("prefix", F.struct("rows", "digest").alias(name))
            for side, name in ((source, "s"), (target, "t"))
        )
        if found is not None:
            parent = F.substring("prefix", 1, depth - 1)
            left, right = (
                x.withColumn("_up", parent).join(found.withColumnRenamed("prefix", "_up"), "_up", "left_semi").drop("_up")
                for x in (left, right)
            )
        differ = left.join(right, "prefix", "full").filter(~F.col("s").eqNullSafe(F.col("t")))
        found = settle(differ.select("prefix"), "unequal")
        if found.isEmpty():
            return None
    return found


def suspects(source: Digested, target: Digested, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Rows of both sides below unequal leaves. Only their folders are opened.

    The driver holds names of folders, at most ``16 ** folder_digits``, whatever the tables hold.
    """
    leaves = unequal_prefixes(source, target, spark)
    if leaves is None:
        return tuple(side.read(spark, []).drop(PLACE) for side in (source, target))
    names = leaves.select(F.substring("prefix", 1, source.folder_digits).alias(FOLDER)).distinct()
    folders = sorted(r[0] for r in names.collect())
    out = []
    for side in (source, target):
        held = side.tree(spark, side.folder_digits).select("prefix").filter(F.col("prefix").isin(folders))
        rows = side.read(spark, sorted(r[0] for r in held.collect()))
        leaf = F.substring(PLACE, 1, side.depth)
        rows = rows.join(leaves, leaf == F.col("prefix"), "left_semi")
        out.append(rows.drop(PLACE))
    return out[0], out[1]


def reconcile_tree(source: Digested, target: Digested, spark: SparkSession) -> DataFrame:
    """The row diff of two digested copies; see :func:`~relocate.operators.reconcile.reconcile_diff`.

    Equal digests of a leaf stand for equal rows: 64-bit hashes of rows summed, and their number.
    """
    left, right = suspects(source, target, spark)
    return reconcile_diff(left, right, list(source.keys))
