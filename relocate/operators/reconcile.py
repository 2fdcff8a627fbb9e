"""Prove that source and target hold the same rows: counts, samples, fingerprints, diffs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relocate.functions.hashing import canonical, hex_number, key_hash, row_text
from relocate.operators.preflight import union_all
from relocate.session import settle


def reconcile_counts(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, source_rows, target_rows, delta`` of tables on either side."""
    parts = [
        rows.agg(F.count(F.lit(1)).alias("_n")).select(
            F.lit(name).alias("table_name"), F.lit(side).alias("_side"), "_n"
        )
        for side, tables in (("source", source), ("target", target))
        for name, rows in tables.items()
    ]

    def on(side: str):
        return F.max(F.when(F.col("_side") == side, F.col("_n")))

    return (
        union_all(parts)
        .groupBy("table_name")
        .agg(on("source").alias("source_rows"), on("target").alias("target_rows"))
        .withColumn(
            "delta",
            F.coalesce("target_rows", F.lit(0)) - F.coalesce("source_rows", F.lit(0)),
        )
    )


def reconcile_diff(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose rows differ: ``keys…, difference`` (missing, extra or changed) and row counts.

    Row images are counted with a sign per side and equal ones cancel, first inside each
    task and then once across the shuffle. No join, so copies of one key are never paired.
    """
    def signed(side: DataFrame, sign: int) -> DataFrame:
        image = F.md5(row_text(side, sorted(source.columns)))
        return side.select(*keys, image.alias("_image"), F.lit(sign).alias("_sign"))

    unequal = (
        signed(source, 1)
        .unionByName(signed(target, -1))
        .groupBy(*keys, "_image")
        .agg(F.sum("_sign").alias("_net"))
        .filter(F.col("_net") != 0)
    )
    missing, extra = F.col("rows_missing"), F.col("rows_extra")
    return (
        unequal.groupBy(*keys)
        .agg(
            F.sum(F.greatest("_net", F.lit(0))).alias("rows_missing"),
            F.sum(F.greatest(-F.col("_net"), F.lit(0))).alias("rows_extra"),
        )
        .select(
            *keys,
            F.when(extra == 0, "missing")
            .when(missing == 0, "extra")
            .otherwise("changed")
            .alias("difference"),
            "rows_missing",
            "rows_extra",
        )
    )


def in_sample(df: DataFrame, keys: list[str], one_in: int) -> DataFrame:
    """Rows whose key hashes into the sample; both sides pick the same keys."""
    return df.filter(F.pmod(key_hash(df, keys), F.lit(one_in)) == 0)


def reconcile_sample(
    source: DataFrame, target: DataFrame, keys: list[str], one_in: int = 10
) -> DataFrame:
    """Differences among one in ``one_in`` keys, chosen by a hash of the key."""
    return reconcile_diff(
        in_sample(source, keys, one_in), in_sample(target, keys, one_in), keys
    )


def fingerprints(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Per key bucket, the row count and the sum of 48-bit row hashes."""
    value = hex_number(F.md5(row_text(df, sorted(df.columns))), 1, 12).cast("decimal(20,0)")
    return (
        df.select(F.pmod(key_hash(df, keys), F.lit(buckets)).alias("bucket"), value.alias("_v"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("_v").cast("string").alias("fingerprint"))
    )


def reconcile_fingerprint(
    source: DataFrame, target: DataFrame, keys: list[str], buckets: int = 256
) -> DataFrame:
    """Both sides' buckets next to each other with ``equal``."""
    left = fingerprints(source, keys, buckets).toDF("bucket", "source_rows", "source_print")
    right = fingerprints(target, keys, buckets).toDF("bucket", "target_rows", "target_print")
    same = F.col("source_rows").eqNullSafe(F.col("target_rows")) & F.col(
        "source_print"
    ).eqNullSafe(F.col("target_print"))
    return left.join(right, "bucket", "full_outer").withColumn("equal", same)


def plain_values(df: DataFrame, columns: list[str]) -> list[Column]:
    """Values to hash, with marks for nulls, which the hash would pass over."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    nested = (T.MapType, T.VariantType)
    values = [canonical(df, c) if isinstance(kinds[c], nested) else F.col(c) for c in columns]
    return [*values, *[F.col(c).isNull() for c in columns]]


def reconcile_unequal_buckets(
    source: DataFrame, target: DataFrame, keys: list[str], buckets: int = 256
) -> DataFrame:
    """The row diff, looked for only in buckets whose fingerprints differ.

    Worth it when little differs; when most buckets do, :func:`reconcile_diff` alone is faster.
    A first pass sums 64-bit row hashes per bucket, which any task folds on its own; the images
    that prove a difference are made for suspects alone.
    The list of unequal buckets is written first: Spark then knows its size and, while it is
    small, broadcasts it, so that neither table is shuffled before its equal buckets are gone.
    """
    columns = sorted(source.columns)

    def bucketed(side: DataFrame) -> DataFrame:
        return side.withColumn("_bucket", F.pmod(F.xxhash64(*plain_values(side, keys)), F.lit(buckets)))

    def summed(side: DataFrame, sign: int) -> DataFrame:
        image = F.xxhash64(*plain_values(side, columns)).cast("decimal(20,0)")
        return bucketed(side).select("_bucket", (image * sign).alias("_v"), F.lit(sign).alias("_n"))

    sums = summed(source, 1).unionByName(summed(target, -1)).groupBy("_bucket")
    sums = sums.agg(F.sum("_v").alias("_v"), F.sum("_n").alias("_n"))
    unequal = settle(sums.filter("_v <> 0 or _n <> 0").select("_bucket"), "buckets")

    def suspects(side: DataFrame) -> DataFrame:
        return bucketed(side).join(unequal, "_bucket", "left_semi").drop("_bucket")

    return reconcile_diff(suspects(source), suspects(target), keys)
