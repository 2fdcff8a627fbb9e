"""Capacity plan for a fleet of databases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate import fixed

KB_PER_GB = 1024 * 1024


def app_tier(size_gb: Column, rows: Column, tables: Column) -> Column:
    (smallest, _), (small, below), (medium, up_to), (large, _) = fixed.APP_TIERS
    tiny = (rows < fixed.SMALLEST_TIER_ROWS) & (tables < fixed.SMALLEST_TIER_TABLES)
    return (
        F.when((size_gb < below) & tiny, smallest)
        .when(size_gb < below, small)
        .when(size_gb <= up_to, medium)
        .otherwise(large)
    )


def instance_tier(size_gb: Column) -> Column:
    """``xlarge`` below 100 GB, ``2xlarge`` to 500, ``4xlarge`` to 1,000, then ``8xlarge``."""
    (first, below), *middle, (last, _) = fixed.INSTANCE_TIERS
    chain = F.when(size_gb < below, first)
    for name, up_to in middle:
        chain = chain.when(size_gb <= up_to, name)
    return chain.otherwise(last)


def capacity_plan(fleet: DataFrame) -> DataFrame:
    """Needs of each database in ``db_id, size_kb, row_count, table_count``."""
    size = F.col("size_kb") / KB_PER_GB
    hours = F.col("size_kb") / (KB_PER_GB * fixed.COPY_GB_PER_HOUR)
    too_big = F.col("size_kb") > fixed.RESTART_LIMIT_GB * KB_PER_GB
    too_long = F.col("size_kb") > fixed.RESTART_LIMIT_HOURS * fixed.COPY_GB_PER_HOUR * KB_PER_GB
    return fleet.select(
        "db_id",
        "size_kb",
        (F.col("size_kb") * fixed.STORAGE_FACTOR).alias("storage_kb"),
        F.round(hours, 2).alias("copy_hours"),
        (too_big | too_long).alias("needs_steady_host"),
        app_tier(size, F.col("row_count"), F.col("table_count")).alias("app_tier"),
        instance_tier(size).alias("instance_tier"),
    )


def capacity_totals(plan: DataFrame) -> DataFrame:
    """Databases, sizes and storage per tier pair."""
    return plan.groupBy("app_tier", "instance_tier", "needs_steady_host").agg(
        F.count(F.lit(1)).alias("databases"),
        F.sum("size_kb").alias("size_kb"),
        F.sum("storage_kb").alias("storage_kb"),
    )
