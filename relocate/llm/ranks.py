"""Places of rows within their groups, however large a group is.

Rows are dealt out by ranges of group and order and written. Each written slice counts its rows
per group; the sums of the slices before it, one short table, turn places within a slice into
places within the group. So no task holds more than a slice, even if one group has all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relocate.session import settle

_SLICE, _TIE = "_slice", "_tie"


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The rows with ``rank``, from 0 by ``order`` (nulls first), and ``size``, the rows of the group.

    Group columns must not be null. Rows equal in group and order get their ranks in any order,
    so they must be interchangeable; they are spread over slices like any others. ``rows`` should
    be a written table: it is read twice.
    """
    tied = rows.withColumn(_TIE, F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(*group, *order, _TIE)
    sliced = settle(dealt.withColumn(_SLICE, F.spark_partition_id()), "slices")
    first = F.min(F.struct(*order, _TIE)).alias("_first")
    parts = sliced.groupBy(*group, _SLICE).agg(F.count(F.lit(1)).alias("_n"), first)
    whole = Window.partitionBy(*group)
    before = F.sum("_n").over(whole.orderBy("_first")) - F.col("_n")
    size = F.sum("_n").over(whole)
    offsets = settle(parts.select(*group, _SLICE, before.alias("_before"), size.alias("size")), "offsets")
    inside = Window.partitionBy(*group, _SLICE).orderBy(*order, _TIE)
    placed = sliced.join(offsets, [*group, _SLICE])
    return placed.withColumn("rank", F.col("_before") + F.row_number().over(inside) - 1).drop(
        _SLICE, _TIE, "_before"
    )
