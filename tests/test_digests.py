"""Digest trees: the same diff as over all rows, and what is read for it."""

import random

import pytest
from pyspark.sql import functions as F

from relocate.operators import digests, reconcile
from relocate.plans.inputs import table

SF_DIR = "/root/testdata/sf0.01"
KEYS = ["o_orderkey"]


def rows(df):
    return sorted(map(str, df.collect()))


def copies(tmp_path, source, target, keys=KEYS, **settings):
    return [
        digests.write_digested(side, keys, str(tmp_path / name), **settings)
        for name, side in (("source", source), ("target", target))
    ]


def test_one_row_in_ten_thousand(spark, tmp_path):
    """15,000 orders, two of them changed: at most two folders of 256 are opened on each side."""
    orders = table(spark, SF_DIR, "orders")
    price = F.when(F.col("o_orderkey").isin(7, 9_999), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    changed = orders.withColumn("o_totalprice", price)
    source, target = copies(tmp_path, orders, changed, depth=4, folder_digits=2)
    left, right = digests.suspects(source, target, spark)
    whole = len(source.read(spark).inputFiles())
    assert whole >= 200
    for side in (left, right):
        assert 0 < len([f for f in side.inputFiles() if "/rows/" in f]) <= 2
    found = digests.reconcile_tree(source, target, spark)
    want = reconcile.reconcile_diff(orders, changed, KEYS)
    assert rows(found) == rows(want) and found.count() == 2


def test_equal_copies_read_no_rows(spark, tmp_path):
    orders = table(spark, "/root/testdata/sf0.001", "orders")
    source, target = copies(tmp_path, orders, orders.repartition(3), depth=2, folder_digits=1)
    assert digests.unequal_prefixes(source, target, spark) is None
    left, right = digests.suspects(source, target, spark)
    assert left.inputFiles() == [] and right.inputFiles() == []
    assert digests.reconcile_tree(source, target, spark).count() == 0


def test_digests_of_every_depth_add_up(spark, tmp_path):
    orders = table(spark, "/root/testdata/sf0.001", "orders")
    copy = digests.write_digested(orders, KEYS, str(tmp_path / "a"), depth=3, folder_digits=2)
    totals = [
        copy.tree(spark, d).agg(F.sum("rows"), F.sum("digest").cast("decimal(38,0)")).first() for d in range(4)
    ]
    assert totals == [totals[0]] * 4 and totals[0][0] == orders.count()
    assert copy.tree(spark, 0).count() == 1
    assert {len(r.prefix) for r in copy.tree(spark, 3).collect()} == {3}


def test_nulls_copies_of_a_key_and_missing_folders(spark, tmp_path):
    draw = random.Random(5)
    source = [(draw.choice([None, *range(40)]), draw.choice([None, "a", "b"])) for _ in range(300)]
    target = [r for r in source if r[0] != 3 and draw.random() < 0.97] + [(77, "new"), (None, "c")]
    left = spark.createDataFrame(source + [(5, "hot")] * 500, "id long, v string")
    right = spark.createDataFrame(target + [(5, "hot")] * 499, "id long, v string")
    pair = copies(tmp_path, left, right, ["id"], depth=2, folder_digits=1)
    assert rows(digests.reconcile_tree(*pair, spark)) == rows(reconcile.reconcile_diff(left, right, ["id"]))


def test_empty_side_and_unlike_copies(spark, tmp_path):
    some = spark.createDataFrame([(1, "a"), (2, None)], "id long, v string")
    pair = copies(tmp_path, some, some.limit(0), ["id"], depth=2, folder_digits=1)
    assert {r.difference for r in digests.reconcile_tree(*pair, spark).collect()} == {"missing"}
    other = digests.write_digested(some, ["id"], str(tmp_path / "other"), depth=3, folder_digits=1)
    with pytest.raises(ValueError, match="alike"):
        digests.unequal_prefixes(pair[0], other, spark)
    with pytest.raises(ValueError, match="folder_digits"):
        digests.write_digested(some, ["id"], str(tmp_path / "bad"), depth=1, folder_digits=2)
