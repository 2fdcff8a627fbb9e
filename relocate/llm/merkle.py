"""A Merkle manifest of a dataset, with a proof for every row.

Every row is a leaf. The leaves of a language, in order of their ids, make one tree, and the roots
of the languages make the tree above: up to eight consecutive nodes become one, until one is left.

Nested-struct rollup: the octal digits of a leaf's rank name its way up. Three digits at a time are
grouped away, one after the other, inside blocks of at most 512 nodes; each step nests the structs
of the children, so a block ends as one row with its whole subtree. Blocks are the nodes of the
next round, until a tree is one block. The way down transforms a block's nested structs into the
siblings beside and above each leaf and explodes them. Proofs take no join: a block's row and the
path above it meet in one grouping. No task holds more than some blocks, whatever a language has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate.llm.common import lower_ascii
from relocate.llm.ranks import ranked
from relocate.session import settle

FANOUT = 8
#: Levels of a tree that one block holds.
LEVELS = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of texts laid end to end."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    """The hash of a row: the length and value of each field, ``-`` for null."""
    return digest(*[_field(fields[name]) for name in FIELDS])


def tampered(doc_id: Column) -> Column:
    """Whether the check tampers with a row: three divides the crc32 of its decimal id; null is ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 0


def _height(size: Column) -> Column:
    """Levels above ``size`` leaves: how often eight nodes become one until one is left."""
    return sum((size > FANOUT**k).cast("int") for k in range(21))


def _rolled(nodes: DataFrame, held: list[str]) -> DataFrame:
    """One row per block: ``tree, height, block, hash, kids`` from ``tree, height, rank, hash`` and ``held``.

    ``kids`` nests ``digit, hash, kids``; the lowest structs hold ``held`` in place of children. A
    level the tree does not reach passes its one child's hash on.
    """
    digits = [F.expr(f"cast(rank div {FANOUT**k} % {FANOUT} as int)").alias(f"d{k}") for k in range(LEVELS)]
    block = F.expr(f"rank div {FANOUT**LEVELS}").alias("block")
    rows = nodes.select("tree", "height", block, *digits, "hash", *held).repartition("tree", "block")
    kid = F.struct(F.col("d0").alias("digit"), "hash", *held)
    for k in range(LEVELS):
        above = [f"d{j}" for j in range(k + 1, LEVELS)]
        rows = rows.groupBy("tree", "height", "block", *above).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
        run = digest(F.array_join("kids.hash", ""))
        rows = rows.withColumn("hash", F.when(F.col("height") > k, run).otherwise(F.col("kids")[0]["hash"]))
        kid = F.struct(F.col(f"d{k + 1}").alias("digit"), "hash", "kids")
    return settle(rows, "blocks")


def _tree(nodes: DataFrame, held: list[str]) -> list[DataFrame]:
    """The blocks of every round; in the last one each tree is a single block."""
    rounds = [_rolled(nodes, held)]
    while rounds[-1].agg(F.max("block")).first()[0]:  # one number
        height = F.greatest(F.col("height") - LEVELS, F.lit(0))
        nodes = rounds[-1].select("tree", height.alias("height"), F.col("block").alias("rank"), "hash")
        rounds.append(_rolled(nodes.withColumn("below", F.col("rank")), ["below"]))
    return rounds


def _siblings(kids: Column, height: Column, path: Column, held: list[str], level: int) -> Column:
    """The lowest structs of a nested block with their ``path``: siblings left and right, lowest first."""

    def one(kid: Column, place: Column) -> Column:
        hashes = kids["hash"]
        beside = F.struct(
            F.array_join(F.slice(hashes, F.lit(1), place), "").alias("left"),
            F.array_join(F.slice(hashes, place + 2, F.lit(FANOUT)), "").alias("right"),
        )
        here = F.when(height > level, F.array(beside)).otherwise(F.array().cast(_PATH))
        up = F.concat(here, path)
        if level:
            return _siblings(kid["kids"], height, up, held, level - 1)
        return F.struct(*[kid[name].alias(name) for name in ("hash", *held)], up.alias("path"))

    found = F.transform(kids, one)
    return F.flatten(found) if level else found


def _down(rounds: list[DataFrame], tops: DataFrame, held: list[str], kept: list[str]) -> DataFrame:
    """Every node of round 0: ``hash``, ``held``, its ``path`` and what its tree is given in ``kept``.

    ``tops``: ``tree``, the ``path`` above its root and ``kept``, one row per tree.
    """
    paths = tops.select("tree", F.lit(0).cast("long").alias("block"), "path", *kept)
    for i, blocks in reversed(list(enumerate(rounds))):
        names = held if i == 0 else ["below"]
        both = blocks.unionByName(paths, allowMissingColumns=True).groupBy("tree", "block")
        met = both.agg(*[F.any_value(c, True).alias(c) for c in ("height", "kids", "path", *kept)])
        found = _siblings(F.col("kids"), F.col("height"), F.col("path"), names, LEVELS - 1)
        paths = met.select("tree", *kept, F.inline(found))
        if i:
            paths = paths.select("tree", F.col("below").alias("block"), "path", *kept)
    return paths


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, altered, subroot, root, path`` for every row of ``docs``.

    ``path`` has the siblings left and right of the row's way up to the root, lowest level first;
    ``altered`` is the hash of the tampered row, null where nothing is tampered with. Rows with
    equal ids stand in order of their leaves; a null id comes first, and null languages are a
    tree of their own before all others. Equal rows are leaves each. Other columns are not read.
    """
    fields = {name: F.col(name) for name in FIELDS}
    lower = {**fields, "text": lower_ascii(fields["text"])}
    tree = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("x"), "lang"))
    rows = settle(
        docs.select(
            fields["doc_id"].cast("long").alias("doc_id"),
            tree.alias("tree"),
            leaf(fields).alias("hash"),
            F.when(tampered(fields["doc_id"]), leaf(lower)).alias("altered"),
        ),
        "leaves",
    )
    nodes = ranked(rows, ["tree"], ["doc_id", "hash"]).withColumn("height", _height(F.col("size")))
    held = ["doc_id", "altered"]
    rounds = _tree(nodes, held)

    tops = settle(rounds[-1].select(F.lit("").alias("all"), F.col("tree").alias("name"), "hash"), "subroots")
    above = ranked(tops, ["all"], ["name"]).withColumn("height", _height(F.col("size")))
    crown = _tree(above.withColumn("tree", F.col("all")), ["name"])
    begin = crown[-1].select("tree", F.array().cast(_PATH).alias("path"), F.col("hash").alias("root"))
    subroots = _down(crown, begin, ["name"], ["root"]).select(
        F.col("name").alias("tree"), "path", F.col("hash").alias("subroot"), "root"
    )
    found = _down(rounds, settle(subroots, "subroots"), held, ["subroot", "root"])
    return found.select("doc_id", F.col("hash").alias("leaf"), "altered", "subroot", "root", "path")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, start, lambda acc, step: digest(step["left"], acc, step["right"]))


def proofs(rows: DataFrame) -> DataFrame:
    """Manifest rows with ``proof_sha256``, ``folded_root`` of the row as it is now, and ``verified``."""
    beside = F.transform("path", lambda step: F.concat(step["left"], step["right"]))
    return rows.withColumns(
        {
            "proof_sha256": digest(F.array_join(beside, "")),
            "folded_root": folded(F.coalesce("altered", "leaf"), F.col("path")),
        }
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
