"""The trie of conversation openings: one node per distinct sequence of first turns.

A turn becomes a 128-bit id of its place, role and text, so a node is named by the XOR of its turns'
ids and its depth. Conversations are cut into blocks of 32 turns; a block travels with the name of
the node before it. Blocks are sorted across the cluster by ranges, and each shard holds them as
padded matrices of turn ids: numpy lexsort puts equal openings side by side, masks of changed
columns, OR-accumulated from the left, mark where nodes start, and reduceat sums each depth.

Every sum is over rows, of marks that depend on the neighbours in the sorted order alone, and the
neighbours beyond a shard come along as ghosts. So nodes inside a shard are finished there; only
those at its edges, and those at a block's edge, are put together from their parts. What deeper
blocks save and where they end is added to the rows of the blocks above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relocate.llm.common import in_batches, whole
from relocate.llm.ranks import ranked
from relocate.session import settle

#: Turns a conversation may take over, and how many conversations share the one they come from.
OPENINGS, FAMILY = 6, 100
#: Columns of a matrix, and about how many rows a shard has at most.
WIDTH = 32
SHARD_ROWS = 50_000
PAD = np.iinfo(np.int64).min
NODE = ["k1", "k2", "depth"]
SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_TURNS = "array<struct<pos:long,t1:long,t2:long,chars:long>>"
_OUT = (
    "kind int, k1 long, k2 long, depth long, conv_id long, p1 long, p2 long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
_FIELDS = pa.schema([(name, _KINDS[kind]) for name, kind in (f.split() for f in _OUT.split(", "))])
DONE, PART, END = 0, 1, 2


# --- conversations as blocks of turn ids -------------------------------------------


def borrowed(conv_id: Column) -> Column:
    """Turns a conversation takes over: the crc32 of its decimal id, modulo six."""
    return F.crc32(conv_id.cast("string").cast("binary")) % OPENINGS


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, t1, t2, chars, total`` per turn, and one row with a null ``pos`` where there is none.

    Turns are ordered by ``turn`` (null first), turns of one number by a hash of role and text; null
    roles and texts are empty. Rows without a ``conv_id`` belong to no conversation.
    """
    role, text = whole(F.col("role").cast("string")), whole(F.col("text").cast("string"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(WIDTH), text, role).alias("b"),
        F.char_length(text).cast("long").alias("chars"),
    )
    placed = settle(
        ranked(settle(turns, "turns"), ["conv_id"], ["turn", "a", "b"])
        .withColumns({"h": borrowed(F.col("conv_id")), "base": F.expr(f"conv_id - conv_id % {FAMILY}")})
        .select("conv_id", "rank", "size", "h", "base", "a", "b", "chars"),
        "placed",
    )
    openings = (
        placed.filter((F.col("conv_id") == F.col("base")) & (F.col("rank") < OPENINGS - 1))
        .groupBy("base")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "a", "b", "chars"))).alias("opening"))
    )
    openings = settle(openings, "openings")  # a hundredth of the conversations, five turns each
    given = F.least(F.col("h"), F.coalesce(F.size("opening"), F.lit(0)))
    met = placed.join(openings, "base", "left").withColumn("given", given)
    met = met.withColumn("total", F.col("given") + F.greatest(F.col("size") - F.col("h"), F.lit(0)))
    own = met.filter("rank >= h").select(
        "conv_id", (F.col("given") + F.col("rank") - F.col("h")).alias("pos"), "a", "b", "chars", "total"
    )
    taken = F.slice("opening", F.lit(1), F.col("given").cast("int"))
    first = met.filter("rank = 0").select("conv_id", "total", F.inline_outer(taken))
    some = F.col("total") == 0
    first = first.filter(some | F.col("rank").isNotNull()).select(
        "conv_id", F.col("rank").alias("pos"), "a", "b", "chars", "total"
    )
    names = {"t1": F.xxhash64("a", "b", "pos"), "t2": F.xxhash64("pos", "b", "a")}
    return own.unionByName(first).withColumns(names).drop("a", "b")


def blocks(turns: DataFrame) -> DataFrame:
    """``conv_id, block, total, more, turns, q1, q2``: up to 32 turns, and the node before them.

    ``more`` is 1 where the conversation goes on after the block.
    """
    at = F.coalesce(F.expr(f"pos div {WIDTH}"), F.lit(0).cast("long"))
    turn = F.when(F.col("pos").isNotNull(), F.struct("pos", "t1", "t2", "chars"))
    cut = turns.groupBy("conv_id", at.alias("block"), "total").agg(
        F.sort_array(F.collect_list(turn)).cast(_TURNS).alias("turns"),
        F.bit_xor("t1").alias("x1"),
        F.bit_xor("t2").alias("x2"),
    )
    cut = settle(cut, "blocks")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    names = cut.filter(F.col("total") > WIDTH).select(
        "conv_id", "block", F.bit_xor("x1").over(before).alias("q1"), F.bit_xor("x2").over(before).alias("q2")
    )
    named = cut.drop("x1", "x2").join(settle(names, "names"), ["conv_id", "block"], "left")
    zero = F.lit(0).cast("long")
    return named.withColumns(
        {
            "more": (F.col("total") > (F.col("block") + 1) * WIDTH).cast("int"),
            "q1": F.coalesce("q1", zero),
            "q2": F.coalesce("q2", zero),
        }
    )


def shards(rows: DataFrame) -> DataFrame:
    """Blocks in ranges of their order, with ``shard``, ``ghost`` 0, and each shard's two neighbours as ghosts."""
    spark = rows.sparkSession
    rows = settle(rows.drop("total"), "named")
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // SHARD_ROWS))
    order = ["block", "q1", "q2", "turns", "more", "conv_id"]
    dealt = rows.select(*order).repartitionByRange(count, *order)
    dealt = settle(dealt.withColumn("shard", F.spark_partition_id()), "shards")
    key = F.struct(*order)
    ends = dealt.groupBy("shard").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    line = Window.orderBy("low")  # one row per shard
    ghosts = ends.select(
        "shard", F.lag("high").over(line).alias("before"), F.lead("low").over(line).alias("after")
    )
    ghosts = settle(ghosts, "ghosts")
    own = dealt.withColumn("ghost", F.lit(0))
    for name, sign in (("before", -1), ("after", 1)):
        side = ghosts.filter(F.col(name).isNotNull()).select(f"{name}.*", "shard", F.lit(sign).alias("ghost"))
        own = own.unionByName(side)
    return own


# --- one shard ---------------------------------------------------------------------


class Matrix:
    """The blocks of one shard in order, padded, with what each row shares with the one before it."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        column = lambda name: table.column(name).to_numpy()
        lists = pa.concat_arrays(table.column("turns").chunks) if table.num_rows else None
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        width = int(sizes.max(initial=0))
        inside = np.arange(width) < sizes[:, None]

        def padded(name: str, fill: int) -> np.ndarray:
            out = np.full((len(sizes), width), fill, np.int64)
            out[inside] = flat.field(name).to_numpy(zero_copy_only=False)
            return out

        t1, t2, chars = padded("t1", PAD), padded("t2", PAD), padded("chars", 0)
        rows = {n: column(n) for n in ("conv_id", "block", "q1", "q2", "more", "ghost", "deeper_saved", "deeper_leaf")}
        turns = [x for k in reversed(range(width)) for x in (t2[:, k], t1[:, k])]
        order = np.lexsort((rows["conv_id"], rows["more"], *turns, rows["q2"], rows["q1"], rows["block"]))
        self.t1, self.t2, self.sizes, self.width = t1[order], t2[order], sizes[order], width
        self.__dict__.update({n: v[order] for n, v in rows.items()})
        count = len(order)
        other = np.ones(count, bool)
        group = np.stack([self.block, self.q1, self.q2])
        other[1:] = (group[:, 1:] != group[:, :-1]).any(axis=0)
        changed = np.ones((count, width + 1), bool)
        changed[:, 0] = other
        changed[1:, 1:] = (self.t1[1:] != self.t1[:-1]) | (self.t2[1:] != self.t2[:-1])
        #: Whether a row starts a node of each depth, root included, were it long enough.
        self.starts = np.logical_or.accumulate(changed, axis=1)
        self.shared = np.minimum((~self.starts[:, 1:]).sum(axis=1), self.sizes)
        self.shared[1:] = np.minimum(self.shared[1:], self.sizes[:-1])
        goes_on = np.zeros(count, bool)  # the next row extends or repeats this one
        goes_on[:-1] = ~other[1:] & (self.shared[1:] >= self.sizes[:-1])
        self.leaf = ((self.more == 0) & ~goes_on).astype(np.int64)
        self.chars = np.concatenate([np.zeros((count, 1), np.int64), np.cumsum(chars[order], axis=1)], axis=1)
        self.kept = self.chars[np.arange(count), self.shared]


def _marks(table: pa.Table) -> pa.Table:
    """What each block below the first saves, and whether its conversation ends there as a leaf."""
    m = Matrix(table)
    own = m.ghost == 0
    return pa.table({"conv_id": m.conv_id[own], "block": m.block[own], "saved": m.kept[own], "leaf": m.leaf[own]})


def joined_digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


NOTHING = joined_digest(np.zeros(0, np.int64))


def _nodes(table: pa.Table) -> pa.Table:
    """Finished nodes of a shard, parts of the others, and the conversations that end at parts."""
    m = Matrix(table)
    own = np.flatnonzero(m.ghost == 0)
    told: list[pa.RecordBatch] = []

    def tell(count: int, **columns) -> None:
        arrays = [pa.array(columns[f.name]).cast(f.type) if f.name in columns else pa.nulls(count, f.type) for f in _FIELDS]
        told.append(pa.RecordBatch.from_arrays(arrays, schema=_FIELDS))

    after = own[-1] + 1 if len(own) else 0
    k1, k2 = m.q1.copy(), m.q2.copy()
    above = above_part = above_id = None
    for d in range(m.width + 1):
        rows = own[m.sizes[own] >= d]
        if not len(rows):
            break
        up1, up2 = k1, k2
        if d:
            k1, k2 = k1 ^ m.t1[:, d - 1], k2 ^ m.t2[:, d - 1]
        starts = m.starts[rows, d].copy()
        starts[0] = True
        at = np.flatnonzero(starts)
        first = rows[at]
        node = np.cumsum(starts) - 1
        part = (m.block[first] * WIDTH + d) % WIDTH == 0
        part[0] |= not m.starts[first[0], d]
        if after < len(m.sizes) and m.sizes[after] >= d and not m.starts[after, d] and rows[-1] == after - 1:
            part[-1] = True
        # The node before a later block has its numbers from the block above, all but its children.
        upper = np.zeros(len(at), bool) if d else m.block[first] > 0
        full = (~upper).astype(np.int64)
        total = lambda values: np.add.reduceat(values, at)
        grown = np.zeros(len(rows), np.int64)
        if d < m.width:
            grown = (m.starts[rows, d + 1] & (m.sizes[rows] > d)).astype(np.int64)
        ends = (m.sizes[rows] == d) & (m.more[rows] == 0)
        saved = np.maximum(m.kept[rows] - m.chars[rows, max(d - 1, 0)], 0) + m.deeper_saved[rows]
        leaves = np.where(m.more[rows] == 0, m.leaf[rows], m.deeper_leaf[rows])
        least = np.minimum.reduceat(m.conv_id[rows], at)
        parent = pa.nulls(len(at), pa.int64())
        if d:
            over = above_id[first]
            parent = pa.array(above[over], mask=above_part[over])
        # Those that end at a node stand first in it.
        ending = at + total(ends.astype(np.int64))
        digests = [
            None if p else joined_digest(m.conv_id[rows[i:j]]) if i < j else NOTHING
            for p, i, j in zip(part.tolist(), at.tolist(), ending.tolist(), strict=True)
        ]
        tell(
            len(at),
            kind=np.where(part, PART, DONE),
            k1=k1[first],
            k2=k2[first],
            depth=m.block[first] * WIDTH + d,
            conv_id=pa.array(least, mask=upper),
            p1=up1[first],
            p2=up2[first],
            parent_conv_id=parent,
            n_convs=total(np.ones(len(rows), np.int64)) * full,
            n_children=total(grown),
            n_leaves=total(leaves) * full,
            saved_tokens=total(saved) * full,
            ends_sha256=pa.array(digests, pa.string()),
        )
        open_ends = rows[ends & part[node]]
        tell(
            len(open_ends),
            kind=np.full(len(open_ends), END),
            k1=k1[open_ends],
            k2=k2[open_ends],
            depth=m.block[open_ends] * WIDTH + d,
            conv_id=m.conv_id[open_ends],
        )
        above, above_part = least, part
        above_id = np.zeros(len(m.sizes), np.int64)
        above_id[rows] = node
    return pa.Table.from_batches(told, schema=_FIELDS)


# --- the whole trie ----------------------------------------------------------------


def _deeper(rows: DataFrame) -> DataFrame:
    """``conv_id, block, deeper_saved, deeper_leaf``: what the later blocks of a conversation add."""
    none = {"deeper_saved": F.lit(0).cast("long"), "deeper_leaf": F.lit(0).cast("long")}
    later = rows.filter("block > 0").withColumns(none)
    marks = later.groupBy("shard").applyInArrow(_marks, "conv_id long, block long, saved long, leaf long")
    marks = settle(marks, "marks")
    # A row for every block, and one for the first, which has no marks of its own.
    begin = marks.filter("block = 1").withColumns(
        {"block": F.lit(0).cast("long"), "saved": F.lit(0).cast("long"), "leaf": F.lit(0).cast("long")}
    )
    after = Window.partitionBy("conv_id").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    total = lambda c: F.coalesce(F.sum(c).over(after), F.lit(0).cast("long"))
    return marks.unionByName(begin).select(
        "conv_id", "block", total("saved").alias("deeper_saved"), total("leaf").alias("deeper_leaf")
    )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of ids that come sorted by node; one digest is held, however many ids a node has."""
    node, state = None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{**dict(zip(NODE, node, strict=True)), "ends": state.hexdigest()}],
            pa.schema([*[(n, pa.int64()) for n in NODE], ("ends", pa.string())]),
        )

    for b in batches:
        for *key, conv in zip(*[b.column(n).to_pylist() for n in (*NODE, "conv_id")], strict=True):
            if key != node:
                if node is not None:
                    yield told()
                node, state = key, hashlib.sha256(str(conv).encode())
            else:
                state.update(f",{conv}".encode())
    if node is not None:
        yield told()


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per node of the rebuilt conversations' trie; see the module and :func:`rebuilt`.

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Conversations without turns are members of the
    root alone. Without conversations there is no node. Turns repeated in a conversation are turns
    each. A digest of ids reads them one after the other, as SHA-256 does; those of a sequence that
    very many conversations share stream through one task.
    """
    rows = shards(blocks(rebuilt(conversations)))
    deeper = settle(_deeper(rows), "deeper")
    zero = F.lit(0).cast("long")
    rows = rows.join(deeper, ["conv_id", "block"], "left").withColumns(
        {"deeper_saved": F.coalesce("deeper_saved", zero), "deeper_leaf": F.coalesce("deeper_leaf", zero)}
    )
    found = settle(rows.groupBy("shard").applyInArrow(_nodes, _OUT), "nodes")
    ends = found.filter(F.col("kind") == END).select(*NODE, "conv_id")
    ends = ends.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    digests = in_batches(ends, _streamed, "k1 long, k2 long, depth long, ends string")
    parts = (
        found.filter(F.col("kind") == PART)
        .groupBy(*NODE)
        .agg(
            F.min("conv_id").alias("conv_id"),
            *[F.any_value(F.when(F.col("conv_id").isNotNull(), F.col(c)), True).alias(c) for c in ("p1", "p2")],
            F.any_value("parent_conv_id", True).alias("parent_conv_id"),
            *[F.sum(c).alias(c) for c in SUMS],
        )
        .join(digests, NODE, "left")
        .withColumn("ends_sha256", F.coalesce("ends", F.lit(NOTHING)))
        .drop("ends")
    )
    parts = settle(parts, "parts")
    root = parts.filter("depth = 0").select("conv_id").scalar()
    both = found.filter(F.col("kind") == DONE).drop("kind").unionByName(parts).withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, root).otherwise(F.col("parent_conv_id"))
    )
    known = (F.col("depth") == 0) | F.col("parent_conv_id").isNotNull()
    over = parts.select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("over")
    )
    patched = both.filter(~known).join(over, ["p1", "p2", "depth"], "left")
    patched = patched.withColumn("parent_conv_id", F.col("over")).drop("over")
    names = ["conv_id", "depth", "parent_conv_id", *SUMS, "ends_sha256"]
    return both.filter(known).select(*names).unionByName(patched.select(*names))
