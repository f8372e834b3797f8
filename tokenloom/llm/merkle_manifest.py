"""Merkle dataset manifest: one hash tree per group of rows, one over the groups, and a proof for each row.

Leaves are numbered within their group by a range sort whose partitions are
counted, so no task holds a whole group.  A tree is then built by slot pivots:
conditional aggregates spread the children below a parent into fanout columns,
and concatenating columns hashes it.  Several levels go into one pivot: 16
consecutive nodes of fanout two are four whole levels, hashed in their row.
Going down again, a row's columns without the child's own are its siblings.
Texts are hashed where they are read and never shuffled.

Defined cases: a null group is a group (before all others); rows of one group
and order value are ordered by their leaf hash; equal rows are leaves of their
own; an empty table gives no rows; a lone leaf is its group's subroot.  Columns
beyond the named ones are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import new_folder

#: nodes that one pivot takes (a power of the fanout up to this many columns)
SLOTS = 16


def encoded(c: Column) -> Column:
    """A value as `bytes:value` in UTF-8, `-` for null."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(columns: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of the encoded values, concatenated."""
    return F.sha2(F.concat(*map(encoded, columns)), 256)


def fold(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(siblings, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof_hash(siblings: Column) -> Column:
    """sha256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(siblings, lambda s: F.concat(s["before"], s["after"])), ""), 256)


class _Store:
    """Tables of one manifest in a new folder of the shared storage."""

    def __init__(self, df: DataFrame):
        self.spark, self.folder = df.sparkSession, new_folder(df.sparkSession, "merkle")

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")


def _numbered(rows: DataFrame, order: Sequence[str], fanout: int, store: _Store, name: str) -> DataFrame:
    """rows (column g: the group) with i, the place within the group, and depth, the levels of the group's tree.

    The sorted rows are written with their partition and place in it; only
    counts per (group, partition) are summed up over a group.
    """
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    ranged = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    kept = store(ranged.withColumn("part", part).withColumn("place", place), f"{name}-sorted")
    counts = kept.groupBy("g", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({
        "skipped": F.coalesce(F.sum("n").over(before), F.lit(0)), "size": F.sum("n").over(Window.partitionBy("g")),
    })
    # levels: how many powers of the fanout lie below the group's size
    powers = F.array(*[F.lit(fanout ** level).cast("long") for level in range(63) if fanout ** level < 1 << 62])
    counts = store(counts.select(
        F.col("g").alias("cg"), F.col("part").alias("cpart"), "first", "skipped",
        F.aggregate(powers, F.lit(0), lambda d, p: d + F.when(p < F.col("size"), 1).otherwise(0)).alias("depth"),
    ), f"{name}-counts")
    same = kept["g"].eqNullSafe(counts["cg"]) & (kept["part"] == counts["cpart"])
    return kept.join(counts, same).withColumn("i", F.col("skipped") + F.col("place") - F.col("first")).drop(
        "cg", "cpart", "first", "skipped", "part", "place")


def _pivot(nodes: DataFrame, fanout: int, levels: int, base: int) -> DataFrame:
    """One row for each block of nodes, with the nodes of each level in it; top is the block's own node.

    nodes: g, i, depth, h and p (payload of the node).  Level base + k is hashed
    only where the group's tree has it; above its root a lone node goes on unchanged.
    """
    width = fanout ** levels
    slot = F.pmod("i", F.lit(width))
    block = nodes.groupBy("g", F.expr(f"i div {width}").alias("b"), "depth").agg(
        *[F.max(F.when(slot == j, F.struct("h", "p"))).alias(f"s{j}") for j in range(width)])
    block = block.select("g", "b", "depth", *[F.col(f"s{j}.h").alias(f"n0_{j}") for j in range(width)],
                         F.array(*[F.col(f"s{j}.p") for j in range(width)]).alias("payload"))
    for k in range(levels):
        new = {}
        for j in range(fanout ** (levels - k - 1)):
            own = [F.col(f"n{k}_{j * fanout + x}") for x in range(fanout)]
            parent = F.sha2(F.concat(own[0], *[F.coalesce(c, F.lit("")) for c in own[1:]]), 256)
            new[f"n{k + 1}_{j}"] = F.when(F.col("depth") > base + k, parent).otherwise(own[0])
        block = block.withColumns(new)
    return block.withColumnRenamed(f"n{levels}_0", "top")


def _children(block: DataFrame, fanout: int, levels: int, base: int) -> DataFrame:
    """One row for each node below the blocks: its place, hash and payload, its siblings before those of its block.

    block also has path: the siblings of the block's own node up to the root.
    """
    width = fanout ** levels

    def siblings(slot: int) -> Column:
        found = []
        for k in range(levels):
            own, start = slot // fanout ** k, slot // fanout ** (k + 1) * fanout
            others = [(x, F.coalesce(F.col(f"n{k}_{x}"), F.lit(""))) for x in range(start, start + fanout) if x != own]
            before = F.concat(F.lit(""), *[c for x, c in others if x < own])
            after = F.concat(F.lit(""), *[c for x, c in others if x > own])
            found.append(F.when(F.col("depth") > base + k, F.struct(before.alias("before"), after.alias("after"))))
        return F.filter(F.array(*found), lambda s: s.isNotNull())

    slots = F.array(*[
        F.struct((F.col("b") * width + j).alias("i"), F.col(f"n0_{j}").alias("h"), F.col("payload")[j].alias("p"),
                 siblings(j).alias("own"))
        for j in range(width)
    ])
    rest = [c for c in block.columns if c not in ("b", "top", "payload", "path") and not c.startswith("n")]
    down = block.select(*rest, "path", F.explode(slots).alias("s")).where("s.h is not null")
    return down.select(*rest, "s.i", "s.h", "s.p", F.concat("s.own", "path").alias("path"))


def _tree(nodes: DataFrame, fanout: int, store: _Store, name: str) -> list[tuple[DataFrame, int]]:
    """The pivots from the leaves up, each with its lowest level, until every group is one node."""
    levels = 1
    while fanout ** (levels + 1) <= SLOTS:
        levels += 1
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    stages, base = [], 0
    while True:
        block = store(_pivot(nodes, fanout, levels, base), f"{name}-{base}")
        stages.append((block, base))
        base += levels
        if base >= deepest:
            return stages
        nodes = block.select("g", F.col("b").alias("i"), "depth", F.col("top").alias("h"), F.lit(None).cast("string").alias("p"))


def _proofs(stages: list[tuple[DataFrame, int]], tops: DataFrame, carried: Sequence[str], fanout: int) -> DataFrame:
    """The leaves of all groups with their siblings; tops: g, path and the carried columns of each group's root."""
    above = tops.withColumn("i", F.lit(0).cast("long"))
    for block, base in reversed(stages):
        levels = next(k for k in range(63) if f"n{k}_1" not in block.columns)
        up = above.select(F.col("g").alias("ug"), F.col("i").alias("ui"), "path", *carried)
        joined = block.join(up, block["g"].eqNullSafe(up["ug"]) & (block["b"] == up["ui"])).drop("ug", "ui")
        above = _children(joined, fanout, levels, base)
    return above


def merkle_manifest(rows: DataFrame, group: str, order: str, leaf: str, carry: Sequence[str] = (), fanout: int = 2) -> DataFrame:
    """A row for each row: order, leaf, subroot, root, siblings, and the columns named in carry.

    Leaves of a group ascend by the order column; every `fanout` consecutive
    nodes (the last run: fewer) become the sha256 of their hex digests until one
    remains, the group's subroot; subroots in the order of their groups lead to
    the root alike.  siblings holds a struct (before, after) for each level from
    the leaf to the root, see `fold`.
    """
    store = _Store(rows)
    payload = F.struct(F.col(order).alias("o"), *[F.col(c).alias(f"c{k}") for k, c in enumerate(carry)])
    leaves = rows.select(F.col(group).alias("g"), F.col(leaf).alias("h"), payload.alias("p"))
    leaves = _numbered(leaves.withColumn("o", F.col("p.o")), ["o", "h"], fanout, store, "leaves").drop("o")
    stages = _tree(leaves, fanout, store, "tree")
    subroots = stages[-1][0].select(F.lit(0).alias("g"), F.col("top").alias("h"), F.struct(F.col("g").alias("v")).alias("p"))
    subroots = _numbered(subroots.withColumn("v", F.col("p.v")), ["v"], fanout, store, "subroots").drop("v")
    upper = _tree(subroots, fanout, store, "top")
    none = F.array().cast("array<struct<before:string,after:string>>")
    top = upper[-1][0].select("g", F.col("top").alias("root"), none.alias("path"))
    groups = _proofs(upper, top, ["root"], fanout)
    groups = groups.select(F.col("p.v").alias("g"), F.col("h").alias("subroot"), "root", "path")
    found = _proofs(stages, groups, ["subroot", "root"], fanout)
    return found.select(
        F.col("p.o").alias(order), F.col("h").alias("leaf"), "subroot", "root", F.col("path").alias("siblings"),
        *[F.col(f"p.c{k}").alias(c) for k, c in enumerate(carry)],
    )
