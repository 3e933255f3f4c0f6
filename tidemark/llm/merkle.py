"""Merkle manifest of a dataset: leaves, roots and proofs by butterfly exchange.

A row's leaf is the hash of its fields. Per value of the partition column, leaves stand
in ascending order and every `FANOUT` consecutive nodes become their parent until one,
the subroot, is left; the subroots, in order of the value, give the root likewise.

`FANOUT ** HEIGHT` consecutive leaves are a block, the unit of the exchange: its own
subtree is hashed in one row. Then blocks exchange in rounds. In round r a block meets
the blocks whose number differs from its own in digit r alone; each gives the root of its
subtree of height r, and all of them hash the same parent. So every block has the siblings
of all its ancestors when the rounds end, and nothing is handed down. In a subtree that
is not full several blocks ask the same one, dealt evenly by remainder. A round
shuffles `FANOUT` rows a block; a block is at most `FANOUT ** HEIGHT` leaves, whatever
the partition values are. The subroots go through the same exchange as blocks of one
tree, so many partition values cost rounds, not a large task.

Positions come from one range partitioning and the counts of its parts.

Defined results: a null field is `-`, so null and empty differ; a null partition value is
a tree of its own and comes first, null order values first in their tree. Rows of equal
order value stand by leaf, so repeated rows have proofs of their own and any table has one
root. Texts are hashed whole in place, however long; other columns are never read, so
their names do not matter. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

FANOUT = 8
HEIGHT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PART_BITS = 33  # of monotonically_increasing_id: rows within a part


def digest(*parts: Column) -> Column:
    """Hash of texts after each other, in lower-case hex."""
    return F.sha2(F.concat(*parts), 256)


def leaf(values: Sequence[Column]) -> Column:
    """Hash of a row: each value with its length in bytes, or `-`."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return digest(*[part(v) for v in values])


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add `pos`, from 0 within `tree` by `order` (which tells all rows apart), and `leaves`, the size of the tree."""
    keys = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order]]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = stage(ranged.withColumn("spot", F.monotonically_increasing_id()), "merkle-order")
    ranged = ranged.withColumn("part", F.shiftright("spot", _PART_BITS))
    parts = ranged.groupBy("tree", "part").agg(F.min("spot").alias("first"), F.count("*").alias("n"))
    along = Window.partitionBy("tree").orderBy("part")
    parts = parts.select(
        "tree", "part",
        (F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("leaves"),
    )
    return ranged.join(parts, ["tree", "part"]).withColumn("pos", F.col("spot") + F.col("shift")).drop("spot", "part", "shift")


def _parents(nodes: Column, fanout: int) -> Column:
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / fanout).cast("int") - 1)
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * fanout + 1, fanout), "")))


def _siblings(nodes: Column, at: Column, fanout: int) -> Column:
    """What stands left and right of number `at` in its run of `fanout` nodes."""
    at = at.cast("int")
    first = at - at % fanout
    return F.struct(
        F.array_join(F.slice(nodes, first + 1, at - first), "").alias("left"),
        F.array_join(F.slice(nodes, at + 2, fanout - 1 - at % fanout), "").alias("right"),
    )


def butterfly(blocks: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """tree, block, upper, apex for blocks (tree, block, blocks, top): siblings from the block up, and the root.

    `block` counts from 0 to `blocks` - 1 in its tree; `top` is the hash of the block itself.
    """
    most = blocks.agg(F.max("blocks")).first()[0] or 0
    state = blocks.select("tree", "block", "blocks", F.col("top").alias("node"))
    rounds, width = [], 1
    while width < most:
        group = F.col("block") - F.col("block") % (width * fanout)
        begin = group + F.col("digit") * width
        size = F.least(F.lit(width), F.col("blocks") - begin)
        digits = F.sequence(F.lit(0).cast("long"), F.lit(fanout - 1).cast("long"))
        asked = state.where(F.col("blocks") > width).select("tree", "block", "blocks", F.explode(digits).alias("digit"))
        asked = asked.where(begin < F.col("blocks")).withColumn("peer", begin + F.col("block") % width % size)
        given = state.select("tree", F.col("block").alias("peer"), "node")
        met = asked.join(given, ["tree", "peer"]).groupBy("tree", "block", "blocks").agg(
            F.sort_array(F.collect_list(F.struct("digit", "node")))["node"].alias("nodes")  # at most `fanout`
        )
        own = (F.floor(F.col("block") / width) % fanout).cast("int")
        met = met.select(
            "tree", "block", "blocks", F.lit(len(rounds)).alias("round"), digest(F.array_join("nodes", "")).alias("node"),
            _siblings(F.col("nodes"), own, fanout).alias("beside"),
        )
        met = stage(met, "merkle-round")
        rounds.append(met.select("tree", "block", "round", "beside", "node"))
        # Trees that are done have no more than `width` blocks and ask no more.
        state, width = met.select("tree", "block", "blocks", "node"), width * fanout
    done = blocks.select("tree", "block", F.col("top").alias("own"))
    if not rounds:
        empty = F.array().cast("array<struct<left: string, right: string>>")
        return done.select("tree", "block", empty.alias("upper"), F.col("own").alias("apex"))
    path = reduce(DataFrame.unionByName, rounds).groupBy("tree", "block").agg(
        F.sort_array(F.collect_list(F.struct("round", "beside", "node"))).alias("path")  # one entry a round
    )
    path = path.select("tree", "block", F.col("path.beside").alias("upper"), F.element_at("path", -1)["node"].alias("apex"))
    return done.join(path, ["tree", "block"], "left").select(
        "tree", "block", F.coalesce("upper", F.array()).alias("upper"), F.coalesce("apex", "own").alias("apex")
    )


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf's hash and its siblings give."""
    return F.aggregate(path, node, lambda at, beside: digest(beside["left"], at, beside["right"]))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda beside: F.concat(beside["left"], beside["right"])), ""), 256)


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, order: str = "doc_id", partition: str = "lang",
    altered: Mapping[str, Column] | None = None, fanout: int = FANOUT, height: int = HEIGHT,
) -> DataFrame:
    """id (the value of `order`), leaf, altered, subroot, root and path of every row.

    `path` holds, for each level from the leaf up, the hashes left and right of the row's own
    node. `altered` is the leaf of the row with other values of some fields, to be checked
    against the proof; without them it is the leaf itself.
    """
    block = fanout**height
    own = [F.col(f"`{c}`") for c in fields]
    other = [(altered or {}).get(c, F.col(f"`{c}`")) for c in fields]
    value = F.col(f"`{partition}`").cast("string")
    rows = docs.select(
        F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), value)).alias("tree"),
        F.col(f"`{order}`").alias("id"), leaf(own).alias("leaf"), (leaf(other) if altered else F.lit(None).cast("string")).alias("altered"),
    )
    rows = stage(rows, "merkle-leaves").withColumn("uid", F.monotonically_increasing_id())
    placed = _placed(rows, ["id", "leaf", "uid"])
    number = F.floor(F.col("pos") / block)
    blocks = placed.groupBy("tree", number.alias("block"), F.ceil(F.col("leaves") / block).alias("blocks")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "id", "leaf", "altered"))).alias("rows")  # at most fanout ** height
    )
    blocks = blocks.withColumn("level0", F.col("rows.leaf"))
    top = F.col("level0")
    for k in range(1, height + 1):
        below = F.col(f"level{k - 1}")
        # A tree of one block ends with its first single node; a block among others goes up to its full height.
        going = (F.size(below) > 1) | ((F.col("blocks") > 1) & (F.size(below) > 0))
        blocks = blocks.withColumn(f"level{k}", F.when(going, _parents(below, fanout)).otherwise(F.array().cast("array<string>")))
        top = F.when(F.size(f"level{k}") > 0, F.col(f"level{k}")).otherwise(top)
    blocks = stage(blocks.withColumn("top", top[0]), "merkle-blocks")

    upper = stage(butterfly(blocks.select("tree", "block", "blocks", "top"), fanout), "merkle-upper")
    subroots = upper.where("block = 0").select(F.col("tree").alias("of"), F.col("apex").alias("subroot"))
    ordered = _placed(subroots.withColumn("tree", F.lit("")), ["of"])
    ordered = stage(ordered.select("tree", F.col("pos").alias("block"), F.col("leaves").alias("blocks"), F.col("subroot").alias("top"), "of"), "merkle-trees")
    roots = butterfly(ordered.drop("of"), fanout).join(ordered.select("tree", "block", "of"), ["tree", "block"]).select(
        F.col("of").alias("tree"), F.col("upper").alias("above"), F.col("apex").alias("root")
    )

    # A level has siblings to give where there is a level over it.
    def path(at: Column) -> Column:
        levels = [
            F.when(F.size(f"level{k + 1}") > 0, F.array(_siblings(F.col(f"level{k}"), F.floor(at / fanout**k), fanout))).otherwise(
                F.array().cast("array<struct<left: string, right: string>>")
            ) for k in range(height)
        ]
        return F.concat(*levels, F.col("upper"), F.col("above"))

    every = blocks.join(upper.withColumnRenamed("apex", "subroot"), ["tree", "block"]).join(roots, "tree")
    entries = F.transform("rows", lambda row, i: F.struct(
        row["id"].alias("id"), row["leaf"].alias("leaf"), F.coalesce(row["altered"], row["leaf"]).alias("altered"), path(i).alias("path")
    ))
    return every.select("subroot", "root", F.inline(entries)).select("id", "leaf", "altered", "subroot", "root", "path")
