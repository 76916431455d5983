"""Merkle manifest of a table: one tree a group, one tree over the groups' roots, and a proof for every row.

The tree is built by a slot pivot. A node's number within its group tells its parent and the slot it has there; aggregates
under the condition of the slot spread a parent's children into as many columns as the fanout. The columns side by side
are what the parent hashes; the same columns without a child's own are its siblings.

Rows are dealt by blocks of at most BLOCK_ROWS consecutive nodes of a group. Digits of the number, highest first, order a
block's rows so that the runs of every level lie together: one shuffle and one sort serve all levels within blocks, and a
group of any size is split into its blocks. The blocks' roots are the next pass's nodes, until each group has one left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbline.llm.common import broadcast_if_small, row_numbers, settle

#: Nodes of a block at most; a block's levels are settled by one task.
BLOCK_ROWS = 1024
#: Bytes of a step (two strings of digests) at a fanout of two, by which broadcasts are bounded; steps of a path at most.
STEP_BYTES, PATH_STEPS = 192, 64
STEPS = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value as its hash sees it: `-` if null, else its UTF-8 byte count, a colon and its text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal sha256 of the parts side by side."""
    return F.sha2(F.concat_ws("", *parts), 256)


def _climbed(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """`nodes` (group, number, count, node and others) with `block`, the node of their block, and the `steps` to it."""
    spans = [fanout**level for level in range(levels)]
    rows = nodes.withColumn("block", F.floor(F.col("number") / F.lit(fanout**levels)).cast("long"))
    digits = [f"slot{level}" for level in range(levels)]
    rows = rows.withColumns(
        {name: (F.expr(f"number div {span}") % fanout).cast("int") for name, span in zip(digits, spans)}
    )
    rows = rows.repartition("group", "block").withColumn("steps", F.expr(f"CAST(array() AS {STEPS})"))
    others = [c for c in nodes.columns if c != "node"] + ["block"]
    for level, span in enumerate(spans):
        run = Window.partitionBy("group", "block", *reversed(digits[level + 1 :]))
        own, more = F.col(digits[level]), F.col("count") > span  # else the group has come down to one node already
        pivot = [F.max(F.when(own == k, F.col("node"))).over(run).alias(f"child{k}") for k in range(fanout)]
        children = [F.col(f"child{k}") for k in range(fanout)]
        left = F.concat_ws("", *(F.when(own > k, child) for k, child in enumerate(children)))
        right = F.concat_ws("", *(F.when(own < k, child) for k, child in enumerate(children)))
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        rows = rows.select("*", *pivot).select(
            *others,
            *digits[level + 1 :],
            F.when(more, F.concat("steps", step)).otherwise(F.col("steps")).alias("steps"),
            F.when(more, digest(*children)).otherwise(F.col("node")).alias("node"),
        )
    return rows


def _paths(nodes: DataFrame, fanout: int) -> DataFrame:
    """`nodes` (group, number, count, node and others), where node becomes the group's root and `steps` lead to it.

    `nodes` are read from a written table, and twice.
    """
    passes, width = [], 1
    while not passes or most > width:
        most = nodes.agg(F.max("count")).first()[0] or 0
        levels, width = 1, fanout
        while width < most and width * fanout <= BLOCK_ROWS:
            levels, width = levels + 1, width * fanout
        passes.append(settle(_climbed(nodes, fanout, levels), "merkle-blocks"))
        heads = passes[-1].filter(F.col("number") % width == 0)
        count = F.expr(f"(`count` + {width - 1}L) div {width}")
        nodes = heads.select("group", F.col("block").alias("number"), count.alias("count"), "node")
    found = passes.pop()
    while passes:
        upper = found.select("group", F.col("number").alias("block"), F.col("node").alias("_node"), F.col("steps").alias("_steps"))
        upper = broadcast_if_small(settle(upper, "merkle-upper"), STEP_BYTES * PATH_STEPS)
        met = passes.pop().join(upper, ["group", "block"])
        found = met.withColumns({"node": F.col("_node"), "steps": F.concat("steps", "_steps")}).drop("_node", "_steps")
    return found.drop("block")


def proofs(rows: DataFrame, leaf: str, group: str, order: str, fanout: int = 2) -> DataFrame:
    """`rows` with subroot, root and `steps`, the siblings left and right of a row's path, from its run up to the root.

    Within a group rows ascend by `order` (null first), then by `leaf`, their digest. While a group has several nodes,
    every `fanout` consecutive ones become one, the last run with those that are left, even a single one. Groups' roots
    ascend by `group` (null first, bytewise) and are joined likewise. Equal rows are leaves of their own; either may come
    first. One group's only row is its subroot, with no step to it. An empty table gives no rows. Columns of `rows` named
    subroot, root or steps give way to those made here; all others are kept whatever their names.
    """
    if not 2 <= fanout <= BLOCK_ROWS:
        raise ValueError(f"fanout must be from 2 to {BLOCK_ROWS}")
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("subroot", "root", "steps")]
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    leaves = rows.select(key.alias("group"), F.col(f"`{order}`").alias("order"), F.col(f"`{leaf}`").alias("node"), F.struct(*kept).alias("row"))
    leaves = settle(leaves, "merkle-leaves")
    counts = settle(leaves.groupBy("group").agg(F.count("*").alias("count")), "merkle-groups")
    numbered = row_numbers(leaves, "group", "order", "node").withColumnRenamed("_number", "number").drop("order")
    numbered = numbered.join(broadcast_if_small(counts, 256), "group")
    found = _paths(settle(numbered, "merkle-numbered"), fanout)
    tops = found.filter("number = 0").select("group", F.col("node").alias("node"))
    tops = row_numbers(tops.withColumn("all", F.lit("")), "all", "group").withColumnRenamed("_number", "number")
    tops = tops.withColumns({"count": F.lit(counts.count()).cast("long"), "member": F.col("group"), "group": F.col("all")})
    tops = _paths(settle(tops.drop("all"), "merkle-numbered"), fanout).select(
        F.col("member").alias("group"), F.col("node").alias("root"), F.col("steps").alias("_steps")
    )
    met = found.join(broadcast_if_small(settle(tops, "merkle-tops"), STEP_BYTES * PATH_STEPS), "group")
    return met.select("row.*", F.col("node").alias("subroot"), "root", F.concat("steps", "_steps").alias("steps"))


def siblings(steps: Column) -> Column:
    """All siblings of a path, level by level, left to right, as one text."""
    return F.array_join(F.transform(steps, lambda step: F.concat(step["left"], step["right"])), "")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf comes to with the siblings of a path."""
    return F.aggregate(steps, leaf, lambda node, step: digest(step["left"], node, step["right"]))
