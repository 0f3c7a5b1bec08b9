"""Trees of documents: reading order, depth, leaves, nearest ancestors.

Nodes are rows (id, parent, sib_ord); a null parent is a root. Levels are found
by joins of the frontier with the children, one round for each level of the
tree, so a tree of any size costs its depth in rounds.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.operators.lineage import cut


def levels(nodes: DataFrame) -> DataFrame:
    """Nodes with depth and path_ord (the sibling ordinals from the root), whose order is the reading order.

    Levels are added until one is empty, however deep the tree. Ids are
    distinct, so each node is reached once; nodes that no root leads to, cycles
    among them, are left out.
    """
    front = nodes.where("parent is null").select("id", "parent", "sib_ord", F.lit(0).alias("depth"), F.array("sib_ord").alias("path_ord"), F.array("id").alias("chain"))
    out, below = front, nodes.where("parent is not null")
    for depth in itertools.count(1):
        up = front.select(F.col("id").alias("up"), F.col("path_ord").alias("up_ord"), F.col("chain").alias("up_chain"))
        front = below.join(up, below.parent == F.col("up")).select("id", "parent", "sib_ord", F.lit(depth).alias("depth"), F.concat("up_ord", F.array("sib_ord")).alias("path_ord"), F.concat("up_chain", F.array("id")).alias("chain"))
        if depth > 2:  # the first levels are cheaper planned than probed
            front = cut(front)
            if front.limit(1).count() == 0:
                break
        out = out.unionAll(front)
        if depth % 16 == 0:  # a deep tree's plan stays short
            out = cut(out)
    return out


def leaves(nodes: DataFrame) -> DataFrame:
    """Nodes that are nobody's parent."""
    parents = nodes.select(F.col("parent").alias("p")).where("p is not null").distinct()
    return nodes.join(parents, nodes.id == F.col("p"), "left_anti")


def nearest(levelled: DataFrame, kinds: DataFrame, wanted: list[str]) -> DataFrame:
    """For each node the nearest of its ancestors or itself that is of the first of the ``wanted`` kinds found; else its root.

    ``kinds``: (id, kind). Rows: id, group_id.
    """
    rank = F.array_position(F.array(*[F.lit(w) for w in wanted]), F.col("kind"))
    chain = levelled.select("id", F.posexplode("chain").alias("pos", "ancestor"), "depth")
    ranked = chain.join(kinds.withColumnRenamed("id", "kid"), F.col("ancestor") == F.col("kid"), "left").withColumn("rank", F.when(rank > 0, rank).otherwise(F.when(F.col("pos") == 0, len(wanted) + 1)))
    return ranked.where("rank is not null").groupBy("id").agg(F.min_by("ancestor", F.struct("rank", (F.col("depth") - F.col("pos")).alias("distance"))).alias("group_id"))


def preorder(levelled: DataFrame) -> DataFrame:
    """Reading order as numbers from 1, without one window over all rows.

    A node follows its parent after the subtrees of its smaller siblings, so
    its place is 1 + the sum, along its chain, of 1 + the sizes of the subtrees
    of smaller siblings. Windows are as wide as one family.
    """
    sizes = levelled.select(F.explode("chain").alias("nid")).groupBy("nid").agg(F.count("*").alias("n"))
    family = Window.partitionBy("parent").orderBy("sib_ord").rowsBetween(Window.unboundedPreceding, -1)
    steps = levelled.join(sizes, F.col("id") == F.col("nid")).select(F.col("id").alias("sid"), (F.coalesce(F.sum("n").over(family), F.lit(0)) + F.when(F.col("parent").isNull(), 0).otherwise(1)).alias("step"))
    chained = levelled.select("id", F.explode("chain").alias("ancestor")).join(steps, F.col("ancestor") == F.col("sid"))
    return chained.groupBy("id").agg((F.sum("step") + 1).alias("position"))


def emitted_once(rows: DataFrame, section: Column, ancestor: Column, order: list[Column]) -> DataFrame:
    """Of all rows that name an ancestor within a section, the first in order."""
    w = Window.partitionBy(section, ancestor).orderBy(*order)
    return rows.withColumn("_first", F.row_number().over(w)).where("_first = 1").drop("_first")
