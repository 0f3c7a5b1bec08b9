"""Trees as deep as they are large: places, depths and ancestors by pointer doubling.

A round lets every pointer reach twice as far, so a chain of n nodes takes log2
n rounds over rows whose number stays that of the nodes. ``operators.tree`` goes
level by level instead, which is less work for a tree of few levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.operators.lineage import written


def _edges(nodes: DataFrame) -> DataFrame:
    """The tour that goes down and up each node: (id, up, to_id, to_up, down, climb); to_id is null at its end.

    After a node is entered comes its first child, or its own way up; after
    that the next sibling, or the way up of the parent. Roots are siblings.
    """
    family = Window.partitionBy("parent").orderBy("sib_ord", "id")
    placed = nodes.select("id", "parent", "sib_ord").withColumn("next", F.lead("id").over(family)).withColumn("nth", F.row_number().over(family))
    first = placed.where("nth = 1 and parent is not null").select(F.col("parent").alias("p"), F.col("id").alias("child"))
    down = placed.join(first, F.col("id") == F.col("p"), "left").select("id", F.lit(False).alias("up"), F.coalesce("child", "id").alias("to_id"), F.col("child").isNull().alias("to_up"), F.lit(1).alias("down"), F.lit(1).alias("climb"))
    up = placed.select("id", F.lit(True).alias("up"), F.coalesce("next", "parent").alias("to_id"), F.col("next").isNull().alias("to_up"), F.lit(0).alias("down"), F.lit(-1).alias("climb"))
    return down.unionByName(up).select("id", "up", "to_id", "to_up", F.col("down").cast("long").alias("down"), F.col("climb").cast("long").alias("climb"))


def toured(nodes: DataFrame) -> DataFrame:
    """(id, position, depth, size) of each node that a root leads to.

    ``nodes``: id, parent (null: a root), sib_ord. ``position`` is that in the
    reading order, from 1; ``depth`` 0 for roots; ``size`` counts a node's
    subtree with itself. Roots follow each other by sib_ord and id, which one
    window puts in order. Nodes below a cycle or a missing parent are left out.
    """
    edges = written(_edges(nodes), "tour")
    for _ in range(max(1, (2 * nodes.count()).bit_length()) + 1):
        on = edges.select(F.col("id").alias("o_id"), F.col("up").alias("o_up"), F.col("to_id").alias("o_to"), F.col("to_up").alias("o_to_up"), F.col("down").alias("o_down"), F.col("climb").alias("o_climb"), F.lit(True).alias("there"))
        joined = edges.join(on, (F.col("to_id") == F.col("o_id")) & (F.col("to_up") == F.col("o_up")), "left")
        there = F.col("there").isNotNull()
        edges = written(joined.select(
            "id", "up", F.when(there, F.col("o_to")).otherwise(F.col("to_id")).alias("to_id"), F.when(there, F.col("o_to_up")).otherwise(F.col("to_up")).alias("to_up"),
            (F.col("down") + F.coalesce("o_down", F.lit(0))).alias("down"), (F.col("climb") + F.coalesce("o_climb", F.lit(0))).alias("climb"),
        ), "tour")
        if edges.where("to_id is not null").isEmpty():
            break
    ended = edges.where("to_id is null")  # others run in a circle, or to a parent that is not there
    total = ended.where("not up").agg(F.count("*").alias("n"))  # one row
    sides = ended.groupBy("id").agg(F.max(F.when(~F.col("up"), F.col("down"))).alias("enter"), F.max(F.when(F.col("up"), F.col("down"))).alias("leave"), F.max(F.when(~F.col("up"), F.col("climb"))).alias("climb"))
    whole = sides.where("enter is not null and leave is not null").crossJoin(F.broadcast(total))
    return whole.select("id", (F.col("n") - F.col("enter") + 1).alias("position"), (-F.col("climb")).alias("depth"), (F.col("enter") - F.col("leave")).alias("size"))


def nearest(nodes: DataFrame, kinds: DataFrame, wanted: list[str]) -> DataFrame:
    """(id, group_id) as of ``tree.nearest``: the nearest ancestor or self of the first wanted kind found, else the root.

    ``nodes``: id, parent; ``kinds``: id, kind. A node looks at itself, then at
    as many ancestors again in each round, and keeps the best.
    """
    rank = F.array_position(F.array(*[F.lit(w) for w in wanted]), F.col("kind"))
    best = F.coalesce(F.when(rank > 0, rank), F.when(F.col("parent").isNull(), F.lit(len(wanted) + 1))).cast("long")
    known = kinds.select(F.col("id").alias("kid"), "kind")
    rows = nodes.select("id", "parent").join(known, F.col("id") == F.col("kid"), "left")
    state = written(rows.select("id", F.col("parent").alias("to"), F.lit(1).cast("long").alias("span"), F.when(best.isNotNull(), F.struct(best.alias("rank"), F.lit(0).cast("long").alias("far"), F.col("id").alias("at"))).alias("best")), "nearest")
    for _ in range(max(1, nodes.count().bit_length()) + 1):
        if state.where("to is not null").isEmpty():
            break
        on = state.select(F.col("id").alias("o_id"), F.col("to").alias("o_to"), F.col("span").alias("o_span"), F.col("best").alias("o_best"), F.lit(True).alias("there"))
        joined = state.join(on, F.col("to") == F.col("o_id"), "left")
        further = F.when(F.col("o_best").isNotNull(), F.struct(F.col("o_best.rank").alias("rank"), (F.col("o_best.far") + F.col("span")).alias("far"), F.col("o_best.at").alias("at")))
        there = F.col("there").isNotNull()
        state = written(joined.select("id", F.when(there, F.col("o_to")).otherwise(F.col("to")).alias("to"), (F.col("span") + F.coalesce("o_span", F.lit(0))).alias("span"), F.least("best", further).alias("best")), "nearest")
    return state.where("to is null and best is not null").select("id", F.col("best.at").alias("group_id"))
