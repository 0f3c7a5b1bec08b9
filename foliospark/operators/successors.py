"""Folds whose next step depends on the last element kept, over many tasks.

Each element's successor, were it kept, is found at once for all elements, by
ranks among sorted values. Which elements the first one then leads to is found
by pointer doubling: in each round the marked elements mark those that their
pointers lead to, and the pointers reach twice as far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.operators import ranks
from foliospark.operators.lineage import written


def counts_below(values: DataFrame, asked: DataFrame, group: str, or_equal: bool) -> DataFrame:
    """(group, key, below): for each of ``asked`` (group, key, x) how many of the group's ``values`` (group, v) are below x, or equal to it too.

    Both are ranked together and the asked ones among themselves; the
    difference is the number of values before, with no window over a group.
    """
    first = F.lit(0 if or_equal else 1)
    both = values.select(group, F.col("v").cast("long").alias("x"), first.alias("side"), F.lit(None).cast("long").alias("key")).unionByName(asked.select(group, F.col("x").cast("long").alias("x"), (1 - first).alias("side"), F.col("key").cast("long").alias("key")))
    merged = ranks.numbered(both, ["x", "side", "key"], [group], "place")
    alone = ranks.numbered(merged.where("key is not null").select(group, "x", "key", "place"), ["x", "key"], [group], "own")
    return alone.select(group, "key", (F.col("place") - F.col("own")).alias("below"))


def reached(pointers: DataFrame, group: str) -> DataFrame:
    """(group, at) of the elements that 0 leads to. ``pointers``: (group, at, to), ``to`` beyond ``at`` or null at the end."""
    marks = written(pointers.where("at = 0").select(group, "at"), "marks")
    jump = written(pointers.select(group, "at", "to"), "jump")
    while True:
        led = marks.join(jump.where("to is not null").select(F.col(group).alias("_g"), F.col("at").alias("_at"), "to"), F.col(group).eqNullSafe(F.col("_g")) & (F.col("at") == F.col("_at")))
        more = written(led.select(group, F.col("to").alias("at")), "marks")
        if more.isEmpty():
            return marks
        marks = written(marks.unionByName(more), "marks")  # what pointers of twice the reach lead to is further on: no element twice
        on = jump.select(F.col(group).alias("_g"), F.col("at").alias("_at"), F.col("to").alias("_to"))
        twice = jump.where("to is not null").join(on, F.col(group).eqNullSafe(F.col("_g")) & (F.col("to") == F.col("_at")), "left")
        jump = written(twice.select(group, "at", F.col("_to").alias("to")), "jump")


def running(rows: DataFrame, group: str, value: Column, at: str = "at") -> DataFrame:
    """``rows``, which have their place ``at`` in the group, with ``before``: the sum of ``value`` over the places before, chunk by chunk."""
    chunk = 4096
    cut = rows.withColumn("_v", value.cast("long")).withColumn("_chunk", F.floor(F.col(at) / chunk))
    sums = cut.groupBy(group, "_chunk").agg(F.sum("_v").alias("_sum"))
    # a chunk has thousands of rows: the window over chunks is that much narrower than the group
    over = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col(group).alias("_g"), F.col("_chunk").alias("_c"), F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_start"))
    inside = F.coalesce(F.sum("_v").over(Window.partitionBy(group, "_chunk").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = cut.withColumn("_inside", inside).join(starts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_chunk") == F.col("_c")))
    return whole.withColumn("before", F.col("_start") + F.col("_inside")).drop("_v", "_chunk", "_g", "_c", "_start", "_inside")


def packed(rows: DataFrame, group: str, order: str, size: str, cap: int, tail: int) -> DataFrame:
    """(group, order, part, parts) as of ``sections.pack``, for groups of any number of rows."""
    placed = written(running(ranks.numbered(rows.select(group, order, size), [order], [group], "at", "n"), group, F.col(size)), "placed")
    ends = placed.select(group, (F.col("before") + F.col(size)).alias("v"))
    below = counts_below(ends, placed.select(group, F.col("at").alias("key"), (F.col("before") + cap).alias("x")), group, True)
    # the first whose end is beyond the cap begins the next part, but not the one that this part begins with
    pointers = placed.select(group, "at", "n").join(below.select(F.col(group).alias("_g"), F.col("key"), "below"), F.col(group).eqNullSafe(F.col("_g")) & (F.col("at") == F.col("key")))
    to = F.greatest("below", F.col("at") + 1)
    begins = reached(pointers.select(group, "at", F.when(to < F.col("n"), to).alias("to")), group)
    joined = placed.join(begins.select(F.col(group).alias("_g"), F.col("at").alias("_at")), F.col(group).eqNullSafe(F.col("_g")) & (F.col("at") == F.col("_at")), "left")
    opened = joined.withColumn("begin", F.col("_at").isNotNull().cast("long")).select(group, order, size, "at", "begin")
    numbered = written(running(opened, group, F.col("begin")).withColumn("part", F.col("before") + F.col("begin")), "parts")
    facts = numbered.groupBy(group, "part").agg(F.sum(size).alias("total"))
    last = facts.groupBy(F.col(group).alias("_g")).agg(F.max("part").alias("last"), F.max_by("total", "part").alias("total"))
    small = (F.col("last") > 1) & (F.col("total") < tail)
    out = numbered.join(last, F.col(group).eqNullSafe(F.col("_g")))
    parts = F.when(small, F.col("last") - 1).otherwise(F.col("last"))
    return out.select(group, order, F.least("part", parts).cast("int").alias("part"), parts.cast("int").alias("parts"))


def thinned(events: DataFrame, group: str, order: list[str], head: str, stop: str) -> DataFrame:
    """Of events in ``order``, which ``head`` begins, those kept: the first, and each time the first whose head is not before the last one's ``stop``."""
    placed = written(ranks.numbered(events, order, [group], "at", "n"), "placed")
    below = counts_below(placed.select(group, F.col(head).alias("v")), placed.select(group, F.col("at").alias("key"), F.col(stop).alias("x")), group, False)
    pointers = placed.select(group, "at", "n").join(below.select(F.col(group).alias("_g"), "key", "below"), F.col(group).eqNullSafe(F.col("_g")) & (F.col("at") == F.col("key")))
    to = F.greatest("below", F.col("at") + 1)
    kept = reached(pointers.select(group, "at", F.when(to < F.col("n"), to).alias("to")), group)
    return placed.join(kept.select(F.col(group).alias("_g"), F.col("at").alias("_at")), F.col(group).eqNullSafe(F.col("_g")) & (F.col("at") == F.col("_at"))).drop("_g", "_at", "at", "n")
