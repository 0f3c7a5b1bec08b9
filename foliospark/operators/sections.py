"""Grouping documents into sections and cutting these to size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as tx
from foliospark.operators import ranks, successors

CAP, TAIL = 15_000, 2_000


def packed(sizes: Column, cap: int = CAP, tail: int = TAIL) -> Column:
    """Part numbers for an ordered array of sizes.

    A part is closed when it holds something and the next size would lift it
    over ``cap``; a last part below ``tail`` joins the one before it. The fold
    keeps only where parts begin, so it grows with their number.
    """
    state = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("at"), F.array(F.lit(0)).alias("begins"))

    def step(acc: Column, size: Column) -> Column:
        new = (acc["at"] > F.element_at(acc["begins"], -1)) & (acc["total"] + size > cap)
        return F.struct(F.when(new, size).otherwise(acc["total"] + size).alias("total"), (acc["at"] + 1).alias("at"), F.when(new, F.concat(acc["begins"], F.array(acc["at"]))).otherwise(acc["begins"]).alias("begins"))

    def close(acc: Column) -> Column:
        begins = acc["begins"]
        small = (F.size(begins) > 1) & (acc["total"] < tail)
        begins = F.when(small, F.slice(begins, F.lit(1), F.size(begins) - 1)).otherwise(begins)
        ends = F.concat(F.slice(begins, F.lit(2), F.size(begins)), F.array(acc["at"]))
        return F.flatten(F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda x, i: F.array_repeat(i + 1, x["b"] - x["a"])))

    return F.aggregate(sizes, state, step, close)


#: Rows of a group that are folded as one array; larger groups by pointer doubling.
LARGE = 100_000


def pack(rows: DataFrame, group: str, order: str, size: str, cap: int = CAP, tail: int = TAIL, large: int = LARGE) -> DataFrame:
    """``rows`` with part and parts within their group.

    A part's start depends on where the part before it was closed. A group of up
    to ``large`` rows is folded as one array of (order, size); of a larger one
    ``successors.packed`` finds the same parts over many tasks.
    """
    big = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > large).select(F.col(group).alias("_b"))
    spread = not big.isEmpty()
    folded = rows.join(big, F.col(group).eqNullSafe(F.col("_b")), "left_anti") if spread else rows
    lists = folded.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(size).cast("long").alias("s")))).alias("l"))
    parts = lists.select(group, F.posexplode(F.arrays_zip(F.col("l"), packed(F.transform("l", lambda x: x["s"]), cap, tail).alias("p"))).alias("at", "x"))
    numbered = parts.select(F.col(group).alias("_g"), F.col("x.l.o").alias("_o"), F.col("x.p").alias("part"))
    totals = numbered.groupBy("_g").agg(F.max("part").alias("parts")).withColumnRenamed("_g", "_t")
    if spread:
        found = successors.packed(rows.join(big, F.col(group).eqNullSafe(F.col("_b")), "left_semi"), group, order, size, cap, tail)
        numbered = numbered.unionByName(found.select(F.col(group).alias("_g"), F.col(order).alias("_o"), "part"))
        totals = totals.unionByName(found.select(F.col(group).alias("_t"), "parts").distinct())
    joined = rows.join(numbered, F.col(group).eqNullSafe(F.col("_g")) & (F.col(order) == F.col("_o")))
    return joined.join(totals, F.col(group).eqNullSafe(F.col("_t"))).drop("_g", "_o", "_t")


def short_name(title: Column) -> Column:
    """The readable part of a file name: a roman title number, else the start of the title."""
    roman = F.regexp_extract(title, r"^T[íi]tulo\s+([IVXLC]+)\b", 1)
    return F.when(roman != "", F.concat(F.lit("titulo-"), F.lower(roman))).otherwise(F.trim(F.left(tx.slugify(title), F.lit(24)), F.lit("-")))


def part_name(sequence: Column, index: Column, title: Column, part: Column, parts: Column, other: Column | None = None) -> Column:
    """File name of a part; ``other`` asks for another part of the same title."""
    number = sequence if other is None else sequence + other - part
    shown = part if other is None else other
    return F.concat(F.format_string("%02d-%02d-", number, index), short_name(title), F.when(parts > 1, F.concat(F.lit("-parte-"), shown.cast("string"))).otherwise(""), F.lit(".md"))


def ordinals(rows: DataFrame, group: str, order: str) -> DataFrame:
    """(group, index): groups numbered from 1 by the first appearance of their members."""
    first = rows.groupBy(group).agg(F.min(order).alias("_first"))
    return ranks.numbered(first, ["_first", group], position="_at").select(group, (F.col("_at") + 1).alias("index"))


def heading(title: Column, part: Column, parts: Column) -> Column:
    return F.concat(F.lit("# "), title, F.when(parts > 1, F.concat(F.lit(" — Parte "), part.cast("string"), F.lit(" de "), parts.cast("string"))).otherwise(""))


def markdown(files: DataFrame, docs: DataFrame, key: list[str], order: str, fields: list[tuple[str, str]]) -> DataFrame:
    """``files`` (``key``, title, part, parts and the fields' columns) with text: front matter, heading, the documents in order.

    ``docs``: ``key``, ``order``, citation, markdown.
    """
    block = F.concat(F.lit("**Cita:** "), "citation", F.lit("\n\n"), "markdown", F.lit("\n"))
    bodies = docs.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, block.alias("_b")))), lambda x: x["_b"]), "\n").alias("_body"))
    front = F.concat(F.lit("---"), *[x for name, column in fields for x in (F.lit(f"\n{name}: "), F.col(column).cast("string"))], F.lit("\n---\n"))
    text = F.concat(front, heading(F.col("title"), F.col("part"), F.col("parts")), F.lit("\n\n"), "_body")
    return files.join(bodies, key).withColumn("text", text).drop("_body")


def navigation(part: Column, parts: Column, previous: Column, following: Column) -> Column:
    """The line that joins the parts of a title; null where there is one part only."""
    hops = F.concat_ws(" · ", F.when(part > 1, F.concat(F.lit("anterior: `"), previous, F.lit("`"))), F.when(part < parts, F.concat(F.lit("siguiente: `"), following, F.lit("`"))))
    return F.when(parts > 1, F.concat(F.lit("*Parte "), part.cast("string"), F.lit(" de "), parts.cast("string"), F.lit(" de este Título · "), hops, F.lit("*")))
