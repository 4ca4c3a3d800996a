"""Mixes sources to target weights by pivotal dependent rounding.

A source's target, divided by its size, is the number of copies each of its documents should have. Whole copies
are given at once; the fractional rest is settled pairwise. In a pair, mass (expected words) moves from one
document to the other, in a random direction whose odds keep every document's expectation, until one of the
two holds a whole copy or none. The other goes on with what it holds. Pairs are settled inside small blocks,
blocks hand their one open document to the next level of a reduction tree, and so on up to the source. Moving
words, not copies, keeps a source's sum exact through the whole tree; its last open document is cut to
the words that are still missing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyport.llm.columns import PLAIN_WORD
from tallyport.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
_DIGIT = 32


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, the number of words between white space; 0 for null and empty texts."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(PLAIN_WORD)), F.lit(0)).cast("long"))


def source_targets(sizes: DataFrame, share: float = 1.5, limit: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of each source.

    ``share`` times all sizes are dealt by weight. A source stops at ``limit`` times its size and the excess is
    dealt to the others by weight until none is above. That end state is a common level times each weight,
    cut at the limits: with sources in the order of limit over weight, the level is the largest of
    (words - limits before) / (weights from here on). One row per source goes through the windows.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = per_source.withColumn("_weight", F.get(F.array(*[F.lit(w) for w in weights]), turn))
    weighed = weighed.withColumn("_most", F.col("source_size") * F.lit(limit))
    order = Window.orderBy(F.col("_most") / F.col("_weight"), F.asc_nulls_last("source"))
    everything = Window.partitionBy(F.lit(1))
    before = F.coalesce(F.sum("_most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) * F.lit(share) - before) / rest
    return (
        weighed.withColumn("_level", level).withColumn("_level", F.max("_level").over(everything))
        .select("source", "source_size", F.least("_most", F.col("_level") * F.col("_weight")).alias("target"))
    )


def _settle(state: Column, other: Column, seed: int) -> Column:
    """One pair: the open document of ``state`` and ``other``. The settled one joins ``done``."""
    def moved(pair):
        a, b = pair["a"], pair["b"]
        up = F.least(a["size"] - a["mass"], b["mass"])
        down = F.least(a["mass"], b["size"] - b["mass"])
        draw = F.pmod(F.xxhash64(F.lit(seed), a["id"], a["tie"], b["id"], b["tie"]), F.lit(1 << 52)) / F.lit(float(1 << 52))
        return F.struct(a.alias("a"), b.alias("b"), up.alias("up"), down.alias("down"), (draw * (up + down) < down).alias("rises"))

    def settled(move):
        a, b, up, down, rises = (move[x] for x in ("a", "b", "up", "down", "rises"))
        first_done = F.when(rises, a["size"] - a["mass"] <= b["mass"]).otherwise(a["mass"] <= b["size"] - b["mass"])
        closed = F.when(first_done, a).otherwise(b)
        left = F.when(first_done, b).otherwise(a)
        mass = F.when(first_done, b["mass"] + F.when(rises, -up).otherwise(down)).otherwise(
            a["mass"] + F.when(rises, up).otherwise(-down))
        # a rising first document takes from the second: first full or second empty; else the other way round
        copy = F.when(rises == first_done, F.lit(1)).otherwise(F.lit(0))
        return F.struct(
            _item(left, mass).alias("open"),
            F.concat(state["done"], F.array(F.struct(
                closed["id"].alias("id"), closed["source"].alias("source"), closed["size"].cast("long").alias("size"),
                copy.cast("double").alias("part")))).alias("done"),
        )

    pair = F.array(F.struct(state["open"].alias("a"), other.alias("b")))
    both = F.get(F.transform(F.transform(pair, moved), settled), 0)
    return F.when(state["open"].isNull(), F.struct(other.alias("open"), state["done"].alias("done"))).otherwise(both)


def _item(item: Column, mass: Column) -> Column:
    return F.struct(*[(mass if f == "mass" else item[f]).alias(f) for f in ("size", "tie", "id", "source", "whole", "mass", "step", "spot")])


def _level(items: DataFrame, keys: list[Column], seed: int) -> DataFrame:
    """Settle the items of each group, large documents first; a row per group with ``open`` and ``done``."""
    kind = "struct<size:double,tie:bigint,id:bigint,source:string,whole:double,mass:double,step:int,spot:bigint>"
    start = F.struct(F.lit(None).cast(kind).alias("open"), F.array().cast("array<struct<id:bigint,source:string,size:bigint,part:double>>").alias("done"))
    ordered = F.array_sort(F.col("_items"), lambda x, y: F.when(x["size"] > y["size"], -1).when(x["size"] < y["size"], 1)
                           .when(x["tie"] < y["tie"], -1).when(x["tie"] > y["tie"], 1).otherwise(0))
    return (
        items.groupBy(*keys).agg(F.collect_list("item").alias("_items"))
        .select(F.aggregate(ordered, start, lambda state, other: _settle(state, other, seed)).alias("r"))
        .select("r.open", "r.done")
    )


def mix(docs: DataFrame, share: float = 1.5, limit: float = 2.0, weights=WEIGHTS, seed: int = 17) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``copies`` are whole but for at most one document a source, whose ``taken`` words are rounded. ``taken``
    is never above ``limit`` times the size when ``limit`` is whole. Sources that are null form one source. Null
    and empty texts have size 0 and take nothing. Draws depend on seed, ids and texts, so runs agree; rows
    that repeat entirely are told apart by nothing and share no draw, only their sum matters.
    """
    narrow = sized(docs).select("doc_id", "source", "size", F.xxhash64("text", "doc_id").alias("tie"))
    sizes = cut_lineage(narrow)
    total = sizes.count()
    depth = max(0, math.ceil(math.log(max(1, total / _DIGIT), _DIGIT)))
    targets = cut_lineage(source_targets(sizes, share, limit, weights))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    dealt = (
        sizes.withColumnRenamed("source", "_s").join(targets, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
        .withColumn("ratio", ratio).withColumn("whole", F.floor("ratio").cast("double"))
    )
    mass = (F.col("ratio") - F.col("whole")) * F.col("size")
    is_open = (F.col("size") > 0) & (F.col("ratio") > F.col("whole"))
    # like sizes meet first: eight classes per doubling of the size
    step = F.floor(F.log2(F.col("size").cast("double")) * 8).cast("int")
    item = F.struct(
        F.col("size").cast("double").alias("size"), "tie", F.col("doc_id").alias("id"), "source", "whole", mass.alias("mass"),
        step.alias("step"), F.pmod("tie", F.lit(_DIGIT ** depth)).alias("spot"),
    )
    items = dealt.filter(is_open).select(item.alias("item"))
    source, digits = F.col("item.source"), F.col("item.spot")
    parts = []
    for level in range(depth, -2, -1):
        keys = [source, F.col("item.step"), digits % (_DIGIT ** level)] if level >= 0 else [source]
        # written, so that a level is settled once and no plan holds the levels before it
        settled = cut_lineage(_level(items, keys, seed + level))
        parts.append(settled.select(F.explode("done").alias("d")).select("d.*"))
        items = settled.filter("open IS NOT NULL").select(F.col("open").alias("item"))
    last = items.select(
        "item.id", "item.source", F.col("item.size").cast("long").alias("size"),
        F.least(F.greatest(F.col("item.mass") / F.col("item.size"), F.lit(0.0)), F.lit(1.0)).alias("part"))
    settled_all = last
    for part in parts:
        settled_all = settled_all.unionByName(part)
    closed = dealt.filter(~is_open).select(F.col("doc_id").alias("id"), "source", "size", F.lit(0.0).alias("part"))
    done = settled_all.unionByName(closed).withColumnRenamed("source", "_s")
    copies = F.floor(ratio) + F.col("part")
    return (
        done.join(targets, F.col("_s").eqNullSafe(F.col("source")))
        .select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", copies.cast("double").alias("copies"),
                F.round(copies * F.col("size")).cast("long").alias("taken"))
    )
