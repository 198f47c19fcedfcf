"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Sizes are words. A source's target is its weight's share of all words, at most ``MAX_COPIES``
times the source; what capped sources cannot take is shared by weight among the others. Of
every document as many whole copies are certain as fit into target / size of its source; the
rest of the target is filled by a Pareto order sample: documents are ranked by the odds of a
keyed uniform number divided by their inclusion odds, and the first of that order are taken
while their words fit. What then fits the gap that remains is drawn on in the same order, until
no free document fits; one more closes the last gap if that helps. A document larger than the
rest has inclusion probability 0; that of the others grows with their size and adds up to the
rest in expected words, so probabilities differ between sources and within them.

Order statistics of a source come from counts by rank bucket: only the one bucket in which the
target falls is sorted, so a source with a third of all rows does not pass through one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, land

MAX_COPIES = 3
#: Rank buckets of a source; documents of one bucket are ordered in one task.
BUCKETS = 1 << 16


def word_count(text: Column) -> Column:
    """Number of maximal runs of other characters than the six ASCII white spaces; 0 for null.

    White space becomes one kind of space first, so that counting needs no regular expression:
    a word starts wherever a non-space follows a space.
    """
    marked = F.regexp_replace(text, f"[^{SPACES}]+", "w")
    return F.coalesce(F.length(F.translate(marked, " \t\n\x0b\f\r", "")), F.lit(0)).cast("long")


def uniform(*keys: Column) -> Column:
    """A number in (0, 1) that depends on the keys only: 52 bits of their MD5."""
    joined = F.concat_ws("\x1f", *[F.coalesce(k.cast("string"), F.lit("\x1e")) for k in keys])
    return (F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``source``, ``source_size`` and ``target``; weights repeat over the sources in code point
    order, null last.

    Sources are capped in the order of size / weight. The level at which the uncapped ones share
    the rest is that of the first source, in this order, whose cap the level doesn't reach.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source, however many documents.
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    kinds = F.array(*map(F.lit, weights))
    place = (F.row_number().over(in_order) - 1) % len(weights)
    weighted = by_source.withColumn("weight", F.element_at(kinds, place.cast("int") + 1)).withColumn(
        "cap", MAX_COPIES * F.col("source_size")
    )
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    below = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    at_or_above = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(below), F.lit(0))
    leveled = weighted.withColumn("level", rest / F.sum("weight").over(at_or_above))
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level"))))
    level = open_level.over(everywhere)["level"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return leveled.select("source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


def first_that_fit(free: DataFrame) -> DataFrame:
    """``free`` with ``taken``: the first of each source by rank whose words together fit its ``gap``.

    Only the bucket in which a source's words exceed the gap is put in order.
    """
    by_bucket = free.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    border = (
        by_bucket.withColumn("before", upto - F.col("words"))
        .where(F.col("before") < F.col("gap"))
        .groupBy(F.col("source").alias("name"))
        .agg(F.max(F.struct("bucket", "before")).alias("last"))
        .select("name", F.col("last.bucket").alias("last_bucket"), F.col("last.before").alias("before"))
    )
    border = land(border, "border")
    placed = free.join(border, free["source"].eqNullSafe(border["name"])).drop("name")
    within = Window.partitionBy("source").orderBy("rank", "doc_id", "size", "row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    reached = F.col("before") + F.sum("size").over(within)
    edge = placed.where("bucket = last_bucket").withColumn("taken", reached <= F.col("gap"))
    others = placed.where("bucket <> last_bucket").withColumn("taken", F.col("bucket") < F.col("last_bucket"))
    return others.unionByName(edge).drop("last_bucket", "before")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), seed: str = "mix", row_col: str | None = None
) -> DataFrame:
    """Per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``copies``.

    ``row_col``, if given, holds a different number for every row of ``docs`` and comes back as ``row``.

    Reads ``doc_id``, ``text`` and ``source``; other columns are ignored. A null source is a
    source of its own, the last. A null or blank text has size 0 and takes 0 words (its copies
    are the certain ones). Documents of equal rank are told apart by id and size; fully equal
    rows are interchangeable. An empty table gives no row.
    """
    # The numbers tell equal rows apart; they are fixed by landing them.
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        (F.col(row_col).cast("long") if row_col else F.monotonically_increasing_id()).alias("row"),
    )
    sizes = land(sized, "sizes")
    targets = land(source_targets(sizes, weights), "targets").withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    )
    targets = targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    named = targets.withColumnRenamed("source", "name")
    joined = sizes.join(named, sizes["source"].eqNullSafe(named["name"])).drop("name")

    small = F.when(F.col("size") <= F.col("rest"), F.col("size"))
    # Whole numbers, so that the sums don't depend on the order of the rows.
    square = (small.cast("decimal(14,0)") * small.cast("decimal(14,0)")).cast("decimal(28,0)")
    fits = joined.groupBy("source").agg(
        F.sum(small).alias("fitting"), F.sum(square).cast("double").alias("squares"), F.max(small).alias("largest")
    )
    fits = land(fits, "fits").withColumnRenamed("source", "name")
    ready = joined.join(fits, joined["source"].eqNullSafe(fits["name"])).drop("name")
    share = F.least(F.try_divide("rest", "fitting"), F.lit(1 - 2.0**-20))
    # The word-weighted mean of the second factor is 0: the expected words stay those of the share.
    above = F.try_divide("size", "largest") - F.try_divide("squares", F.col("fitting") * F.col("largest").cast("double"))
    chance = share + share * (1 - share) * above
    drawn = uniform(F.lit(seed), F.col("source"), F.col("doc_id"))
    odds = F.try_divide(drawn * (1 - chance), (1 - drawn) * chance)
    fitting = (F.col("size") > 0) & (F.col("size") <= F.col("rest")) & (F.col("rest") > 0)
    # q / (1 + q) keeps the order of the quotient q of odds and spreads it over (0, 1).
    ranked = ready.withColumn("rank", F.when(fitting, odds / (1 + odds))).withColumn(
        "bucket", F.floor(F.col("rank") * BUCKETS)
    )

    ranked = land(ranked.drop("fitting", "squares", "largest"), "ranked")
    free = ranked.where("bucket is not null").select("row", "source", "doc_id", "size", "rank", "bucket", "rest")
    free = free.withColumnRenamed("rest", "gap")
    taken: list[DataFrame] = []
    # Every turn takes a document at least and ends before one that is larger than the new gap.
    while not free.isEmpty():
        drawn = land(first_that_fit(free), "drawn")
        taken.append(drawn.where("taken").select("row"))
        used = drawn.groupBy(F.col("source").alias("name")).agg(
            (F.first("gap") - F.sum(F.when(F.col("taken"), F.col("size")).otherwise(0))).alias("gap")
        )
        used = land(used, "gaps")
        left = drawn.where("not taken").drop("gap", "taken")
        left = left.join(used, left["source"].eqNullSafe(used["name"])).drop("name")
        free = land(left.where("size <= gap"), "free")

    def with_more(rows: DataFrame, more: DataFrame) -> DataFrame:
        added = F.col("extra") + F.coalesce("more", F.lit(0))
        return rows.join(more.select("row", F.lit(1).alias("more")), "row", "left").withColumn("extra", added).drop("more")

    filled = ranked.withColumn("extra", F.lit(0))
    if taken:
        filled = land(with_more(filled, reduce(DataFrame.unionByName, taken)), "filled")
    gaps = filled.groupBy(F.col("source").alias("name")).agg(
        (F.first("rest") - F.sum(F.col("size") * F.col("extra"))).alias("gap")
    )
    gaps = land(gaps, "gaps")
    unused = filled.where("extra = 0 and rank is not null")
    off = F.abs(F.col("size") - F.col("gap"))
    closing = (
        unused.join(gaps, unused["source"].eqNullSafe(gaps["name"]))
        .where(off < F.col("gap"))
        .groupBy("name")
        .agg(F.min(F.struct(off, "rank", "doc_id", "row")).alias("best"))
        .select(F.col("best.row").alias("row"))
    )
    chosen = with_more(filled, closing)
    copies = F.least(F.col("whole") + F.col("extra"), F.lit(MAX_COPIES))
    return chosen.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * copies).cast("long").alias("taken"),
        copies.cast("int").alias("copies"),
        "source",
        *(["row"] if row_col else []),
    )
