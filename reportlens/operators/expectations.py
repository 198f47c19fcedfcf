"""Data-quality rules that look at more than one row: keys, references and distributions.

All kinds give the same report: ``rule``, ``kind``, ``checked`` rows, ``failed`` rows, ``measure``
and ``passed``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.run import land
from ..session import scratch_path


def verdict(df: DataFrame, rule: str, kind: str, limit: float) -> DataFrame:
    """One report row from ``checked``, ``failed`` and ``measure``; passed unless above the limit."""
    return df.select(
        F.lit(rule).alias("rule"),
        F.lit(kind).alias("kind"),
        F.coalesce(F.col("checked").cast("bigint"), F.lit(0).cast("bigint")).alias("checked"),
        F.coalesce(F.col("failed").cast("bigint"), F.lit(0).cast("bigint")).alias("failed"),
        F.coalesce(F.col("measure").cast("double"), F.lit(0.0)).alias("measure"),
    ).withColumn("passed", F.col("measure") <= limit)


def unique_key(df: DataFrame, rule: str, keys: Sequence[str], limit: float = 0.0) -> DataFrame:
    """Rows beyond the first of their key; NULLs in a key are equal. ``measure`` is their share.

    Counting per key is a partial aggregation, so a key with very many rows costs one row a task.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counted = per_key.agg(F.sum("n").alias("checked"), F.sum(F.col("n") - 1).alias("failed"))
    return verdict(counted.withColumn("measure", F.try_divide("failed", "checked")), rule, "unique key", limit)


def references(
    df: DataFrame, rule: str, key: str, target: DataFrame, target_key: str, limit: float = 0.0
) -> DataFrame:
    """Rows whose key is missing in ``target``; rows without a key are not checked.

    Rows are counted per key before the join, so a key with very many rows joins as one.
    """
    per_key = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    known = target.select(F.col(target_key).alias("key")).where("key is not null").distinct().withColumn("known", F.lit(True))
    joined = per_key.join(known, "key", "left")
    counted = joined.agg(
        F.sum("n").alias("checked"), F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).alias("failed")
    )
    return verdict(counted.withColumn("measure", F.try_divide("failed", "checked")), rule, "reference", limit)


def shift(earlier: DataFrame, later: DataFrame, rule: str, column: str, limit: float) -> DataFrame:
    """How far the distribution of a column moved between two loads.

    ``measure`` is the total variation distance: half the sum of the differences of the shares.
    ``failed`` counts the later rows above the earlier share of their value. NULL is a value.
    """
    loads = earlier.select(F.col(column).alias("value"), F.lit(0).alias("load")).unionByName(
        later.select(F.col(column).alias("value"), F.lit(1).alias("load"))
    )
    counts = loads.groupBy("value").agg(F.count_if(F.col("load") == 0).alias("before"), F.count_if(F.col("load") == 1).alias("after"))
    counts = land(counts, scratch_path(earlier.sparkSession, "value-counts"))
    n_before, n_after = counts.agg(F.sum("before"), F.sum("after")).first()
    gap = F.col("after") / float(n_after or 1) - F.col("before") / float(n_before or 1)
    counted = counts.agg(
        F.sum("after").alias("checked"),
        F.round(F.sum(F.greatest(gap, F.lit(0.0))) * float(n_after or 0)).alias("failed"),
        (F.sum(F.abs(gap)) / 2).alias("measure"),
    )
    return verdict(counted, rule, "shift", limit)


def row_rule(df: DataFrame, rule: str, condition: Column, limit: float = 0.0) -> DataFrame:
    """Rows that don't meet a condition; NULL doesn't."""
    counted = df.agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(~F.coalesce(condition, F.lit(False))).alias("failed")
    )
    return verdict(counted.withColumn("measure", F.try_divide("failed", "checked")), rule, "row", limit)


def expectation_report(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)
