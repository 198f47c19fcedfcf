"""k-means over profiles, as one aggregation per round.

Seeds come from k-means||: each round draws every point with a probability proportional to its
squared distance from the seeds so far, so a few rounds find seeds for all of them; the points
nearest to each are its weight, and the few weighted seeds are reduced to k. Lloyd's rounds then
assign each point to its nearest centre, a literal in the plan, and add up the coordinates.

Everything repeats exactly: draws depend on keys, and coordinates are whole numbers, multiples of
``UNIT``, so their sums don't depend on the order of the rows. Centres are landed after each round;
a run that broke off goes on from the last of them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.run import land
from ..session import scratch_path
from ..sources.files import file_sizes, path_exists

#: Resolution of a coordinate.
UNIT = 2.0**-20
#: Rounds of drawing seeds, and how many seeds a round expects, as a multiple of k.
DRAWS, PER_DRAW = 5, 2
CENTRES = "place int, centre array<double>, n bigint"

Centres = list[tuple[float, ...]]


def as_points(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """``key`` and ``x``, the features as whole multiples of ``UNIT``; a null or missing number is 0."""
    values = [F.coalesce(F.round(F.col(f).cast("double") / UNIT), F.lit(0.0)) for f in features]
    whole = [F.when(F.isnan(v), F.lit(0.0)).otherwise(v).cast("bigint") for v in values]
    return df.select(F.col(key).alias("key"), F.array(*whole).alias("x"))


def squared(x: Column, centre: Sequence[float]) -> Column:
    """Squared distance of a point from a centre, both in multiples of ``UNIT``."""
    total = F.lit(0.0)
    for place, c in enumerate(centre):
        gap = x[place].cast("double") - F.lit(float(c))
        total = total + gap * gap
    return total


def nearest(x: Column, centres: Centres) -> Column:
    """Distance and number of the nearest centre; ties go to the first."""
    return F.array_min(
        F.array(*[F.struct(squared(x, c).alias("distance"), F.lit(i).alias("place")) for i, c in enumerate(centres)])
    )


def chance(key: Column, turn: int) -> Column:
    """A number in [0, 1) that depends on the key and the round."""
    digits = F.substring(F.md5(F.concat_ws("\x1f", F.lit(str(turn)), key.cast("string"))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 52)


def drawn_seeds(points: DataFrame, k: int) -> Centres:
    """Some ``DRAWS * PER_DRAW * k`` seeds by k-means||, in the order of draws and keys."""
    first = points.orderBy(chance(F.col("key"), 0), F.col("key")).select("x").first()
    seeds: Centres = [tuple(map(float, first.x))]
    for turn in range(1, DRAWS + 1):
        placed = points.withColumn("distance", nearest(F.col("x"), seeds)["distance"])
        # Whole numbers: the sum doesn't depend on the order of the rows.
        total = placed.agg(F.sum(F.col("distance").cast("decimal(38,0)"))).first()[0]
        if not total:
            break
        drawn = placed.where(chance(F.col("key"), turn) * float(total) < F.col("distance") * PER_DRAW * k)
        found = drawn.select("key", "x").orderBy("key").collect()  # about PER_DRAW * k rows
        seeds += [tuple(map(float, row.x)) for row in found]
    return list(dict.fromkeys(seeds))


def reduced(seeds: Centres, weights: Sequence[int], k: int) -> Centres:
    """k of the weighted seeds: the heaviest, then always the one with the largest weighted distance."""
    x, w = np.array(seeds), np.array(weights, dtype=np.float64)
    chosen = [int(np.argmax(w))]
    while len(chosen) < min(k, len(seeds)):
        gaps = ((x[:, None, :] - x[chosen][None]) ** 2).sum(axis=2).min(axis=1) * w
        if gaps.max() == 0:
            break
        chosen.append(int(np.argmax(gaps)))
    return [tuple(x[i].tolist()) for i in chosen]


def sums_per_centre(points: DataFrame, centres: Centres) -> DataFrame:
    """``place, centre, n``: the mean of the points nearest to each centre; one that has none stays."""
    width = len(centres[0])
    assigned = points.withColumn("place", nearest(F.col("x"), centres)["place"])
    sums = [F.sum(F.col("x")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]
    mean = F.array(*[F.col(f"s{i}").cast("double") / F.col("n").cast("double") for i in range(width)])
    return assigned.groupBy("place").agg(F.count(F.lit(1)).alias("n"), *sums).select("place", mean.alias("centre"), "n")


def landed_centres(spark: SparkSession, state: str) -> dict[int, list]:
    """The last complete round and its rows; a round is one file, which is there once it is complete."""
    rounds = f"{state}/round=*/*.parquet"
    if not path_exists(spark, rounds):
        return {}
    number = F.regexp_extract("path", r"round=(\d+)", 1).cast("int")
    last = file_sizes(spark, rounds).agg(F.max(number)).first()[0]
    return {last: spark.read.schema(CENTRES).parquet(f"{state}/round={last}").orderBy("place").collect()}


def k_means(points: DataFrame, k: int, max_rounds: int = 50, state: str | None = None) -> tuple[Centres, int]:
    """Centres of the converged clustering, in multiples of ``UNIT``, and the rounds it took.

    Converged means that no centre changed. With ``state``, a folder all executors share, a second
    call goes on from the last complete round.
    """
    spark = points.sparkSession
    state = state or scratch_path(spark, "k-means")
    known = landed_centres(spark, state)
    if known:
        (turn, rows), = known.items()
        centres = [tuple(row.centre) for row in rows]
    else:
        seeds = drawn_seeds(points, k)
        weights = {row.place: row.n for row in sums_per_centre(points, seeds).collect()}
        centres, turn = reduced(seeds, [weights.get(i, 0) for i in range(len(seeds))], k), 0
    while turn < max_rounds:
        turn += 1
        found = {row.place: row for row in sums_per_centre(points, centres).collect()}  # k rows
        moved = [tuple(found[i].centre) if i in found else c for i, c in enumerate(centres)]
        rows = [(i, list(c), found[i].n if i in found else 0) for i, c in enumerate(moved)]
        land(spark.createDataFrame(rows, CENTRES).coalesce(1), f"{state}/round={turn}")
        if moved == centres:
            break
        centres = moved
    return centres, turn


def clusters(
    df: DataFrame, key: str, features: Sequence[str], k: int, max_rounds: int = 50, state: str | None = None
) -> DataFrame:
    """``key``, ``cluster`` (numbered from 0 by the centres' order) and ``distance`` from its centre.

    Features should have like scales. Fewer different profiles than ``k`` make fewer clusters; an
    empty table gives no row.
    """
    spark = df.sparkSession
    points = land(as_points(df, key, features), scratch_path(spark, "points"))
    if points.isEmpty():
        return points.select(F.col("key").alias(key), F.lit(0).alias("cluster"), F.lit(0.0).alias("distance"))
    centres, _ = k_means(points, k, max_rounds, state)
    best = nearest(F.col("x"), sorted(centres))
    return points.select(
        F.col("key").alias(key),
        best["place"].alias("cluster"),
        (F.sqrt(best["distance"]) * UNIT).alias("distance"),
    )
