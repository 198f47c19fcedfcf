"""Approximate nearest neighbours with balanced posting lists.

A bounded sample is split into balanced clusters; their centroids, at most ``MAX_CENTROIDS``,
are joined to a neighbour graph that every task holds in memory. The graph is searched to find
the lists of a vector and of a query:

* a vector goes to its nearest cluster and, near a boundary, to further ones whose centroid is
  hardly farther; a centroid that lies closer to an already chosen one than to the vector is
  passed over, since it would repeat the same direction;
* a query reads the lists whose centroid is at most ``PROBE_RATIO`` times as far as the nearest,
  and further ones, nearest first, until they are sure to hold k others; a query that still
  finds fewer is compared with all vectors.

Equal vectors are one entry with its smallest ids, of which an answer can hold no more than the
first k + 1; long lists are dealt into parts, so a frequent vector or a dense cluster stays
within the memory of a task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import land
from .vectors import matrix, usable

#: Bounds of what is fitted and broadcast: sampled vectors and centroids.
SAMPLE = 20_000
MAX_CENTROIDS = 8192
LIST = 100
LIST_PART = 4096
#: Queries that are compared with all vectors by one task at a time.
SCANNED = 1024
REPLICAS = 6
BOUNDARY_RATIO = 1.15
PROBES = 64
PROBE_RATIO = 1.35
DEGREE = 16


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0)


def balanced_centroids(x: np.ndarray, want: int, branch: int = 16, rounds: int = 8) -> np.ndarray:
    """About ``want`` centroids of evenly filled clusters, by repeated balanced k-means.

    In each round a vector pays for the size its cluster had, so that full clusters shed
    vectors; parts are split on in proportion to their size.
    """
    if want <= 1 or len(x) <= 2:
        return x.mean(axis=0, keepdims=True)
    parts = min(branch, want, len(x))
    centers = x[np.linspace(0, len(x) - 1, parts).astype(int)]
    sizes = np.full(parts, len(x) / parts)
    for _ in range(rounds):
        away = squared(x, centers)
        fine = away.min(axis=1).mean() / (len(x) / parts)
        nearest = (away + 0.5 * fine * sizes).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=parts).astype(float)
        for c in np.flatnonzero(sizes):
            centers[c] = x[nearest == c].mean(axis=0)
    found = []
    for c in np.flatnonzero(sizes):
        share = round(want * sizes[c] / len(x))
        if sizes[c] == len(x):  # equal vectors can't be split
            return centers[c : c + 1]
        found.append(balanced_centroids(x[nearest == c], share, branch, rounds))
    return np.concatenate(found)


@dataclass
class CentroidGraph:
    """Centroids, each linked with its nearest ones, and the entry points of a search."""

    centers: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    @classmethod
    def build(cls, centers: np.ndarray) -> CentroidGraph:
        n = len(centers)
        degree = min(DEGREE, n - 1)
        links = np.zeros((n, max(degree, 1)), dtype=np.int32)
        for at in range(0, n, 1024):
            away = squared(centers[at : at + 1024], centers)
            away[np.arange(len(away)), np.arange(at, at + len(away))] = np.inf
            if degree:
                links[at : at + 1024] = np.argpartition(away, degree - 1, axis=1)[:, :degree]
        return cls(centers, links, np.unique(np.linspace(0, n - 1, min(n, 32)).astype(np.int32)))

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest centroids found for each row and their distances, nearest first.

        A best-first walk for all rows together: in each turn every row opens its nearest
        centroid not yet opened and meets that one's neighbours.
        """
        width = min(width, len(self.centers))
        rows = np.arange(len(x))[:, None]
        norms = (self.centers**2).sum(1)
        own = (x**2).sum(1)[:, None]

        def distance(at: np.ndarray) -> np.ndarray:
            return own - 2 * np.einsum("ijk,ik->ij", self.centers[at], x) + norms[at]

        beam = np.repeat(self.entries[None], len(x), axis=0)
        away, opened = distance(beam), np.zeros(beam.shape, dtype=bool)
        met = np.zeros((len(x), len(self.centers)), dtype=bool)
        met[:, self.entries] = True
        for _ in range(4 * width + 8):
            waiting = np.where(opened, np.inf, away)
            pick = waiting.argmin(axis=1)
            if not np.isfinite(waiting[rows[:, 0], pick]).any():
                break
            opened[rows[:, 0], pick] = True
            near = self.links[beam[rows[:, 0], pick]]
            fresh = np.where(met[rows, near], np.inf, distance(near))
            met[rows, near] = True
            beam = np.concatenate([beam, near], axis=1)
            away = np.concatenate([away, fresh], axis=1)
            opened = np.concatenate([opened, ~np.isfinite(fresh)], axis=1)
            if beam.shape[1] > width:
                first = np.argpartition(away, width - 1, axis=1)[:, :width]
                beam, away, opened = beam[rows, first], away[rows, first], opened[rows, first]
        first = np.argsort(away, axis=1, kind="stable")
        return beam[rows, first], np.sqrt(np.maximum(away[rows, first], 0))

    def homes(self, x: np.ndarray) -> list[list[int]]:
        """The clusters that hold each vector."""
        found, away = self.search(x, 3 * REPLICAS)
        out = []
        for at, d in zip(found, away):
            chosen: list[int] = []
            for c, dc in zip(at, d):
                if len(chosen) == REPLICAS or dc > BOUNDARY_RATIO * d[0] or not np.isfinite(dc):
                    break
                if all(((self.centers[c] - self.centers[o]) ** 2).sum() > dc * dc for o in chosen):
                    chosen.append(int(c))
            out.append(chosen or [int(at[0])])
        return out

    def probes(self, x: np.ndarray, sizes: np.ndarray, kept: int) -> list[list[int]]:
        """The clusters that each query reads, of which ``sizes`` has the numbers of entries.

        An entry is in at most ``REPLICAS`` lists, so that many times ``kept`` hold ``kept`` entries.
        """
        found, away = self.search(x, PROBES)
        out = []
        for at, d in zip(found, away):
            before = np.cumsum(sizes[at]) - sizes[at]
            wanted = (d <= PROBE_RATIO * d[0] + 1e-12) | (before < kept * REPLICAS)
            out.append(list(map(int, at[wanted & np.isfinite(d)])))
        return out


def with_clusters(df: DataFrame, lists_of: Callable[[np.ndarray], list[list[int]]]) -> DataFrame:
    """``df`` with the column ``clusters``; its rows hold a vector ``v``."""

    def assign(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for at in range(0, len(table), 1024):
                part = table.slice(at, 1024)
                x = matrix(part.column("v"))
                yield from part.append_column("clusters", pa.array(lists_of(x), pa.list_(pa.int32()))).to_batches()

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(assign, f"{kinds}, clusters array<int>")


def nearest_in_list(entries: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k nearest entries of one list part for each of its queries."""
    out: dict[str, list] = {"asker": [], "entry": [], "ids": [], "score": []}
    x, q = matrix(entries.column("v")), matrix(queries.column("v"))
    if len(x) and len(q):
        names, ids = entries.column("u").to_numpy(), entries.column("ids").to_pylist()
        smallest = np.array([i[0] for i in ids])
        for asker, vector in zip(queries.column("u").to_pylist(), q):
            away = np.sqrt(((x - vector) ** 2).sum(axis=1))
            for i in np.lexsort((smallest, away))[:k]:
                out["asker"].append(asker)
                out["entry"].append(int(names[i]))
                out["ids"].append(ids[i])
                out["score"].append(float(away[i]))
    kinds = {"asker": pa.int64(), "entry": pa.int64(), "ids": pa.list_(pa.int64()), "score": pa.float64()}
    return pa.table({n: pa.array(c, kinds[n]) for n, c in out.items()})


NEAREST = "asker long, entry long, ids array<long>, score double"


def first_ids(found: DataFrame, kept: int) -> DataFrame:
    """The first ``kept`` ids of every asker. An entry met in several lists counts once."""
    entries = found.groupBy("asker", "entry").agg(F.first("ids").alias("ids"), F.min("score").alias("score"))
    by_score = Window.partitionBy("asker").orderBy("score", "vec_id")
    return (
        entries.select("asker", "score", F.explode("ids").alias("vec_id"))
        .withColumn("place", F.row_number().over(by_score))
        .where(F.col("place") <= kept)
        .groupBy("asker")
        .agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("answer"))
    )


def exact_scan(unique: DataFrame, n: int, askers: DataFrame, n_askers: int, kept: int) -> DataFrame:
    """The ``kept`` nearest entries of every part of ``unique`` for all ``askers`` (u, v), block by block."""
    parts, blocks = -(-n // LIST_PART), -(-n_askers // SCANNED)
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    dealt = lambda count: F.pmod(F.xxhash64("u"), F.lit(count)).cast("int")
    entries = unique.select("u", "v", "ids", dealt(parts).alias("part"), every(blocks).alias("block"))
    asking = askers.select("u", "v", dealt(blocks).alias("block"), every(parts).alias("part"))
    return (
        entries.groupBy("part", "block")
        .cogroup(asking.groupBy("part", "block"))
        .applyInArrow(lambda left, right: nearest_in_list(left, right, kept), NEAREST)
    )


def nearest(
    table: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k nearest other vectors found for every ``every``-th id: query_id, rank, vec_id, score.

    Nearness is Euclidean distance in double precision on the given vectors; ties go to the
    smaller id; only with fewer candidates there are fewer rows. See ``usable`` for the vectors that
    take part; zero vectors don't. Approximate: of the true neighbours some may be missing.
    """
    kept = k + 1
    keys = [F.xxhash64(F.lit(seed), "v").alias(f"k{seed}") for seed in (1, 2)]
    whole = land(usable(table, id_col, vector_col, zero_ok=False).select("id", "v", *keys), "vectors")
    same = Window.partitionBy("k1", "k2").orderBy("id")
    unique = (
        whole.withColumn("nth", F.row_number().over(same))
        .where(F.col("nth") <= kept)
        .groupBy("k1", "k2")
        .agg(F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("u", F.monotonically_increasing_id())
    )
    unique = land(unique, "unique")
    n = unique.count()
    if not n:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = matrix(unique.orderBy("k1", "k2").limit(SAMPLE).select("v").toArrow().column("v"))
    want = max(1, min(MAX_CENTROIDS, n // LIST, len(sample) // 4))
    graph = CentroidGraph.build(balanced_centroids(sample, want))

    homes = with_clusters(unique.select("u", "v", "ids"), graph.homes)
    listed = land(homes.withColumn("cluster", F.explode("clusters")).drop("clusters"), "lists")
    # MAX_CENTROIDS rows at most.
    counts = {r["cluster"]: r["count"] for r in listed.groupBy("cluster").count().collect()}
    sizes = np.array([counts.get(c, 0) for c in range(len(graph.centers))])
    parts = {c: -(-count // LIST_PART) for c, count in counts.items()}
    parts_of = F.create_map(*[F.lit(x) for c, p in parts.items() if p > 1 for x in (c, p)] or [F.lit(-1), F.lit(1)])
    n_parts = F.coalesce(F.try_element_at(parts_of, "cluster"), F.lit(1))

    asked = whole.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "k1", "k2")
    askers = land(asked.join(unique.select("u", "v", "k1", "k2"), ["k1", "k2"]).select("query_id", "u", "v"), "askers")
    probing = with_clusters(askers.groupBy("u").agg(F.first("v").alias("v")), lambda x: graph.probes(x, sizes, kept))
    probing = (
        probing.withColumn("cluster", F.explode("clusters"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1)))
        .select("u", "v", "cluster", "part")
    )
    dealt = listed.withColumn("part", F.pmod(F.xxhash64("u"), n_parts).cast("int"))
    found = (
        dealt.groupBy("cluster", "part")
        .cogroup(probing.groupBy("cluster", "part"))
        .applyInArrow(lambda left, right: nearest_in_list(left, right, kept), NEAREST)
    )
    answers = land(first_ids(found, kept), "answers")
    complete = answers.where(F.size("answer") >= min(kept, whole.count()))
    short = askers.select("u", "v").dropDuplicates(["u"]).join(complete, F.col("u") == F.col("asker"), "left_anti")
    short = land(short, "short")
    n_short = short.count()
    if n_short:
        scanned = first_ids(exact_scan(unique, n, short, n_short, kept), kept)
        answers = complete.unionByName(land(scanned, "scanned"))
    others = F.filter("answer", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        askers.select("query_id", F.col("u").alias("asker"))
        .join(answers, "asker")
        .select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "hit"))
        .select(
            "query_id",
            (F.col("at") + 1).cast("int").alias("rank"),
            F.col("hit.vec_id").alias("vec_id"),
            F.col("hit.score").alias("score"),
        )
    )
