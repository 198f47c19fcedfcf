"""Near copies by an exact Jaccard join of word shingles: grouped prefix join.

Two documents link when 100 * |intersection| >= 75 * |union| of their shingle sets.

1. Documents with equal sets are one class.
2. All sets are ordered alike: shingles known to be frequent last, else by hash. Sets that link
   share a shingle among the first n - ceil(0.75 n) + 1 of their n. Classes with the same prefix
   and size form one group; groups meet in the posting lists of their prefix shingles.
3. Lists with one group are dropped; the others are expanded to their classes. Pairs of a list
   pass a filter by sizes and by places in their prefixes, then one by all that their prefixes
   have in common, and are verified on the full sets.

A list with m members is not turned into m * m pairs. First every member is paired with one
leader of its list, which joins copies into components; this is repeated with other leaders. A
leader has met its whole list and leaves it, so a list of two is done after one round.
Then only pairs from different components that still share a list remain to be verified, so
all links between components are found and components are exact. In lists of up to ``LIGHT``
members such a pair is formed once, in the first list that both have, where the filter by places
is sharpest, if that is among the first ``FIRSTS`` lists of both; else in every list that they
share. Larger lists are cut into blocks of up to about ``BLOCK`` members, and a task counts what
the full sets of two blocks have in common. It returns no more links than join its components,
so no row is made per pair.

What is broadcast has fixed bounds: ``FREQUENT`` shingles and a bit map of ``MAP_BITS`` bits
that spares most sets that no pair needs from being shuffled. A list known to be very frequent is
dealt into parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, land, parallelism, small_batches
from .graph import merged
from .shingles import batch_sets, mixed

PERCENT = 75
FREQUENT = 1 << 20
MAP_BITS = 1 << 26
#: Shingles that a task gathers before it counts them, and before it deals them out.
COUNTED = 1 << 22
DEALT = 1 << 20
#: Members of a list in one part, if the list is known to be frequent.
PART = 100_000
LEADER_ROUNDS = 3
#: Lists of a class that tell whether another list is the first that a pair shares.
FIRSTS = 8
#: Members of a list whose pairs become rows in the last step.
LIGHT = 32
#: Members of a block of a larger list, its shingles, and the shingles that a task compares at once.
BLOCK = 512
BLOCK_SHINGLES = 1 << 18
COLUMNS = 1 << 11

SURVEYED = "kind int, doc_id long, k long, k2 long, n long, bucket int, data binary"


def blob(*arrays: np.ndarray) -> bytes:
    return b"".join(a.tobytes() for a in arrays)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def rows_of(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], list(columns))


def set_keys(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set, as two longs."""
    both = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), dtype=np.int64)
    return int(both[0]), int(both[1])


def survey(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of kind 0: a document with its class ``k``, ``k2`` and size; of kind 1: shingles that
    several classes of a task share, with their counts, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        waiting: list[np.ndarray] = []
        held = 0

        def shared() -> Iterator[pa.RecordBatch]:
            if waiting:
                x = np.sort(np.concatenate(waiting))
                at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
                counts = np.diff(np.append(at, len(x)))
                x, counts = x[at][counts > 1], counts[counts > 1].astype(np.uint32)
                of = (x >> np.uint64(40)) % np.uint64(buckets)
                for b in np.unique(of).tolist():
                    own = of == b
                    yield rows_of({
                        "kind": ([1], pa.int32()), "doc_id": ([None], pa.int64()), "k": ([None], pa.int64()),
                        "k2": ([None], pa.int64()), "n": ([int(own.sum())], pa.int64()),
                        "bucket": ([b], pa.int32()), "data": ([blob(x[own], counts[own])], pa.binary()),
                    })

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            found: list[tuple] = []
            for row, hashes in batch_sets(batch.column("text")):
                k, k2 = set_keys(hashes) if len(hashes) else (None, None)
                found.append((0, ids[row], k, k2, len(hashes)))
                if k is not None and k not in met:
                    met.add(k)
                    waiting.append(hashes)
                    held += len(hashes)
                if held >= COUNTED:
                    yield from shared()
                    waiting, held = [], 0
            names = ("kind", "doc_id", "k", "k2", "n")
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            columns = {n: (list(c), k) for n, c, k in zip(names, zip(*found), kinds)} if found else {
                n: ([], k) for n, k in zip(names, kinds)
            }
            nothing = [None] * len(found)
            yield rows_of(columns | {"bucket": (nothing, pa.int32()), "data": (nothing, pa.binary())})
        yield from shared()

    return docs.mapInArrow(frugal(run), SURVEYED)


def frequent(surveyed: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The up to ``FREQUENT`` shingles with the highest counts, sorted, and their counts."""
    limit = FREQUENT // buckets

    def top(table: pa.Table) -> pa.Table:
        hashes, counts = [], []
        for n, data in zip(table.column("n").to_pylist(), table.column("data").to_pylist()):
            hashes.append(np.frombuffer(data, np.uint64, n))
            counts.append(np.frombuffer(data, np.uint32, n, 8 * n))
        x, at = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), len(x)).astype(np.uint64)
        first = np.argsort(-total.astype(np.int64), kind="stable")[:limit]
        return pa.table({"n": [len(first)], "data": pa.array([blob(x[first], total[first])], pa.binary())})

    tops = surveyed.where("kind = 1").select("bucket", "n", "data").groupBy("bucket").applyInArrow(
        top, "n long, data binary"
    )
    x, total = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for row in tops.collect():  # FREQUENT * 16 bytes at most
        x.append(np.frombuffer(row["data"], np.uint64, row["n"]))
        total.append(np.frombuffer(row["data"], np.uint64, row["n"], 8 * row["n"]))
    x, total = np.concatenate(x), np.concatenate(total)
    order = np.argsort(x)
    return x[order], total[order]


def prefix_of(hashes: np.ndarray, known: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The prefix of a sorted set in the common order, and the counts of its shingles."""
    n = len(hashes)
    size = n - -(-PERCENT * n // 100) + 1
    often = np.zeros(n, dtype=np.uint64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        often = np.where(known[at] == hashes, counts[at], np.uint64(0))
    first = np.lexsort((hashes, often))[:size]
    return hashes[first], often[first]


def postings(docs: DataFrame, known, buckets: int) -> DataFrame:
    """Prefix shingles of all classes, by bucket: ``n`` postings (shingle, group, size, place) and
    ``members`` rows (group, class, size), the latter in the bucket of the class's first shingle.

    The place of a shingle in its prefix is doubled; it is odd if the list is dealt into parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = known.value
        met: set[int] = set()
        rows: list[tuple] = []
        home: dict[int, list[tuple[int, int, int]]] = {}
        held = 0

        def dealt() -> Iterator[pa.RecordBatch]:
            if not rows:
                return
            prefix, of, tag = (np.concatenate([r[k] for r in rows]) for k in (0, 1, 2))
            sizes = [len(r[0]) for r in rows]
            group = np.repeat(np.array([r[3] for r in rows], dtype=np.int64), sizes)
            n = np.repeat(np.array([r[4] for r in rows], dtype=np.uint32), sizes)
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(buckets + 1, dtype=np.uint64))
            for b in range(buckets):
                at, own = order[cuts[b] : cuts[b + 1]], np.array(home.get(b, []), dtype=np.int64).reshape(-1, 3)
                if len(at):
                    data = blob(prefix[at], group[at], n[at], tag[at], own)
                    yield rows_of({
                        "bucket": ([b], pa.int32()), "n": ([len(at)], pa.int64()),
                        "members": ([len(own)], pa.int64()), "data": ([data], pa.binary()),
                    })

        for batch in batches:
            for _, hashes in batch_sets(batch.column("text")):
                if not len(hashes):
                    continue
                k, _ = set_keys(hashes)
                if k in met:
                    continue
                met.add(k)
                prefix, often = prefix_of(hashes, shingles, counts)
                group = int(np.int64(xxhash.xxh3_64_intdigest(prefix.tobytes(), len(hashes)) - (1 << 63)))
                parts = often // np.uint64(PART) + np.uint64(1)
                spread = np.uint64(k & (2**64 - 1)) % parts
                of = ((prefix >> np.uint64(40)) + spread * np.uint64(7919)) % np.uint64(buckets)
                tag = np.arange(len(prefix), dtype=np.uint32) * np.uint32(2) + (parts > 1).astype(np.uint32)
                rows.append((prefix, of, tag, group, len(hashes)))
                home.setdefault(int(of[0]), []).append((group, k, len(hashes)))
                held += len(prefix)
                if held >= DEALT:
                    yield from dealt()
                    rows, home, held = [], {}, 0
        yield from dealt()

    return docs.mapInArrow(frugal(run), "bucket int, n long, members long, data binary")


def live_lists(table: pa.Table) -> pa.Table:
    """Rows (0, shingle, group, size, place) of lists with several groups, (1, group, class, size, 0).

    Places are doubled as in ``postings``; rows with an odd one can occur in several buckets.
    """
    parts: list[list[np.ndarray]] = [[], [], [], [], []]
    for n, m, data in zip(*(table.column(x).to_pylist() for x in ("n", "members", "data"))):
        at = 0
        for part, (kind, size) in zip(
            parts, ((np.uint64, n), (np.int64, n), (np.uint32, n), (np.uint32, n), (np.int64, 3 * m))
        ):
            part.append(np.frombuffer(data, kind, size, at))
            at += part[-1].nbytes
    x, group, n, tag, homes = map(np.concatenate, parts)
    homes = np.unique(homes.reshape(-1, 3), axis=0)
    order = np.lexsort((group, x))
    x, group, n, tag = x[order], group[order], n[order], tag[order]
    new_list = np.concatenate([[True], x[1:] != x[:-1]])
    fresh = new_list | np.concatenate([[True], group[1:] != group[:-1]])
    x, group, n, tag, new_list = x[fresh], group[fresh], n[fresh], tag[fresh], new_list[fresh]
    sizes = np.diff(np.append(np.flatnonzero(new_list), len(x)))
    live = (np.repeat(sizes, sizes) > 1) | (tag % 2 == 1)
    nothing = np.zeros(len(homes), np.int64)
    return pa.table({
        "kind": pa.array(np.concatenate([np.zeros(int(live.sum()), np.int32), np.ones(len(homes), np.int32)])),
        "a": pa.array(np.concatenate([as_long(x[live]), homes[:, 0]])),
        "b": pa.array(np.concatenate([group[live], homes[:, 1]])),
        "n": pa.array(np.concatenate([n[live].astype(np.int64), homes[:, 2]])),
        "place": pa.array(np.concatenate([tag[live].astype(np.int64), nothing])),
    })


def bit_of(k: Column) -> Column:
    return F.pmod(F.xxhash64(k), F.lit(MAP_BITS))


def needed_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``k`` and the set of every class in ``classes(k)``. Landed."""
    words = (
        classes.select(bit_of(F.col("k")).alias("bit"))
        .groupBy((F.col("bit") / 64).cast("long").alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))).alias("bits"))
        .toArrow()
    )  # MAP_BITS / 64 rows at most
    bits = np.zeros(MAP_BITS // 64, dtype=np.uint64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            found: dict[str, list] = {"k": [], "data": []}
            for _, hashes in batch_sets(batch.column("text")):
                if len(hashes) and (k := set_keys(hashes)[0]) not in met:
                    met.add(k)
                    found["k"].append(k)
                    found["data"].append(hashes.tobytes())
            yield rows_of({"k": (found["k"], pa.int64()), "data": (found["data"], pa.binary())})

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            k = batch.column("k").to_numpy()
            bit = np.array([xx64_long(x) for x in k.tolist()], dtype=np.int64) % MAP_BITS
            hit = (shared.value[bit // 64] >> (bit % 64).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(hit > 0))

    sets = docs.mapInArrow(frugal(sieve), "k long, data binary")
    found = sets.join(classes.select("k").distinct(), "k", "left_semi").groupBy("k").agg(F.first("data").alias("data"))
    found = land(found, "sets")
    shared.unpersist()
    return found


def xx64_long(x: int) -> int:
    """Spark's xxhash64 of a long."""
    h = xxhash.xxh64_intdigest(x.to_bytes(8, "little", signed=True), 42)
    return h - (1 << 64) if h >= 1 << 63 else h


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with ``links``: whether the full sets reach the threshold. Landed."""
    classes = pairs.select(F.col("a").alias("k")).union(pairs.select("b")).distinct()
    sets = needed_sets(docs, classes)
    left = sets.select(F.col("k").alias("a"), F.col("data").alias("x"))
    right = sets.select(F.col("k").alias("b"), F.col("data").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                p = np.frombuffer(x.as_buffer(), np.uint64)
                q = np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([p, q]))
                common = int((both[1:] == both[:-1]).sum())
                links.append(100 * common >= PERCENT * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(links, pa.bool_())], ["a", "b", "links"]
            )

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return land(joined.mapInArrow(frugal(run), "a long, b long, links boolean"), "verified")


def needed(n: Column, m: Column) -> Column:
    """The smallest intersection with which sets of these sizes link."""
    return F.ceil(PERCENT * (n + m) / (100 + PERCENT))


def may_link(n: str, rest: str, m: str, other_rest: str) -> Column:
    """Whether sets of sizes n and m can link if none of their shingles before this one is common;
    ``rest`` counts a set's shingles from this one on."""
    least = needed(F.col(n), F.col(m))
    return (F.col(rest) >= least) & (F.col(other_rest) >= least)


def enough_in_common(pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """The ``pairs(a, b)`` that can still link, given all shingles that their prefixes share.

    All common shingles up to the end of one of the prefixes are in both, so the intersection is
    at most their number plus what follows that prefix. ``shared(k, n, g, hs)`` holds per class
    its group and the shingles of its prefix that other groups have in theirs.
    """
    left, right = (shared.select(*[F.col(c).alias(c + side) for c in ("k", "n", "g", "hs")]) for side in "ab")
    after = F.ceil(PERCENT * F.greatest("na", "nb") / 100) - 1
    common = F.size(F.array_intersect("hsa", "hsb"))
    passes = (F.col("ga") == F.col("gb")) | (common + after >= needed(F.col("na"), F.col("nb")))
    joined = pairs.join(left, pairs["a"] == left["ka"]).join(right, pairs["b"] == right["kb"])
    return joined.where(passes).select("a", "b")


def first_lists(lists: DataFrame, members: DataFrame, shared: DataFrame) -> DataFrame:
    """``k``, its group ``g`` and ``firsts``, the first lists in the common order, of all classes of
    ``members``. The more of a set is left from a shingle on, the earlier it is."""
    asked = land(members.select("k").distinct(), "asked")
    groups = shared.join(asked, "k", "left_semi").select("k", "g")
    own = lists.join(land(groups, "groups"), "k")
    in_order = F.sort_array(F.collect_list(F.when(F.col("h") != F.col("g"), F.struct(-F.col("rest"), "h"))))
    return own.groupBy("k").agg(F.first("g").alias("g"), F.slice(in_order["h"], 1, FIRSTS).alias("firsts"))


def meets_here() -> Column:
    """Whether list h is the one in which the pair of k and other is formed.

    Classes of one group meet in the group's own list. Others meet in the first list they share: if
    the first lists of both have any in common, the first of these is it, as they are in order.
    """
    common = F.array_intersect("firsts", "other_firsts")
    return F.when(F.col("g") == F.col("other_g"), F.col("h") == F.col("g")).otherwise(
        F.coalesce(F.try_element_at(common, F.lit(1)) == F.col("h"), F.lit(True))
    )


def paired(df: DataFrame) -> DataFrame:
    """Distinct pairs of the columns k and other, the smaller first."""
    return df.select(F.least("k", "other").alias("a"), F.greatest("k", "other").alias("b")).distinct()


def class_components(docs: DataFrame, lists: DataFrame, shared: DataFrame) -> DataFrame | None:
    """``node`` and ``label`` of the classes that link with others.

    ``lists(h, k, n, rest)`` holds the members of all lists, ``shared`` see ``enough_in_common``;
    both are landed.
    """
    tested: DataFrame | None = None
    labels: DataFrame | None = None

    def labelled(rows: DataFrame) -> DataFrame:
        """Members of lists with the label ``c`` of their component."""
        if labels is None:
            return rows.withColumn("c", F.col("k"))
        marked = rows.join(labels, rows["k"] == labels["node"], "left")
        return land(marked.select("h", "k", "n", "rest", F.coalesce("label", "k").alias("c")), "marked")

    def test(pairs: DataFrame) -> None:
        nonlocal tested, labels
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = land(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        likely = land(enough_in_common(pairs, shared), "likely")
        if not likely.limit(1).count():
            return
        links = verified(docs, likely).where("links").select("a", "b")
        if links.limit(1).count():
            labels = merged(labels, links)

    rows = lists
    for round_no in range(LEADER_ROUNDS + 1):
        marked = labelled(rows)
        open_lists = marked.groupBy("h").agg(
            F.min("c").alias("low"),
            F.max("c").alias("high"),
            F.count("*").alias("members"),
            F.min_by(F.struct("k", "n", "rest", "c"), F.xxhash64(F.lit(round_no), "c", "k")).alias("leader"),
        )
        open_lists = land(open_lists.where("low < high").select("h", "members", "leader"), "open")
        if not open_lists.limit(1).count():
            break
        if round_no == LEADER_ROUNDS:
            still = land(marked.join(open_lists.select("h", "members"), "h"), "still")
            links = links_by_blocks(docs, still.where(F.col("members") > LIGHT).drop("members"))
            if links is not None:
                labels = merged(labels, links)
            test(pairs_of_lists(still.where(F.col("members") <= LIGHT).drop("members"), lists, shared))
            break
        asks = (F.col("c") != F.col("leader.c")) & may_link("n", "rest", "leader.n", "leader.rest")
        stays = (F.col("members") > 2) & (F.col("k") != F.col("leader.k"))
        led = marked.join(open_lists, "h").where(asks | stays)
        led = led.select("h", "k", "n", "rest", F.when(asks, F.col("leader.k")).alias("other"), stays.alias("stays"))
        led = land(led, "led")
        test(paired(led.where("other is not null")))
        rows = led.where("stays").select("h", "k", "n", "rest")
    return labels


def pairs_of_lists(still: DataFrame, lists: DataFrame, shared: DataFrame) -> DataFrame:
    """``a`` and ``b`` of all pairs between components ``c`` of a list of ``still(h, k, n, rest, c)`` that can link."""
    still = land(still.join(first_lists(lists, still, shared), "k"), "still")
    by_component = still.groupBy("h", "c").agg(
        F.min("n").alias("n"), F.max("rest").alias("rest"), F.count("*").alias("members")
    )
    by_component = land(by_component, "by-component")
    other = by_component.select(
        "h", F.col("c").alias("d"), F.col("n").alias("m"), F.col("rest").alias("other_rest"), F.col("members").alias("others")
    )
    # The component with fewer members in the list, c, is expanded first.
    fewer = F.struct("members", "c") < F.struct(F.col("others").alias("members"), F.col("d").alias("c"))
    meeting = by_component.join(other, "h").where(fewer & may_link("n", "rest", "m", "other_rest"))
    meeting = meeting.select("h", "c", "d", "m", "other_rest")
    first = still.select("h", "c", "k", "n", "rest", "g", "firsts")
    second = still.select(
        "h", F.col("c").alias("d"), F.col("k").alias("other"), F.col("n").alias("m"), F.col("rest").alias("other_rest"),
        F.col("g").alias("other_g"), F.col("firsts").alias("other_firsts"),
    )
    expanded = meeting.join(first, ["h", "c"]).where(may_link("n", "rest", "m", "other_rest")).drop("m", "other_rest")
    expanded = expanded.join(second, ["h", "d"])
    return paired(expanded.where(may_link("n", "rest", "m", "other_rest") & meets_here()))


def in_blocks(heavy: DataFrame) -> DataFrame:
    """``heavy(h, k, n, rest, c)`` once per pair of blocks (``low``, ``high``) that its own, ``part``, is in.

    The largest component of a list has blocks of its own, which don't meet each other. Members
    that can't link with the smallest set of their list are left out.
    """
    by_component = heavy.groupBy("h", "c").agg(
        F.count("*").alias("members"), F.sum("n").alias("shingles"), F.min("n").alias("least"), F.max("rest").alias("most")
    )
    parts = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    by_list = by_component.groupBy("h").agg(
        F.max_by("c", F.struct("members", "c")).alias("main"),
        F.max(F.struct("members", "c", "shingles")).alias("own"),
        (F.sum("members") - F.max("members")).alias("members"),
        F.sum("shingles").alias("all"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )
    by_list = by_list.withColumn("shingles", F.col("all") - F.col("own.shingles")).withColumn("others", parts)
    by_list = by_list.select(
        "h", "main", "least", "most", "others",
        F.greatest(F.ceil(F.col("own.members") / BLOCK), F.ceil(F.col("own.shingles") / BLOCK_SHINGLES)).alias("mains"),
    )
    least = needed(F.col("n"), F.col("least"))
    rows = heavy.join(by_list, "h").where((F.col("rest") >= least) & (F.col("most") >= least))
    spread = F.xxhash64("k")
    part = F.when(F.col("c") == F.col("main"), F.col("others") + F.pmod(spread, F.col("mains"))).otherwise(
        F.pmod(spread, F.col("others"))
    )
    rows = rows.withColumn("part", part)
    last = F.when(F.col("part") < F.col("others"), F.col("others") + F.col("mains")).otherwise(F.col("others"))
    rows = rows.withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), last - 1)))
    low, high = F.least("part", "met").alias("low"), F.greatest("part", "met").alias("high")
    return rows.select("h", low, high, "part", "k", "n", "rest", "c")


def in_common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``."""
    x, y = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(x, y)
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    sides = []
    for values, sets in ((x, left), (y, right)):
        at = np.minimum(np.searchsorted(both, values), max(len(both) - 1, 0))
        hit = np.flatnonzero(both[at] == values) if len(both) else np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = hit[np.argsort(at[hit], kind="stable")]
        sides.append((at[order], of[order], len(sets)))
    for begin in range(0, len(both), COLUMNS):
        dense = []
        for at, of, n in sides:
            a, b = np.searchsorted(at, [begin, begin + COLUMNS])
            dense.append(np.zeros((n, COLUMNS), dtype=np.float32))
            dense[-1][of[a:b], at[a:b] - begin] = 1
        total += (dense[0] @ dense[1].T).astype(np.int64)
    return total


def joining(table: pa.Table) -> pa.Table:
    """Links ``a`` and ``b`` between two blocks, as many as join the components that have any."""
    part, k, n, rest, c = (table.column(x).to_numpy() for x in ("part", "k", "n", "rest", "c"))
    data = table.column("data").combine_chunks()
    left = np.flatnonzero(part == table.column("low")[0].as_py())
    right = np.flatnonzero(part == table.column("high")[0].as_py())

    def open_pairs() -> np.ndarray:
        least = -(-PERCENT * (n[left][:, None] + n[right][None]) // (100 + PERCENT))
        fits = (rest[left][:, None] >= least) & (rest[right][None] >= least)
        return fits & (c[left][:, None] != c[right][None])

    found: list[tuple[int, int]] = []
    may = open_pairs()
    left, right = left[may.any(axis=1)], right[may.any(axis=0)]
    if len(left):
        left_sets, right_sets = ([np.frombuffer(data[int(i)].as_buffer(), np.uint64) for i in side] for side in (left, right))
        common = in_common(left_sets, right_sets)
        links = open_pairs() & (100 * common >= PERCENT * (n[left][:, None] + n[right][None] - common))
        above: dict[int, int] = {}

        def top(x: int) -> int:
            while x in above:
                above[x] = x = above.get(above[x], above[x])
            return x

        for i, j in zip(*(side[at].tolist() for side, at in zip((left, right), np.nonzero(links)))):
            one, two = top(int(c[i])), top(int(c[j]))
            if one != two:
                above[one] = two
                found.append((min(int(k[i]), int(k[j])), max(int(k[i]), int(k[j]))))
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def links_by_blocks(docs: DataFrame, heavy: DataFrame) -> DataFrame | None:
    """``a`` and ``b`` of links that join all components of a list of ``heavy(h, k, n, rest, c)`` that link."""
    blocks = land(in_blocks(heavy), "blocks")
    if not blocks.limit(1).count():
        return None
    sets = needed_sets(docs, blocks.select("k").distinct())
    links = blocks.join(sets, "k").groupBy("h", "low", "high").applyInArrow(joining, "a long, b long")
    return land(links.distinct(), "block-links")


def near_copies(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, n_shingles, component_id.

    A-Z are lower-cased; words are runs of other characters than the six ASCII white spaces; a
    text of fewer than five words has its whole word sequence as one shingle. Null texts and
    texts without words have no shingles, link with nothing and keep their own id. A component's
    id is the smallest doc_id in it; null ids count only if there is no other. Repeated rows are
    copies of each other. Other columns are ignored; an empty table gives no row.

    Sets are compared by 64-bit hashes of shingles; two unequal sets with one class key would
    raise an error.
    """
    # Sets of long texts are large; everything that runs in Python runs before this returns.
    with small_batches(docs.sparkSession):
        return joined_copies(docs)


def joined_copies(docs: DataFrame) -> DataFrame:
    """``near_copies`` with the session's batch size."""
    buckets = parallelism(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    surveyed = land(survey(texts, buckets), "surveyed")
    known = docs.sparkSession.sparkContext.broadcast(frequent(surveyed, buckets))
    only_text = texts.select("text")
    lists = land(
        postings(only_text, known, buckets).groupBy("bucket").applyInArrow(live_lists, "kind int, a long, b long, n long, place long"),
        "lists",
    )
    known.unpersist()
    members = lists.where("kind = 1").select(F.col("a").alias("g"), F.col("b").alias("k"), "n")
    members = land(members, "members")
    several = members.groupBy("g").agg(F.count("*").alias("size")).where("size > 1").select("g")
    of_groups = lists.where("kind = 0").select(F.col("a").alias("h"), F.col("b").alias("g"), "place")
    dealt = F.col("place") % 2 == 1
    of_groups = of_groups.where(~dealt).unionByName(of_groups.where(dealt).distinct())
    place = F.shiftright("place", 1)
    expanded = of_groups.join(members, "g").select("h", "k", "n", (F.col("n") - place).alias("rest"), "g")
    # A group's members have their whole prefix in common.
    alike = members.join(land(several, "several"), "g", "left_semi")
    within = alike.select(F.col("g").alias("h"), "k", "n", F.col("n").alias("rest"), "g")
    in_lists = land(expanded.unionByName(within), "members-of-lists")
    shared = in_lists.groupBy("k").agg(
        F.first("n").alias("n"), F.first("g").alias("g"), F.collect_list(F.when(F.col("h") != F.col("g"), F.col("h"))).alias("hs")
    )
    labels = class_components(only_text, in_lists.drop("g"), land(shared, "shared"))

    rows = surveyed.where("kind = 0").select("doc_id", "k", "k2", "n")
    if labels is None:
        marked = rows.withColumn("c", F.col("k"))
    else:
        marked = rows.join(labels, rows["k"] == labels["node"], "left").withColumn("c", F.coalesce("label", "k"))
    marked = land(marked.select("doc_id", "k", "k2", "n", "c"), "documents")
    clash = marked.groupBy("k").agg(F.min("k2").alias("low"), F.max("k2").alias("high")).where("low <> high")
    if clash.limit(1).count():
        raise RuntimeError("two different shingle sets share a 64-bit key")
    smallest = land(marked.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("first_id")), "smallest")
    return marked.join(smallest, "c", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("first_id")).alias("component_id"),
    )
