"""The two vector searches against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from reportlens.llm import postings, threshold

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("v", T.StringType()),
        T.StructField("id", T.StringType()),
    ]
)


def rows(n=700, dim=8, seed=0):
    draw = np.random.default_rng(seed)
    x = draw.normal(0, 1, (n, dim)).astype(np.float32)
    x[::3] = x[0]  # a third are one vector
    out = [(k, x[k].tolist(), 1, "a", "b") for k in range(n)]
    out += [(n, None, 1, "", ""), (n + 50, [], 1, "", ""), (n + 100, [float("nan")] * dim, 1, "", "")]
    out += [(1000, [0.0] * dim, None, None, None), (1001, [math.inf] * dim, 1, "", ""), (None, [1.0] * dim, 1, "", "")]
    out += [(1050, [1.0] * 3, 1, "", ""), (1100, [None] * dim, 1, "", ""), out[5], (150, x[150].tolist(), 0, "", "")]
    return out


def taking_part(data, dim, zero_ok):
    best = {}
    for k, v, *_ in data:
        if k is None or not v or len(v) != dim or any(x is None or not math.isfinite(x) for x in v):
            continue
        if zero_ok or any(v):
            best[k] = min(best.get(k, v), v)
    ids = np.array(sorted(best))
    return ids, np.array([best[k] for k in ids], dtype=np.float64)


def test_threshold_matches_brute_force(spark):
    data = rows()
    ids, x = taking_part(data, 8, True)
    x = np.floor(256 * x)
    want = []
    for k, q in zip(ids, x):
        if k % 50 == 0:
            s = x @ q
            best = [j for j in np.lexsort((ids, -s)) if ids[j] != k][:5]
            want += [(k, r + 1, ids[j], int(s[j])) for r, j in enumerate(best)]
    for block in (8192, 97):
        got = threshold.top_k(spark.createDataFrame(data, SCHEMA).repartition(3), block=block).collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert threshold.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    few = spark.createDataFrame([(0, [1e30, 1.0], 0, "", ""), (1, [-1e30, 2.0], 0, "", "")], SCHEMA)
    assert [tuple(r) for r in threshold.top_k(few).collect()] == [(0, 1, 1, -(2**63))]


def test_threshold_takes_every_row(spark):
    """Rows that share an id are candidates of each other and ask each for itself; a null id is a candidate."""
    draw = np.random.default_rng(2)
    x = draw.normal(0, 1, (300, 4)).astype(np.float32)
    x[100:140] = x[0]
    data = [(k % 260 if k != 33 else None, v.tolist()) for k, v in enumerate(x)]
    data += [(50, x[50].tolist())] * 7 + [(150, [-0.0] * 4), (150, [0.0] * 4), (100, [1e30] * 4), (7, [3e30] * 4)]
    want = []
    for own, (k, q) in enumerate(data):
        if k is not None and k % 50 == 0:
            q = [math.floor(256 * c) for c in q]
            s = [
                (-sum(a * math.floor(256 * b) for a, b in zip(q, v)), j is None, j or 0)
                for row, (j, v) in enumerate(data)
                if row != own
            ]
            for r, (score, null, j) in enumerate(sorted(s)[:5]):
                want.append((k, r + 1, -1 if null else j, max(-(2**63), min(2**63 - 1, -score))))
    for block in (8192, 41):
        table = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(3)
        got = threshold.top_k(table, block=block, every_row=True).collect()
        assert sorted((a, b, -1 if c is None else c, d) for a, b, c, d in got) == sorted(want)


def test_threshold_stops_early():
    draw = np.random.default_rng(1)
    x = np.floor(256 * draw.normal(0, 1, (5000, 2)))
    lists = threshold.SortedLists(np.arange(5000), x)
    at, scores = lists.top(-1, np.array([3.0, -2.0]), 5)
    s = x @ np.array([3.0, -2.0])
    assert at.tolist() == np.lexsort((np.arange(5000), -s))[:5].tolist() and scores.tolist() == s[at].tolist()


def recall(data, got, dim, k=10):
    ids, x = taking_part(data, dim, False)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    for i, q in zip(ids, x):
        if i % 100 == 0:
            s = np.sqrt(((x - q) ** 2).sum(axis=1))
            best = [j for j in np.lexsort((ids, s)) if ids[j] != i][:k]
            mine = sorted(found[i])
            assert [r for r, _, _ in mine] == list(range(1, len(best) + 1))
            assert all(abs(d - s[list(ids).index(v)]) < 1e-9 for _, v, d in mine)
            assert mine == sorted(mine, key=lambda z: (z[2], z[1]))
            hit += len({ids[j] for j in best} & {v for _, v, _ in mine})
            total += len(best)
    assert set(found) == {i for i in ids if i % 100 == 0}
    return hit / total


def test_postings_find_neighbours(spark):
    data = rows(2500, 16)
    got = postings.nearest(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()
    assert recall(data, got, 16) >= 0.9
    assert postings.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_postings_with_long_lists(spark, monkeypatch):
    """Lists dealt into parts; fewer candidates than asked for."""
    monkeypatch.setattr(postings, "LIST_PART", 16)
    data = rows(700, 8, seed=4)
    got = postings.nearest(spark.createDataFrame(data, SCHEMA)).collect()
    assert recall(data, got, 8) >= 0.9
    few = [(100, [1.0, 0.0], 0, "", ""), (7, [1.0, 0.0], 0, "", ""), (3, [0.0, 1.0], 0, "", "")]
    got = postings.nearest(spark.createDataFrame(few, SCHEMA)).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(100, 1, 7), (100, 2, 3)]


@pytest.mark.parametrize("probes", [postings.PROBES, 1])
def test_postings_give_outliers_all_ranks(spark, monkeypatch, probes):
    """Queries far from all others have lists of their own; also where few lists may be read."""
    monkeypatch.setattr(postings, "PROBES", probes)
    monkeypatch.setattr(postings, "SCANNED", 8)
    monkeypatch.setattr(postings, "LIST_PART", 256)
    draw = np.random.default_rng(5)
    x = draw.normal(0, 1, (2000, 16)).astype(np.float32)
    x[::100] *= 50
    data = [(k, v.tolist(), 1, "a", "b") for k, v in enumerate(x)]
    got = postings.nearest(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()
    assert recall(data, got, 16) >= 0.5


def test_centroids_are_balanced():
    draw = np.random.default_rng(3)
    x = np.concatenate([draw.normal(0, 1, (4000, 8)), draw.normal(20, 0.1, (1000, 8))])
    centers = postings.balanced_centroids(x, 50)
    sizes = np.bincount(postings.squared(x, centers).argmin(axis=1), minlength=len(centers))
    assert 30 <= len(centers) <= 70 and sizes.max() <= 5 * len(x) / len(centers)
