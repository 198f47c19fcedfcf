"""Importance resampling, and its table of n-grams, against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from reportlens.llm import ngrams, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(rows, target):
    counts = [Counter(bucket(f) for t in texts for f in features(t)[1]) for texts in ([r[1] for r in rows], target)]
    s, t = (sum(c.values()) for c in counts)
    gain = [
        math.floor(1000 * math.log((counts[1][b] + 1) * (s + 10000) / ((counts[0][b] + 1) * (t + 10000)))) for b in range(10_000)
    ]
    out = []
    for doc_id, text in rows:
        words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: 25 * len(able) // 100]):
        row[4] = rank + 1
    return sorted(str(tuple(r[:5])) for r in out)


@pytest.mark.parametrize("piece", [ngrams.PIECE, 100])
def test_resampling_matches_brute_force(spark, edge_docs, edge_rows, no_docs, monkeypatch, piece):
    monkeypatch.setattr(ngrams, "PIECE", piece)
    rows = [(r[0], r[1]) for r in edge_rows]
    target = [edge_rows[7][1], "one two three one two", None, ""]
    items = spark.createDataFrame([(k, t, 1) for k, t in enumerate(target)], "item_id long, text string, score int")
    got = resampling.resample(edge_docs, items)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows, target)
    if piece == 100:
        assert resampling.resample(no_docs, items).count() == 0
        alone = resampling.resample(edge_docs, items.limit(0))
        assert sorted(str(tuple(r)) for r in alone.collect()) == brute(rows, [])


def test_keys_are_xxhash64():
    draw = np.random.default_rng(1)
    data = draw.integers(0, 256, 5000, dtype=np.uint8).tobytes() + ngrams.PAD
    at = draw.integers(0, 4800, 800)
    to = at + draw.integers(1, 80, 800)
    want = [xxhash.xxh64_intdigest(data[a:b]) for a, b in zip(at.tolist(), to.tolist())]
    assert ngrams.keys_of(data, at, to).tolist() == want


@pytest.mark.parametrize("bits", [64, 3, 0])
def test_equal_keys_of_unequal_ngrams(bits):
    """However bad the keys, the bytes decide."""
    draw = np.random.default_rng(2)
    words = [bytes(draw.integers(97, 100, draw.integers(1, 20), dtype=np.uint8)) for _ in range(700)]
    words += [w + b"x" for w in words[:50]] + words[:100]
    data = b" ".join(words) + ngrams.PAD
    size = np.array([len(w) for w in words])
    to = np.cumsum(size + 1) - 1
    at = to - size
    keys = ngrams.keys_of(data, at, to) & np.uint64(2**bits - 1)
    slot, owner = ngrams.interned(data, at, to, keys)
    assert [words[owner[s]] for s in slot] == words
    assert len(owner) == len(set(words)) and [words.index(words[k]) for k in owner] == owner.tolist()


def test_few_documents_are_drawn_in_order(spark):
    """Ties of score go to the smaller id; repeated rows are drawn one by one."""
    text = "word " * 25
    docs = spark.createDataFrame([(k % 40, text) for k in range(80)], "doc_id long, text string").repartition(4)
    got = resampling.resample(docs, docs.limit(0)).where("rank is not null").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 21))
    assert [(-r["score"], r["doc_id"]) for r in got] == sorted((-r["score"], r["doc_id"]) for r in got)
    assert all(got[k]["doc_id"] == got[k + 1]["doc_id"] for k in range(0, 20, 2))
