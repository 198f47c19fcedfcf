"""The prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from reportlens.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, place int"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[conv].append(((turn is not None, turn or 0), role, key, text))
    for turns in own.values():
        turns.sort(key=lambda t: t[:3])
    members = defaultdict(set)
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (c % 5 if c >= 0 else -(-c % 5))
        whole = [(t[1], t[3]) for t in own.get(first, [])[:h] + own[c][h:]]
        paths[c] = tuple(whole)
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].add(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out, totals = [], {}
    for path in sorted(members, key=len, reverse=True):
        saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        leaves = 0 if children[path] else 1
        totals[path] = (
            saved + sum(totals[c][0] for c in children[path]),
            leaves + sum(totals[c][1] for c in children[path]),
        )
        ends = ",".join(map(str, sorted(c for c in members[path] if paths[c] == path)))
        parent = min(members[path[:-1]]) if path else None
        out.append(
            (min(members[path]), len(path), parent, len(members[path]), len(children[path]), totals[path][1],
             totals[path][0], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(map(str, out))


def conversations(seed, n, longest=9):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-10, 3 * n), n):
        if draw.random() < 0.3:
            turns = [("user", "same"), ("assistant", "réponse"), (None, None), ("user", "")]
        else:
            turns = [(draw.choice(["user", "assistant", None]), draw.choice(["a", "bb", "é😀", None])) for _ in range(draw.randint(1, longest))]
        numbers = list(range(len(turns)))
        if draw.random() < 0.2:
            numbers[0] = None
        if draw.random() < 0.2:
            numbers[-1] = numbers[0]
        rows += [(c, t, *x, "k", 1) for t, x in zip(numbers, turns)]
    rows += [(None, 0, "user", "lost", "k", 1), *rows[:3]]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, kept", [(1, 200_000), (2, 30)])
def test_trie_matches_brute_force(spark, monkeypatch, seed, kept):
    monkeypatch.setattr(prefix_trie, "TURNS", kept)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rows = conversations(seed, 150)
    rows += [(3000, t, "user", f"long {t}" if t != 40 else "x" * 50_000, "", 0) for t in range(120)]
    rows += [(3001, t, "user", f"long {t}", "", 0) for t in range(90)]
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got.columns == list(NAMES) and {kind for n, kind in got.dtypes if n != "ends_sha256"} == {"bigint"}
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_fat_search_finds_the_deepest_prefix():
    """The trie alone, with random paths, against a walk from the root."""
    draw = random.Random(3)
    trie, paths = prefix_trie.ZFastTrie(1), []
    for c in range(600):
        turns = [bytes([draw.randint(0, 1)]) for _ in range(draw.randint(0, 40))]
        if paths and draw.random() < 0.7:
            turns = draw.choice(paths)[: draw.randint(0, 40)] + turns
        paths.append(turns)
        trie.insert(prefix_trie.path_keys(turns), list(range(len(turns) + 1)), len(turns), [1], c)
        keys = prefix_trie.path_keys(draw.choice(paths)[: draw.randint(0, 60)] + [b"z"])
        node = trie.root
        while True:
            below = node.children.get(keys[node.high + 1]) if node.high + 1 < len(keys) else None
            if below is None or below.high >= len(keys) or below.keys[below.high] != keys[below.high]:
                break
            node = below
        assert trie.lowest(keys, len(keys) - 1) is node
    assert all(n.handle == k for k, n in trie.table.items() if n is not trie.root)
    sums = {n.keys[d]: v[0] for n, d, v, _ in trie.expanded()}
    for turns in paths:
        for d, key in enumerate(prefix_trie.path_keys(turns)):
            assert sums[key] == sum(p[:d] == turns[:d] for p in paths)


def test_two_fattest():
    assert prefix_trie.two_fattest(-1, 0) == 0
    for low in range(40):
        for high in range(low + 1, 70):
            best = max(range(low + 1, high + 1), key=lambda x: x & -x)
            assert prefix_trie.two_fattest(low, high) == best
