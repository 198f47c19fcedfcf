"""Operators on documents against brute force, on texts with every edge case."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reportlens.llm import common, graph, jaccard, likelihood, mixing, packing, quality, recurrent, suffixes, surrogates
from reportlens.llm import shingles as shingles_of
from reportlens.llm.common import held_out, parallelism
from reportlens.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def by_row(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=str)


# --- 1: quality -------------------------------------------------------------------------


def test_quality_separates_labels(spark, edge_docs, no_docs):
    good = [(k, f"Word after word makes sentence number {k}. It ends, and goes on.") for k in range(60)]
    bad = [(100 + k, f"WORD!!! $$$ AFTER### {k} %%% WORD!!! $$$ ###") for k in range(40)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(k, int(k < 100), 0) for k, _ in good + bad] + [(None, 1, 0), (5, None, 0), (6, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    model = quality.learn(docs, labels)
    rows = quality.rank(docs, model).collect()
    assert {r["doc_id"]: r["predicted"] for r in rows} == {k: int(k < 100) for k, _ in good + bad}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert {r["doc_id"] for r in quality.kept(docs, model).collect()} == {k for k, _ in good}
    edge = quality.rank(edge_docs, model).collect()
    assert len(edge) == edge_docs.count() and all(0 < r["score"] < 1 for r in edge)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in edge)
    assert quality.kept(edge_docs, model).columns == edge_docs.columns
    assert quality.rank(no_docs, model).count() == 0
    assert len(quality.rank(docs, quality.learn(docs, labels.limit(0))).collect()) == len(good + bad)
    one_class = quality.rank(docs, quality.learn(docs, labels.where("quality = 1"))).collect()
    assert all(r["predicted"] == 1 for r in one_class)


def test_threshold_is_a_quantile():
    draw = np.random.default_rng(0)
    y = (draw.random(2000) > 0.25).astype(int)
    x = np.stack([y + draw.normal(0, 0.6, 2000), draw.normal(0, 1, 2000)], axis=1).astype(np.float32)
    model = quality.fit_pairs(x, y, 1 - y.mean())
    assert abs((model.score(x) < quality.KEEP_FROM).mean() - (1 - y.mean())) < 0.01
    assert abs(model.weights[0]) > 5 * abs(model.weights[1])


def test_fit_takes_all_rows_and_pairs(spark):
    """Blocks of rows give the fit of all rows at once, at the minimum over all pairs."""
    draw = np.random.default_rng(3)
    y = (draw.random(9000) > 0.1).astype(np.int32)
    x = (draw.normal(0, 1, (9000, 3)) + y[:, None] * [0.8, -0.4, 0]).astype(np.float32)
    blocks = spark.createDataFrame([(int(k), r.tobytes()) for k, r in zip(y, x)], "label int, x binary").repartition(7)
    model, whole = quality.fit(quality.over_rows(blocks)), quality.fit_pairs(x, y, 1 - y.mean())
    assert np.allclose(model.weights, whole.weights, atol=1e-6) and abs(model.threshold - whole.threshold) < 1e-6
    raw = np.sort(((x - model.mean) / model.scale) @ model.weights)
    n0 = int((y == 0).sum())
    assert raw[n0 - 1] < model.threshold < raw[n0]
    z = (x - model.mean) / model.scale
    gaps = (z[y == 1] @ model.weights)[:, None] - (z[y == 0] @ model.weights)[None, :]
    miss = 1 / (1 + np.exp(gaps))
    slope = (miss.sum(1) @ z[y == 1] - miss.sum(0) @ z[y == 0]) / miss.size - 1e-3 * model.weights
    assert np.abs(slope).max() < 1e-3
    assert quality.fit(quality.over_rows(blocks.limit(0))) is None


def test_packed_numbers_come_back(spark, monkeypatch):
    """Every key gets its value, without a shuffle of the rows up to a number of words, else by any join."""
    values = {k: k % 4 for k in [*range(200), (5 << 33) + 7, (5 << 33) + 63, 2**62 + 31]}
    numbers = spark.createDataFrame(list(values.items()), "k long, v int")
    rows = spark.createDataFrame([(k, "text") for k in values] * 2 + [(999, "text"), (None, "text")], "k long, t string")
    for most in (common.PACKED, 0):
        monkeypatch.setattr(common, "PACKED", most)
        for bits in (1, 2):
            kept = numbers.where("v > 0")
            words = common.packed(kept, "k", F.col("v") if bits == 2 else F.lit(1), bits).cache()
            got = common.unpacked(rows, F.col("k"), words, "w", bits)
            want = [(k, "text", v if bits == 2 else 1) for k, v in values.items() if v] * 2
            assert sorted(map(tuple, got.collect())) == sorted(want)
            if most:
                assert "SortMergeJoin" not in got._jdf.queryExecution().toString()


def test_every_label_counts(spark, monkeypatch):
    """The fit reads each labelled document outside the fold, however many there are."""
    texts = [(k, "Plain words here." if k % 2 else "X!X #") for k in range(10_500)]
    seen = []
    over = quality.over_rows
    monkeypatch.setattr(quality, "over_rows", lambda rows: seen.append(rows.count()) or over(rows))
    monkeypatch.setattr(quality, "ROUNDS", 2)
    quality.learn(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(k, k % 2) for k, _ in texts], "doc_id long, quality int"))
    assert seen == [sum(zlib.crc32(str(k).encode()) % 5 != 0 for k, _ in texts)]


# --- 2: suffix arrays -------------------------------------------------------------------


def brute_repeats(texts, earlier_only=False):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + 200] for d in data for k in range(len(d) - 199))
    met, out = set(), []
    for d in data:
        mask = np.zeros(len(d), dtype=bool)
        for k in range(len(d) - 199):
            window = d[k : k + 200]
            if window in met if earlier_only else seen[window] > 1:
                mask[k : k + 200] = True
            met.add(window)
        runs = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~mask])
        out.append((len(d), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("long_list", [suffixes.LONG_LIST, 1])
def test_suffixes_match_brute_force(spark, edge_docs, edge_rows, long_list):
    want = [(r[0], *x) for r, x in zip(edge_rows, brute_repeats([r[1] for r in edge_rows]))]
    got = suffixes.without_repeats(edge_docs, long_list=long_list).collect()
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=str)


@pytest.mark.parametrize("letters", [2, 4, 26])
def test_longest_factors_have_the_right_length(monkeypatch, letters):
    monkeypatch.setattr(suffixes, "LENGTH", 40)
    draw = np.random.default_rng(letters)
    data = draw.integers(97, 97 + letters, 700).astype(np.uint8)
    data[300:390] = data[100:190]
    data[500:530] = data[20:50]
    at = np.unique(draw.integers(0, 700 - 40, 400))
    words = suffixes.words_at(data, 80)
    levels = suffixes.truncated_ranks(words, 40)
    text = data.tobytes()

    def alike(a, b):
        return next((k for k in range(40) if text[a + k] != text[b + k]), 40)

    for earlier in (True, False):
        got = suffixes.longest_factors(words, levels, at, levels[-1][1][at], earlier)
        want = [max((alike(a, b) for b in at if (b < a if earlier else b > a)), default=0) for a in at]
        assert got.tolist() == want


def test_previous_smaller():
    draw = np.random.default_rng(2)
    for x in (draw.permutation(200), np.arange(50), np.arange(50)[::-1], np.zeros(0, int)):
        want = [max((j for j in range(i) if x[j] < x[i]), default=-1) for i in range(len(x))]
        assert suffixes.previous_smaller(x).tolist() == want


def test_suffixes_keep_first(spark, edge_rows, no_docs):
    texts = sorted({r[1] or "" for r in edge_rows}, key=lambda t: hashlib.sha256(t.encode()).digest()[:16])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(k, *x) for k, x in enumerate(brute_repeats(texts, earlier_only=True))]
    got = suffixes.without_repeats(docs, keep_first=True, keep_text=True).collect()
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=str)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)
    assert suffixes.without_repeats(no_docs).count() == 0


def test_long_texts_in_segments(monkeypatch):
    import pyarrow as pa

    text = "".join(chr(97 + x) for x in np.random.default_rng(1).integers(0, 26, 5000))
    column = pa.array([text])
    monkeypatch.setattr(suffixes, "SEGMENT", 700)
    found = set()
    for _, offset, data, bounds in suffixes.segments(column):
        _, first, last, _, _ = suffixes.stretches(data, bounds)
        for a, b in zip(first.tolist(), last.tolist()):
            found |= {w + offset for w in range(a, b + 1)}
    assert found == set(range(len(text) - 199))


# --- 5: Jaccard join --------------------------------------------------------------------


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    ids = defaultdict(list)
    for (doc_id, _), c in zip(rows, label):
        ids[c].append(doc_id)
    first = {c: min((x for x in v if x is not None), default=None) for c, v in ids.items()}
    return [(d, len(s), first[c] if s else d) for (d, _), s, c in zip(rows, sets, label)]


def test_jaccard_matches_brute_force(edge_docs, edge_rows, no_docs):
    want = brute_components([(r[0], r[1]) for r in edge_rows])
    got = jaccard.near_copies(edge_docs).collect()
    assert by_row(got, "doc_id", "n_shingles", "component_id") == sorted(want, key=str)
    assert jaccard.near_copies(no_docs).count() == 0


@pytest.mark.parametrize("rounds, firsts", [(0, 8), (0, 1), (3, 8)])
def test_jaccard_chains_and_crowds(spark, monkeypatch, rounds, firsts):
    """Chains of near copies, and a passage in many texts that are no copies; also without leaders."""
    monkeypatch.setattr(jaccard, "LEADER_ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "FIRSTS", firsts)
    monkeypatch.setattr(jaccard, "PART", 3)
    base = [f"w{k}" for k in range(60)]
    passage = " ".join(f"p{k}" for k in range(30))
    texts = []
    for k in range(12):
        base[5 * k % 60] = f"new{k}"
        texts.append(" ".join(base))
    texts += [f"{passage} {' '.join(f'u{k}x{j}' for j in range(25))}" for k in range(15)]
    texts += [" ".join(f"w{k}" for k in range(60))] * 4
    rows = list(enumerate(texts))
    got = jaccard.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert by_row(got, "doc_id", "n_shingles", "component_id") == sorted(brute_components(rows), key=str)


@pytest.mark.parametrize("light, block, columns", [(32, 512, 2048), (3, 7, 5)])
def test_jaccard_crowd_of_near_misses(spark, monkeypatch, light, block, columns):
    """Many texts that share most words and don't link: no row per pair, and no link is lost among them."""
    for name, value in (("LIGHT", light), ("BLOCK", block), ("COLUMNS", columns)):
        monkeypatch.setattr(jaccard, name, value)
    formed = []

    def counted(df, label, land=jaccard.land):
        out = land(df, label)
        formed.append(out.count() if label in ("pairs", "blocks") else 0)
        return out

    monkeypatch.setattr(jaccard, "land", counted)
    base, draw, texts = [f"w{k}" for k in range(150)], random.Random(9), []
    for k in range(80):
        words = list(base)
        for place in draw.sample(range(5, 145), 3):
            words[place] = f"new{k}x{place}"
        texts.append(" ".join(words))
        if k % 8 == 0:
            words[2] = f"also{k}"
            texts.append(" ".join(words))
    rows = list(enumerate(texts))
    got = jaccard.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    want = brute_components(rows)
    assert 10 < len({c for _, _, c in want}) < 85
    assert by_row(got, "doc_id", "n_shingles", "component_id") == sorted(want, key=str)
    if block > len(rows):  # each member of a list in one block
        assert sum(formed) < len(rows) ** 2 / 3


@pytest.mark.parametrize("members", [(5, 4), (1, 9)])
def test_jaccard_blocks_join_all_components(spark, members):
    """Links of two blocks join the same components as all links; pairs that an earlier place rules out don't."""
    sets = [np.arange(k, k + 40, dtype=np.uint64) for k in range(sum(members))]
    common = jaccard.in_common(sets, sets[::-1])
    assert common.tolist() == [[40 - abs(i - j) for j in range(len(sets))[::-1]] for i in range(len(sets))]
    table = pa.table({
        "h": [1] * len(sets), "low": [0] * len(sets), "high": [1] * len(sets),
        "part": [0] * members[0] + [1] * members[1], "k": list(range(len(sets))), "n": [40] * len(sets),
        "rest": [40] * (len(sets) - 1) + [30], "c": list(range(len(sets))), "data": [s.tobytes() for s in sets],
    })
    links = jaccard.joining(table).to_pylist()
    reach = {members[0] - 1}
    for _ in sets:
        reach |= {x for r in links for x in r.values() if reach & set(r.values())}
    near = [(i, j) for i in range(members[0]) for j in range(members[0], len(sets) - 1) if j - i <= 5]
    want = {members[0] - 1}
    for _ in sets:
        want |= {x for pair in near for x in pair if want & set(pair)}
    assert reach == want and len(links) == len(want) - 1


def test_packing_in_small_batches(spark, monkeypatch):
    """Texts reach the tokenizer in batches of few rows, and the session's setting comes back."""
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []

    def watched(df, label, land=packing.land):
        seen.append(int(spark.conf.get(key)))
        return land(df, label)

    monkeypatch.setattr(packing, "land", watched)
    before = spark.conf.get(key)
    packing.pack(spark.createDataFrame([(1, "a text")], "doc_id long, text string"), vocabulary()).collect()
    assert 0 < max(seen) <= 1000 < int(before) == int(spark.conf.get(key))
    assert "exact" not in vars(packing.Tokens(vocabulary()))


def test_long_texts_in_word_segments(edge_rows, monkeypatch):
    """However short the segments of a long text, its set and its tokens stay the same."""
    column = pa.array([r[1] for r in edge_rows])
    sets = [(k, x.tolist()) for k, x in shingles_of.batch_sets(column)]

    def tokens():
        return [t[a:z].tolist() for _, t, b in likelihood.token_stream(column) for a, z in zip(b[:-1], b[1:])]

    whole = tokens()
    for limit in (1 << 16, 300):
        monkeypatch.setattr(shingles_of.text_chunks, "__defaults__", (limit,))
        monkeypatch.setattr(shingles_of.segments, "__defaults__", (limit,))
        assert [(k, x.tolist()) for k, x in shingles_of.batch_sets(column)] == sets
        assert tokens() == whole


@pytest.mark.parametrize("parts", [1, 3])
def test_components_of_chains_and_stars(spark, parts):
    """All at once, or in parts that are merged."""
    draw = np.random.default_rng(5)
    links = [(k, k + 1) for k in range(60)] + [(200, k) for k in range(100, 140)] + [(300, k) for k in range(301, 330)]
    links += [tuple(map(int, x)) for x in draw.integers(400, 480, (50, 2))]
    draw.shuffle(links)
    label = {n: n for link in links for n in link}
    for a, b in links:
        low, high = sorted((label[int(a)], label[int(b)]))
        label = {n: low if c == high else c for n, c in label.items()}
    want = {n: c for n, c in label.items() if any(int(a) != int(b) for a, b in links if n in (a, b))}
    df = [spark.createDataFrame([(int(a), int(b)) for a, b in links[k::parts]], "a long, b long").where("a <> b") for k in range(parts)]
    got = graph.components(df[0])
    for more in df[1:]:
        got = graph.merged(got, more)
    assert {r["node"]: r["label"] for r in got.collect()} == want
    assert graph.components(df[0].limit(0)).count() == 0


# --- 6: packing -------------------------------------------------------------------------


@pytest.mark.parametrize("capacity", [2048, 64])
def test_packing_places_every_piece(edge_docs, edge_rows, no_docs, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    got = packing.pack(edge_docs, vocabulary(), capacity).collect()
    want = Counter()
    for doc_id, text, *_ in edge_rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, (start, length) in enumerate(packing.cut(len(ids), capacity)):
            want[(doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert packing.pack(no_docs, vocabulary(), capacity).count() == 0


def test_special_tokens_are_those_of_tokenizers():
    tokens = packing.Tokens(vocabulary())
    for text in ("a <|endoftext|> b", "  x  \n y", "", "'s don't  \t", "\x1c x", "é" * 30_000, "١٢ ³ 　"):
        assert tokens.encode(text).tolist() == tokens.exact.encode(text, add_special_tokens=False).ids


def test_plan_uses_up_all_counts_and_is_tight():
    counts = np.zeros(101, dtype=np.int64)
    counts[np.random.default_rng(2).integers(1, 101, 3000)] += 1
    counts[[30, 33, 37]] += 50
    made = packing.plan(counts, 100)
    used = Counter()
    for lengths, times in made:
        assert sum(lengths) <= 100
        for x in lengths:
            used[x] += times
    assert all(used[x] == counts[x] for x in range(101))
    assert sum(t for _, t in made) <= math.ceil((counts * np.arange(101)).sum() / 100) * 1.02 + 1


# --- 7: mixing --------------------------------------------------------------------------


def targets(sizes, weights=(1, 2, 3)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


def test_mixing_reaches_its_targets(spark, edge_docs, edge_rows, no_docs):
    sources = ["a", "b", "c", "é", None]
    rows = [(k, "w " * (1 + k * 37 % 90), sources[min(k * k % 23 % 7, 4)]) for k in range(900)]
    rows += [(1000 + k, "only a few words", "tiny") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(docs).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    want = targets(sizes)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["taken"] <= 3 * r["size"]
        assert r["taken"] == r["copies"] * r["size"]
        assert r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(3, 0.01 * target)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(2)).collect()), key=str)
    edge = mixing.mix(edge_docs).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in edge) == sorted((str(r[0]), len(words(r[1]))) for r in edge_rows)
    assert mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "s"), (2, "", "s")], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mix(blank).collect()] == [0, 0]


def test_mixing_fills_the_gap_with_many_short_documents(spark):
    """One very long document among short ones, whatever its place in the order."""
    rows = [(k, "w " * 15, "s") for k in range(1500)] + [(2000, "w " * 10_000, "s")]
    rows += [(3000 + k, "w " * 50, "t") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    for k in range(4):
        got = mixing.mix(docs, (1, 1), seed=f"seed{k}").where("source = 's'").collect()
        assert abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 15


# --- 8: personal data -------------------------------------------------------------------


def test_surrogates_are_consistent_distinct_and_valid(spark):
    mails = [f"user{k}@mail{k % 10}.example.com" for k in range(300)]
    texts = [f"write to {m} or {m.upper()}, call +1 (0{k % 100:02}) 555-{k:04} now" for k, m in enumerate(mails)]
    texts += ["card 4845168114407329, 4845 1681 1440 7329; no card 9807915762804490", "10.1.2.3 192.168.7.9 8.8.8.8 300.1.1.1"]
    texts += ['token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "Mrs Mary Jones met Mr Jones and Mr John Jones."]
    texts += ["IBAN DE89 3704 0044 0532 0130 00 or 123-45-6789", None, "", "Nothing here: 1.5, 2024-01-02, a@b"]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, kind int")
    found = surrogates.all_entities(docs)
    assert surrogates.collisions(found).count() == 0
    assert found.where("kind = 'mail'").count() == 300 and found.where("kind = 'phone'").count() == 300
    out = {r["doc_id"]: r for r in surrogates.with_surrogates(docs, count_col="n_entities").collect()}
    for k, m in enumerate(mails):
        one, other = re.findall(r"[\w.]+@[\w.]+[a-zA-Z]", out[k]["text"])
        assert one == other.lower() and one != m and re.fullmatch(r"[a-z]{4}\d+@[a-z]{4}\d\.example\.com", one)
        assert re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4} now", out[k]["text"])
    cards = re.findall(r"\d{16}|\d{4} \d{4} \d{4} \d{4}", out[300]["text"])
    assert cards[0] == cards[1].replace(" ", "") != "4845168114407329" and surrogates.luhn(cards[0])
    assert cards[0][0] == "4" and cards[2] == "9807915762804490"
    private, network, public, wrong = out[301]["text"].split(" ")
    assert private.startswith("10.") and network.startswith("192.168.") and wrong == "300.1.1.1"
    assert not public.startswith(("10.", "192.168.")) and public != "8.8.8.8"
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', out[302]["text"])
    names = re.fullmatch(r"Mrs (\w+) (\w+) met Mr (\w+) and Mr (\w+) (\w+)\.", out[303]["text"])
    assert names[2] == names[3] == names[5] != "Jones"
    assert names[1] in surrogates.FIRST_NAMES["f"] and names[4] in surrogates.FIRST_NAMES["m"]
    assert out[304]["n_entities"] == 2 and out[305]["text"] is None and out[306]["text"] == ""
    assert out[307]["text"] == texts[307] and out[307]["n_entities"] == 0


def test_names_and_phones_stay_distinct_and_equal():
    names = [n for pool in surrogates.FIRST_NAMES.values() for n in pool] + ["Xavier", "Bo"]
    people = [f"{first} Smith" for first in names] + names
    found = {(title, n): surrogates.entities(f"{title} {n}")[0][3] for n in people for title in surrogates.TITLES}
    assert len({(n, x) for (_, n), x in found.items()}) == len(set(found.values())) == len(people)
    forms = ["+15551234567", "+1 555 123 4567", "+1 (555) 123-4567", "+1555 123 4567"]
    assert len({surrogates.plain("phone", surrogates.entities(f"call {x} now")[0][3]) for x in forms}) == 1
    assert all(surrogates.phone(x).startswith(x[:3]) for x in ("+493012345678", "+442012345678"))


def test_colliding_surrogates_are_drawn_again(spark):
    """Account numbers that differ only in equivalent check digits (01, 98) have one first surrogate."""
    import corpus_pipeline

    bodies = [f"37040044053201{k:04}" for k in range(400)]
    bodies = [b for b in bodies if int(f"{b}131400") % 97 == 0]
    ibans = [f"DE{check}{b}" for b in bodies for check in ("01", "98")]
    assert len(ibans) > 6 and surrogates.account(ibans[0]) == surrogates.account(ibans[1])
    rows = [(k, f"from {ibans[k % len(ibans)]} to {ibans[7 * k % len(ibans)]} now") for k in range(40)] + [(40, None), (41, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for out in (surrogates.distinct_surrogates(docs), corpus_pipeline.pii(spark, docs, "")):
        made = defaultdict(set)
        got = {r["doc_id"]: r["text"] for r in out.collect()}
        assert out.columns == docs.columns and len(got) == len(rows) and got[40] is None and got[41] == "a"
        for k, text in rows[:40]:
            for old, new in zip(text.split(" ")[1::2], got[k].split(" ")[1::2]):
                made[old].add(new)
        assert all(len(x) == 1 and a not in x for a, x in made.items())
        assert len(set.union(*made.values())) == len(made) == len(ibans)


def test_cycle_is_a_permutation_without_fixed_points():
    for size in (2, 3, 10, 97, 1000):
        image = [surrogates.cycle(x, size, b"t") for x in range(size)]
        assert sorted(image) == list(range(size)) and all(x != y for x, y in enumerate(image))
    odd = [surrogates.cycle(x, 50, b"t", lambda y: y % 2 == 1) for x in range(1, 50, 2)]
    assert sorted(odd) == list(range(1, 50, 2))


def test_surrogates_keep_rows_and_columns(edge_docs, no_docs):
    out = surrogates.with_surrogates(edge_docs)
    assert out.columns == edge_docs.columns
    assert by_row(out.collect(), "doc_id", "text") == by_row(edge_docs.collect(), "doc_id", "text")
    assert surrogates.with_surrogates(no_docs).count() == 0


# --- 9: language model ------------------------------------------------------------------


def brute_base(rows):
    tokens = [[*words(t), None] for _, t in rows]
    out = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    counts = Counter(w for x, o in zip(tokens, out) if not o for w in x)
    total = sum(counts.values())
    size = total + 0.1 * (len(counts) + 1)
    return [
        (d, o, len(x), sum(counts[w] > 0 for w in x), total, sum(math.log10((counts[w] + 0.1) / size) for w in x))
        for (d, _), o, x in zip(rows, out, tokens)
    ]


@pytest.mark.parametrize("known", [likelihood.KNOWN, 64])
def test_likelihood_base_is_exact(edge_docs, edge_rows, no_docs, monkeypatch, known):
    monkeypatch.setattr(likelihood, "KNOWN", known)
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    want = brute_base([(r[0], r[1]) for r in edge_rows])
    got = likelihood.likelihoods(edge_docs).collect()
    assert by_row(got, *names) == sorted((w[:5] for w in want), key=str)
    assert sorted(r["base_score"] for r in got) == pytest.approx(sorted(w[5] for w in want), rel=1e-9)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    if known != 64:
        assert likelihood.likelihoods(no_docs).count() == 0


def test_likelihood_learns_order(spark):
    """Words that alternate strictly are far likelier to the model than to the base."""
    rows = [(k, "red green blue " * (20 + k % 7)) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = likelihood.likelihoods(docs).where("held_out")
    sums = got.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert sums[0] > 0.5 * sums[1]  # logarithms: the larger is the likelier


def test_likelihood_learns_from_every_training_document(spark, monkeypatch):
    """Each token of the training documents reaches the training once, and a gradient within it."""
    rows = [(k, f"w{k} " * (1 + k % 5)) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    training = docs.where(~held_out(F.col("doc_id"), likelihood.FOLDS))
    words = likelihood.statistics(likelihood.token_counts(training, 4), 4)
    used = spark.sparkContext.accumulator(0)

    def count(network, tokens, end):
        used.add(len(tokens) - 1)
        return network

    monkeypatch.setattr(likelihood, "train", count)
    ready = likelihood.prepared(docs, words, 4)
    likelihood.learned(ready.where("row is not null"), words)
    assert used.value == words.total


def plain_log(network, tokens):
    """Natural log-likelihood of one document, token by token."""
    state, previous, total = np.zeros((1, recurrent.HIDDEN), np.float32), 0, 0.0
    for token in tokens:
        state = network.step(np.array([previous]), state)[0]
        kind, place = divmod(int(token), recurrent.CLASSES)
        over_classes = state[0].astype(float) @ network.classes + network.class_bias
        within = state[0].astype(float) @ network.words[kind] + network.word_bias[kind]
        total += over_classes[kind] - np.log(np.exp(over_classes).sum()) + within[place] - np.log(np.exp(within).sum())
        previous = int(token)
    return total


@pytest.mark.parametrize("known", [likelihood.KNOWN, 64])
def test_likelihood_score_is_the_models(spark, monkeypatch, known):
    """The score against a plain pass over each document, unknown and rare words included."""
    draw = np.random.default_rng(4)
    rows = [(k, " ".join(f"w{int(x)}" for x in draw.zipf(1.3, draw.integers(0, 60)))) for k in range(300)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(likelihood, "KNOWN", known)
    monkeypatch.setattr(likelihood, "SCORED", 500)
    network = recurrent.Network.start(draw.random(recurrent.SIZE) * 100)
    monkeypatch.setattr(likelihood, "learned", lambda rows, words: network)
    got = {r["doc_id"]: r["score"] for r in likelihood.likelihoods(docs).collect()}

    def tokens(text):
        return next(likelihood.token_stream(pa.array([text])))[1]

    training = [t for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 10 != 0]
    counts = Counter(x for t in training for x in tokens(t).tolist())
    buckets = parallelism(docs)
    words = likelihood.statistics(likelihood.token_counts(spark.createDataFrame([(t,) for t in training], "text string"), buckets), buckets)
    kinds = Counter()
    sizes = Counter()
    model = {int(h): int(m) for h, m in zip(words.hashes, words.model) if m >= 0}
    for x, n in counts.items():
        if x and x not in model:
            kinds[x % recurrent.TYPES] += n
            sizes[x % recurrent.TYPES] += 1
    for doc_id, text in rows:
        numbers, rest = [], 0.0
        for x in tokens(text).tolist():
            if x in model:
                numbers.append(model[x])
                continue
            kind = x % recurrent.TYPES
            numbers.append(recurrent.SIZE - recurrent.TYPES + kind)
            rest += math.log10((counts[x] + 0.1) / (kinds[kind] + 0.1 * (sizes[kind] + 1)))
        assert got[doc_id] == pytest.approx(plain_log(network, numbers) / math.log(10) + rest, rel=1e-4, abs=1e-3)


def test_training_leaves_no_token_out(monkeypatch):
    seen = Counter()

    def note(self, previous, target, fresh, state):
        seen.update(target.ravel().tolist())
        return [np.zeros_like(p) for p in self.parts()], state

    monkeypatch.setattr(recurrent.Network, "gradients", note)
    for n in (1, 3, 7, 1021):
        seen.clear()
        recurrent.train(recurrent.Network.start(np.ones(recurrent.SIZE)), np.concatenate([[0], np.arange(n) + 1, [0]]), 0)
        assert set(seen) == set(range(n + 1))
