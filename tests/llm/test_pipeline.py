"""The pipeline and each of its stages against brute force, with repeated rows and repeated and null ids."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from texts import prose

import corpus_pipeline
from reportlens.llm import mixing, quality, surrogates
from reportlens.llm.queries import vocabulary

NAMES = ("doc_id", "text", "lang", "source", "n_chars")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text))


def documents():
    a, b = prose(50, 80), prose(51, 90)
    near = a.split(" ")
    near[40] = "changed"
    near = " ".join(near)
    rows = [row(1, a), row(2, a), row(2, b), row(2, near), row(3, near.upper()), row(None, a), row(None, prose(52, 30), "b")]
    rows += [row(None, prose(52, 30), "b"), row(4, ""), row(4, ""), row(5, None), row(6, "one two"), row(7, "ONE two", None)]
    rows += [row(8, "write to ann.lee@example.com or 192.0.2.7 now, " + prose(53, 40)), row(8, prose(54, 50), None)]
    rows += [row(100 + k, f"Plain words of text {k}. " + prose(60 + k, 30 + k % 50), "abc"[k % 3]) for k in range(60)]
    rows += [row(200 + k, f"$$$ !!! {k} ### WIN %%% !!! $$$ @@@ " * 3, "abc"[k % 3]) for k in range(40)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(100 + k, 1, 0) for k in range(60)] + [(200 + k, 0, 0) for k in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def bag(df):
    return Counter(map(tuple, df.select(*NAMES).collect()))


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def without_copies(rows):
    """One row of each component, that with the smallest id, null last."""
    sets, label = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    groups = defaultdict(list)
    for r, s, c in zip(rows, sets, label):
        groups[c].append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0))[0] for g in groups.values()], groups


def test_quality_stage(spark, docs, folder):
    out = corpus_pipeline.quality_classifier(spark, docs, folder)
    assert out.columns == docs.columns
    model = quality.learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    table = quality.kind_table()
    good = [r for r in documents() if model.score(np.array([quality.features(r[1] or "", table)], dtype=np.float32))[0] >= quality.KEEP_FROM]
    assert bag(out) == Counter(good)
    assert {r[0] for r in good if r[0] and r[0] >= 100} == {100 + k for k in range(60)}


def test_near_copy_stage(spark, docs, folder):
    """Decisions are per row: an unrelated text of an id stays, a near copy of the same id goes."""
    out = corpus_pipeline.ngram_jaccard_join(spark, docs, folder)
    assert out.columns == docs.columns
    ids, groups = without_copies(documents())
    got = [tuple(r) for r in out.collect()]
    assert Counter(r[0] for r in got) == Counter(ids)
    for members in groups.values():
        # Of rows that tie on the smallest id any one may stay.
        assert len([1 for r in got if r in members]) >= 1
    texts = [r[1] for r in got]
    assert prose(51, 90) in texts and texts.count(prose(50, 80)) == 1 and texts.count("") == 2


def test_pii_stage(spark, docs, folder):
    want = Counter()
    for doc_id, text, lang, source, n in documents():
        new = surrogates.replaced(text, surrogates.entities(text)) if text else text
        want[(doc_id, new, lang, source, None if new is None else len(new))] += 1
    out = corpus_pipeline.pii(spark, docs, folder)
    assert out.columns == docs.columns and bag(out) == want
    assert not any("ann.lee" in (r[1] or "") or "192.0.2.7" in (r[1] or "") for r in want)


def test_mixture_stage(spark, docs, folder):
    """Whole rows, up to three times each; every source comes near its target."""
    out = corpus_pipeline.mixture(spark, docs, folder)
    assert out.columns == docs.columns
    given, got = Counter(documents()), bag(out)
    assert set(got) <= set(given) and all(n <= 3 * given[r] for r, n in got.items())
    targets = {r["source"]: r["target"] for r in mixing.mix(docs).select("source", "target").distinct().collect()}
    words = Counter()
    for r, n in got.items():
        words[r[3]] += n * len((r[1] or "").split())
    longest = max(len((r[1] or "").split()) for r in documents())
    assert all(abs(words[s] - t) <= longest for s, t in targets.items())
    again = corpus_pipeline.mixture(spark, docs, folder)
    assert bag(again) == got


def test_run_is_all_stages_in_order(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "pii", "mixing", "best_fit_packing"
    ]
    from tokenizers import Tokenizer

    table = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, folder).cache()
    tokenizer = Tokenizer.from_file(vocabulary())
    want = Counter()
    for doc_id, text, *_ in table.collect():
        want[(doc_id, len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1)] += 1
    rows = corpus_pipeline.run(spark, folder).collect()
    got = Counter()
    for r in rows:
        if r["piece"] == 0:
            got[(r["doc_id"], r["length"])] += 1
    assert got == want  # no document here is longer than a sequence
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048


def test_stages_of_nothing(spark, folder, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_workers_give_memory_back(spark, docs, folder, monkeypatch):
    """All that the stages run on texts in Python frees its memory at a task's end, and gets few rows at a time."""
    used, kind, key = [], type(docs), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def watched(df, run, *args, f=kind.mapInArrow, **more):
        used.append(run)
        return f(df, run, *args, **more)

    monkeypatch.setattr(kind, "mapInArrow", watched)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.set(key, before)
            stage(spark, docs, folder)
            if name in ("quality_classifier", "pii"):
                assert int(spark.conf.get(key)) <= 1000
    finally:
        spark.conf.set(key, before)
    assert used and all(hasattr(run, "__wrapped__") for run in used)
