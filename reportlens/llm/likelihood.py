"""Log-likelihood of whole documents under a recurrent model and under a unigram base.

1. Word counts of all training documents. Tasks count by hash and hand on one block of counts
   per bucket; the most frequent ``KNOWN`` words, a fixed bound, are broadcast with their counts.
2. One pass writes every document as numbers of the model's tokens, two bytes each, with the sums
   that need no model. What depends on words beyond ``KNOWN`` is left open there and filled in by
   joining those words with their counts, bucket by bucket.
3. The network learns on all training documents, dealt over ``ROUNDS``: in each round every task
   trains a copy on its own documents of the round, and the copies are averaged, weighted by
   tokens. A last pass scores the numbers of all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, held_out, land, parallelism
from .recurrent import SIZE, TYPES, Network, score, train
from .shingles import segments, text_chunks, word_hashes

FOLDS = 10
KNOWN = 1 << 20
#: Every training document belongs to one round.
ROUNDS = 2
FLUSH = 4_000_000
END = np.uint64(0)
SMOOTH = 0.1
#: Tokens scored side by side.
SCORED = 1 << 20
#: A row's number is its task and its place there.
TASK_BITS = 36
COUNTS = "bucket int, n long, data binary"
ROWS = "row long, doc_id long, round int, n_tokens long, n_known long, base double, rest double, tokens binary"


def token_stream(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, token hashes, bounds): the words of each text and its end.

    The low bits of a word's hash are its type, taken from its last three bytes.
    """
    for row, data, bounds in text_chunks(column):
        if len(bounds) == 2:
            pieces = [typed_words(piece, np.array([0, len(piece)]))[0] for piece in segments(data)]
            tokens = np.concatenate([*pieces, np.array([END])])
            yield row, tokens, np.array([0, len(tokens)])
            continue
        words, first = typed_words(data, bounds)
        bounds = first + np.arange(len(first))
        tokens = np.full(int(bounds[-1]), END)
        tokens[np.arange(len(words)) + np.repeat(np.arange(len(first) - 1), np.diff(first))] = words
        yield row, tokens, bounds


def typed_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, with their types, of all words of the texts in ``data``, and each text's first word."""
    words, begins, ends, first = word_hashes(data, bounds)
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
    padded = np.concatenate([np.zeros(3, np.uint64), low])
    tail = padded[ends + 2]
    for back in (2, 3):
        tail = tail * np.uint64(65599) + np.where(ends - begins >= back, padded[ends + 3 - back], np.uint64(0))
    kind = (tail * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TYPES.bit_length() + 1)
    return np.maximum(words & ~np.uint64(TYPES - 1) | kind, np.uint64(TYPES)), first


def blocks(hashes: np.ndarray, buckets: int, *columns: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, rows, bytes of the columns) for every bucket of hashes."""
    of = (hashes >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(of, kind="stable")
    cuts = np.searchsorted(of[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        at = order[cuts[b] : cuts[b + 1]]
        yield b, len(at), b"".join([hashes[at].tobytes(), *[c[at].tobytes() for c in columns]])


def opened(table: pa.Table, *kinds: type) -> list[np.ndarray]:
    """The joined columns of ``blocks``."""
    parts: list[list[np.ndarray]] = [[np.zeros(0, k)] for k in kinds]
    for n, data in zip(table.column("n").to_pylist(), table.column("data").to_pylist()):
        at = 0
        for part, kind in zip(parts, kinds):
            part.append(np.frombuffer(data, kind, n, at))
            at += part[-1].nbytes
    return [np.concatenate(p) for p in parts]


def count_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    b, n, data = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(n, pa.int64()), pa.array(data, pa.binary())], ["bucket", "n", "data"])


def token_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket with all token hashes of ``texts`` and their counts. Landed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for _, tokens, _ in token_stream(batch.column("text")):
                waiting.append(tokens)
                held += len(tokens)
                if held >= FLUSH:
                    x, n = np.unique(np.concatenate(waiting), return_counts=True)
                    yield count_rows(list(blocks(x, buckets, n.astype(np.int64))))
                    waiting, held = [], 0
        if waiting:
            x, n = np.unique(np.concatenate(waiting), return_counts=True)
            yield count_rows(list(blocks(x, buckets, n.astype(np.int64))))

    def merge(table: pa.Table) -> pa.Table:
        hashes, counts = opened(table, np.uint64, np.int64)
        x, at = np.unique(hashes, return_inverse=True)
        total = np.bincount(at, counts, len(x)).astype(np.int64)
        data = pa.array([x.tobytes() + total.tobytes()], pa.large_binary()).cast(pa.binary())
        return pa.table({"bucket": table.column("bucket")[:1], "n": pa.array([len(x)]), "data": data})

    return land(texts.select("text").mapInArrow(run, COUNTS).groupBy("bucket").applyInArrow(merge, COUNTS), "counts")


@dataclass
class Words:
    """Corpus statistics: frequent words with counts; the model's words; counts by type."""

    hashes: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int
    model: np.ndarray
    rest_tokens: np.ndarray
    rest_words: np.ndarray

    def places(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among the frequent words, whether it is one)."""
        if not len(self.hashes):
            return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
        at = np.minimum(np.searchsorted(self.hashes, tokens), len(self.hashes) - 1)
        return at, self.hashes[at] == tokens

    def rest_share(self) -> tuple[np.ndarray, np.ndarray]:
        """Per type, log10 of the denominator of a word's share among its type's words."""
        size = self.rest_tokens + SMOOTH * (self.rest_words + 1)
        return np.log10(size), size


def statistics(counts: DataFrame, buckets: int) -> Words:
    limit = KNOWN // buckets

    def top(table: pa.Table) -> pa.Table:
        x, n = opened(table, np.uint64, np.int64)
        kind = (x % np.uint64(TYPES)).astype(np.int64)
        word = x != END
        first = np.argsort(-n, kind="stable")[:limit]
        sums = np.concatenate([np.bincount(kind[word], n[word], TYPES), np.bincount(kind[word], minlength=TYPES)])
        data = x[first].tobytes() + n[first].tobytes() + sums.astype(np.float64).tobytes()
        return pa.table({
            "n": pa.array([len(first)]), "total": pa.array([int(n.sum())]), "distinct": pa.array([len(x)]),
            "data": pa.array([data], pa.binary()),
        })

    rows = counts.groupBy("bucket").applyInArrow(top, "n long, total long, distinct long, data binary").collect()
    # At most KNOWN words of 16 bytes and two numbers per type and bucket.
    hashes = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(r["data"], np.uint64, r["n"]) for r in rows]])
    number = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(r["data"], np.int64, r["n"], 8 * r["n"]) for r in rows]])
    sums = sum((np.frombuffer(r["data"], np.float64, 2 * TYPES, 16 * r["n"]) for r in rows), np.zeros(2 * TYPES))
    order = np.argsort(hashes)
    hashes, number = hashes[order], number[order]
    # Token numbers: the end is 0, then the most frequent words, then the types of all others.
    by_count = np.lexsort((hashes, -number))
    chosen = by_count[hashes[by_count] != END][: SIZE - TYPES - 1]
    model = np.full(len(hashes), -1, dtype=np.int32)
    model[hashes == END] = 0
    model[chosen] = np.arange(1, len(chosen) + 1)
    kind = (hashes[chosen] % np.uint64(TYPES)).astype(np.int64)
    return Words(
        hashes, number, sum(r["total"] for r in rows), sum(r["distinct"] for r in rows), model,
        sums[:TYPES] - np.bincount(kind, number[chosen], TYPES), sums[TYPES:] - np.bincount(kind, minlength=TYPES),
    )


def numbered(words: Words, tokens: np.ndarray, at: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The model's token numbers."""
    rest = (SIZE - TYPES + tokens % np.uint64(TYPES)).astype(np.int32)
    own = words.model[at] if len(words.model) else np.full(len(tokens), -1, np.int32)
    return np.where(tokens == END, np.int32(0), np.where(known & (own >= 0), own, rest))


def prepared(docs: DataFrame, words: Words, buckets: int) -> DataFrame:
    """Rows of ``ROWS``, one per document, and rows of ``COUNTS``: unknown words by bucket, with the
    numbers of their rows. Landed.

    ``round`` is the one in which a document is learned from, null if it is held out. ``base``
    and ``rest`` are the known words' parts of the base and of what follows rest tokens.
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)
    base_size = math.log10(words.total + SMOOTH * (words.distinct + 1))
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)).cast("int")
    learns = F.coalesce(fold_of(F.col("doc_id"), FOLDS) != 0, F.lit(True))
    source = docs.select("doc_id", F.when(learns, turn).alias("round"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        rest_size, _ = words.rest_share()
        task, done = TaskContext.get().partitionId() << TASK_BITS, 0
        for batch in batches:
            for row, tokens, bounds in token_stream(batch.column("text")):
                n = len(bounds) - 1
                of = np.repeat(np.arange(n), np.diff(bounds))
                at, known = words.places(tokens)
                model = numbered(words, tokens, at, known).astype(np.uint16)
                rest = model >= SIZE - TYPES
                found = np.log10(np.where(known, words.counts[at] if len(words.counts) else 0, 0) + SMOOTH)
                found = np.where(known, found, 0.0)
                numbers = task + done + np.arange(n)
                done += n
                columns = {
                    "row": pa.array(numbers),
                    "doc_id": batch.column("doc_id").slice(row, n),
                    "round": batch.column("round").slice(row, n),
                    "n_tokens": pa.array(np.diff(bounds)),
                    "n_known": pa.array(np.bincount(of, known, n).astype(np.int64)),
                    "base": pa.array(np.bincount(of, found - base_size, n).astype(np.float64)),
                    "rest": pa.array(np.bincount(of[rest], found[rest] - rest_size[model[rest] - (SIZE - TYPES)], n).astype(np.float64)),
                    "tokens": pa.array([model[a:z].tobytes() for a, z in zip(bounds[:-1], bounds[1:])], pa.binary()),
                }
                nothing = {"bucket": pa.nulls(n, pa.int32()), "n": pa.nulls(n, pa.int64()), "data": pa.nulls(n, pa.binary())}
                yield pa.RecordBatch.from_arrays(list((columns | nothing).values()), list(columns | nothing))
                open_rows = list(blocks(tokens[~known], buckets, numbers[of[~known]]))
                if open_rows:
                    part = count_rows(open_rows)
                    empty = {k: pa.nulls(len(open_rows), v.type) for k, v in columns.items()}
                    yield pa.RecordBatch.from_arrays([*empty.values(), *part.columns], [*empty, "bucket", "n", "data"])

    out = land(source.mapInArrow(run, f"{ROWS}, {COUNTS}"), "prepared")
    shared.unpersist()
    return out


def token_numbers(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, tokens, bounds) of runs of documents of about ``SCORED`` tokens."""
    sizes = np.array([len(x.as_buffer()) // 2 for x in batch.column("tokens")], dtype=np.int64)
    at, upto = 0, np.cumsum(sizes)
    while at < len(sizes):
        before = upto[at] - sizes[at]
        to = max(at + 1, int(np.searchsorted(upto, before + SCORED, side="right")))
        parts = [np.frombuffer(x.as_buffer(), np.uint16) for x in batch.column("tokens").slice(at, to - at)]
        yield at, np.concatenate(parts).astype(np.int32), np.concatenate([[0], upto[at:to] - before])
        at = to


def learned(rows: DataFrame, words: Words) -> Network:
    """Average of the copies that the tasks train on ``rows``, round after round."""
    prior = np.zeros(SIZE)
    ours = words.model >= 0
    prior[words.model[ours]] = words.counts[ours]
    prior[SIZE - TYPES :] = words.rest_tokens
    network = Network.start(prior)
    for number in range(ROUNDS):
        start = network

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, seen, waiting, held = np.zeros(0), 0, [], 0

            def learn() -> None:
                nonlocal weights, seen, waiting, held
                copy = start if not seen else start.filled(weights / seen)
                copy = train(copy, np.concatenate([[0], *waiting]), 0)
                weights = copy.flat().astype(np.float64) * (seen + held)
                seen, waiting, held = seen + held, [], 0

            for batch in batches:
                for _, tokens, _ in token_numbers(batch):
                    waiting.append(tokens)
                    held += len(tokens)
                    if held >= FLUSH:
                        learn()
            if held:
                learn()
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([weights.tobytes()], pa.binary())], ["n", "weights"])

        copies = rows.where(F.col("round") == number).select("tokens").mapInArrow(run, "n long, weights binary")
        add = lambda a, b: (a[0] + b[0], a[1] + b[1])
        seen, weights = (
            copies.rdd.map(lambda r: (r["n"], np.frombuffer(r["weights"]))).treeAggregate((0, 0.0), add, add)
        )
        if seen:
            network = start.filled(weights / seen)
    return network


def scored(rows: DataFrame, network: Network) -> DataFrame:
    """``rows`` with ``lm``, the network's log10 probability, instead of their tokens."""
    kept = [name for name in rows.columns if name != "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = [np.zeros(0)]
            for _, tokens, bounds in token_numbers(batch):
                logs.append(score(network, tokens, bounds, 0) / math.log(10))
            yield batch.select(kept).append_column("lm", pa.array(np.concatenate(logs)))

    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes if name in kept)
    return rows.mapInArrow(run, f"{kinds}, lm double")


def likelihoods(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score; both scores in log10.

    Learns from the documents outside the held-out fold; a row with a null id is not held
    out and learned from. A null text is empty and has the end alone; repeated rows count each; other columns are ignored; an
    empty table gives no row. A long text is tokenized in segments cut at white space; its tokens
    are one row. Words are told apart by 58 bits of a hash and 6 bits of their ending.
    """
    buckets = parallelism(docs)
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    training = whole.where(F.coalesce(fold_of(F.col("doc_id"), FOLDS) != 0, F.lit(True)))
    counts = token_counts(training, buckets)
    words = statistics(counts, buckets)
    ready = prepared(whole, words, buckets)
    rows = ready.where("row is not null").drop("bucket", "n", "data")
    network = learned(rows, words)

    def looked_up(table: pa.Table, rare: pa.Table) -> pa.Table:
        """Sums per document over its words beyond the broadcast ones; a block per scoring task."""
        x, n = opened(table, np.uint64, np.int64)
        hashes, rows = opened(rare, np.uint64, np.int64)
        count = np.zeros(len(hashes))
        if len(x):
            at = np.minimum(np.searchsorted(x, hashes), len(x) - 1)
            count = np.where(x[at] == hashes, n[at], 0)
        own, of = np.unique(rows, return_inverse=True)
        logs = np.bincount(of, np.log10(count + SMOOTH), len(own)).astype(np.float64)
        seen = np.bincount(of, count > 0, len(own)).astype(np.int64)
        tasks, cuts = np.unique(own >> TASK_BITS, return_index=True)
        blobs = [
            own[a:z].tobytes() + logs[a:z].tobytes() + seen[a:z].tobytes() for a, z in zip(cuts, [*cuts[1:], len(own)])
        ]
        return pa.table({
            "task": pa.array(tasks, pa.int64()), "n": pa.array(np.diff([*cuts, len(own)]), pa.int64()),
            "data": pa.array(blobs, pa.binary()),
        })

    def summed(table: pa.Table) -> pa.Table:
        rows, logs, seen = opened(table, np.int64, np.float64, np.int64)
        own, of = np.unique(rows, return_inverse=True)
        return pa.table({
            "row": own, "logs": np.bincount(of, logs, len(own)).astype(np.float64),
            "seen": np.bincount(of, seen, len(own)).astype(np.int64),
        })

    rare = ready.where("bucket is not null").select("bucket", "n", "data")
    sums = (
        counts.groupBy("bucket")
        .cogroup(rare.groupBy("bucket"))
        .applyInArrow(looked_up, "task long, n long, data binary")
        .groupBy("task")
        .applyInArrow(summed, "row long, logs double, seen long")
    )
    extra = F.coalesce("logs", F.lit(0.0))
    slim = rows.select("row", "doc_id", "n_tokens", "n_known", "base", "rest", "tokens")
    return (
        scored(slim, network)
        .join(sums, "row", "left")
        .select(
            "doc_id",
            held_out(F.col("doc_id"), FOLDS).alias("held_out"),
            "n_tokens",
            (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
            F.lit(words.total).cast("long").alias("train_tokens"),
            (F.col("base") + extra).alias("base_score"),
            (F.col("lm") + F.col("rest") + extra).alias("score"),
        )
    )
