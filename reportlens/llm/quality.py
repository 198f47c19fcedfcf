"""Quality classifier by Bradley-Terry pairwise ranking.

Every pair of a preferred and a rejected document says that the first has the higher score. The
scores are linear in features of the text, learned by logistic loss on feature differences of
pairs; the threshold is the quantile of the scores that equals the share of rejected labels.

The fit takes all labelled documents and all their pairs. Their features are landed; each round
counts all scores in ``BINS`` bins per class, which gives every document its mean miss against all
documents of the other class, and a second pass sums the gradient. What tasks send back has a fixed
size. Scoring is one pass over the documents with no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, held_out, land, packed, unpacked

FOLDS = 5
ROUNDS = 30
#: Scores are counted in bins of this range, a bin by the mean of its scores; those beyond in the last bins.
BINS = 1024
REACH = 32.0
#: Bits of a map of labelled ids; documents outside it are passed over, those inside are joined exactly.
MAP_BITS = 1 << 26
KEEP_FROM = 0.3
#: Kinds of bytes whose neighbourhoods are counted; all others are one more kind.
KINDS = (
    b"aeiou", b"bcdfghjklmnpqrstvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b"\t\x0b\x0c",
    b".", b",", b"!?", b"'\"`", b"#*_~^", b"$%&@+=", b"|/\\", b"()[]{}<>", b"-:;", bytes(range(128, 256)),
)
N_KINDS = len(KINDS) + 1
N_FEATURES = N_KINDS * N_KINDS + N_KINDS + 5
CHUNK = 1 << 22


def kind_table() -> np.ndarray:
    table = np.full(256, len(KINDS), dtype=np.int64)
    for k, members in enumerate(KINDS):
        table[list(members)] = k
    return table


def features(text: str, table: np.ndarray) -> np.ndarray:
    """Shares of kinds of bytes and of neighbouring kinds, and how far words repeat.

    A text without words has the shares 0 and, with its length 0, features of its own.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    pairs, single = np.zeros(N_KINDS * N_KINDS), np.zeros(N_KINDS)
    for at in range(0, len(data), CHUNK):
        kinds = table[data[at : at + CHUNK + 1]]
        pairs += np.bincount(kinds[:-1] * N_KINDS + kinds[1:], minlength=len(pairs))
        single += np.bincount(kinds[:CHUNK], minlength=N_KINDS)
    words = text.split()
    n, unique = len(words), len(set(words))
    again = sum(map(eq, words, words[1:]))
    size = max(len(data), 1)
    rest = [math.log1p(len(data)), math.log1p(n), unique / max(n, 1), again / max(n, 1), len(data) / max(n, 1) / 64]
    return np.concatenate([np.sqrt(pairs / size), np.sqrt(single / size), np.minimum(rest, 16)]).astype(np.float32)


@dataclass
class Ranking:
    """Learned weights; ``threshold`` is the raw score at which documents are kept."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores in (0, 1); ``KEEP_FROM`` at the threshold."""
        raw = ((x - self.mean) / self.scale) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(raw + math.log(KEEP_FROM / (1 - KEEP_FROM)), -30, 30)))


#: Calls a function of (features, labels) for all blocks of rows and combines the results; None without rows.
Passes = Callable[..., np.ndarray | None]


def moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per class, one below the other: count, sums and products of the features."""
    one = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    return np.concatenate([one[y == k].T @ one[y == k] for k in (0, 1)])


def binned(raw: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per class: how many scores are in each bin, and their sums."""
    at = np.clip((raw + REACH) * (BINS / (2 * REACH)), 0, BINS - 1).astype(np.int64)
    rows = [(np.bincount(at[y == k], w, BINS)) for k in (0, 1) for w in (None, raw[y == k])]
    return np.stack(rows).astype(np.float64)


def mean_misses(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points of the score, and there the mean miss of a preferred and of a rejected document
    against all documents of the other class."""
    points = np.linspace(-REACH, REACH, BINS + 1)

    def against(counts: np.ndarray, sums: np.ndarray, sign: int) -> np.ndarray:
        some = counts > 0
        gaps = sign * (points[:, None] - sums[some] / counts[some])
        return (1 / (1 + np.exp(np.clip(gaps, -60, 60)))) @ counts[some] / counts.sum()

    return points, against(bins[0], bins[1], 1), against(bins[2], bins[3], -1)


def quantile(passes: Passes, raw_of: Callable, each: tuple[float, float], share: float) -> float:
    """The middle between the scores up to which rows weigh ``share`` and the next one above, found by
    narrowing the range; ``each`` is the weight of a row of either class."""
    ends = passes(lambda x, y: np.array([raw_of(x).min(), -raw_of(x).max()]), np.minimum)
    low, high = ends[0], -ends[1]
    for _ in range(5):
        edges = np.linspace(low, high, BINS + 1)

        def up_to(x: np.ndarray, y: np.ndarray, edges=edges) -> np.ndarray:
            raw = raw_of(x)
            return np.stack([np.searchsorted(np.sort(raw[y == k]), edges, "right") for k in (0, 1)]).astype(np.float64)

        weight = np.array(each) @ passes(up_to)
        at = min(int(np.searchsorted(weight, share - 1e-9)), BINS)
        low, high = edges[max(at - 1, 0)], edges[at]

    def around(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        raw = raw_of(x)
        return np.array([raw[raw <= high].max(initial=-math.inf), -raw[raw > high].min(initial=math.inf)])

    below, above = passes(around, np.maximum) * [1, -1]
    return float(below + above) / 2 if math.isfinite(above) else float(below)


def fit(passes: Passes, share: float | None = None, ridge: float = 1e-3) -> Ranking | None:
    """Bradley-Terry scores from all pairs of a preferred and a rejected row (labels 1 and 0).

    ``share`` is the part of all documents that is labelled 0, by default that of these rows.
    Accelerated steps under a bound of the second derivative, which the moments give once.
    Without pairs all weights are 0; None without rows.
    """
    sums = passes(moments)
    if sums is None:
        return None
    per_class = sums.reshape(2, len(sums) // 2, -1)
    both = per_class.sum(axis=0)
    rows = per_class[:, 0, 0]
    share = rows[0] / rows.sum() if share is None else share
    mean = both[0, 1:] / both[0, 0]
    scale = np.sqrt(np.maximum(both.diagonal()[1:] / both[0, 0] - mean**2, 0)) + 1e-2
    w = np.zeros(len(mean))
    if not rows.all():
        return Ranking(mean, scale, w, -math.inf if share < 0.5 else math.inf)
    means = per_class[:, 0, 1:] / rows[:, None]
    spread = sum(m[1:, 1:] / n - np.outer(v, v) for m, n, v in zip(per_class, rows, means))
    spread = spread + np.outer(means[1] - means[0], means[1] - means[0])
    bound = spread / np.outer(scale, scale) / 4 + ridge * np.eye(len(w))

    def scorer(weights: np.ndarray) -> Callable:
        per_feature = weights / scale
        start = mean @ per_feature
        return lambda x: x @ per_feature - start

    ahead, t = w, 1.0
    for _ in range(ROUNDS):
        raw_of = scorer(ahead)
        curves = mean_misses(passes(lambda x, y, raw_of=raw_of: binned(raw_of(x), y)))

        def pull(x: np.ndarray, y: np.ndarray, raw_of=raw_of, curves=curves) -> np.ndarray:
            points, preferred, rejected = curves
            raw = raw_of(x)
            miss = np.where(y == 1, np.interp(raw, points, preferred) / rows[1], -np.interp(raw, points, rejected) / rows[0])
            return np.append(miss @ x, miss.sum())

        total = passes(pull)
        gradient = (total[:-1] - total[-1] * mean) / scale - ridge * ahead
        after = ahead + np.linalg.solve(bound, gradient)
        if gradient @ (after - w) < 0:  # too fast: start anew
            t = 1.0
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        moved = after - w
        ahead, w, t = after + (t - 1) / t_next * moved, after, t_next
        if moved @ bound @ moved < 1e-8:
            break
    each = (share / rows[0], (1 - share) / rows[1])
    return Ranking(mean, scale, w, quantile(passes, scorer(w), each, share))


def fit_pairs(x: np.ndarray, y: np.ndarray, share: float) -> Ranking:
    """``fit`` of rows at hand."""
    x = x.astype(np.float64)
    return fit(lambda of, combine=np.add: of(x, y), share)


def over_rows(rows: DataFrame) -> Passes:
    """Passes over the landed ``rows(label int, x binary)``; a task sends back one row per row of its result."""

    def passes(of: Callable, combine=np.add) -> np.ndarray | None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done = None
            for batch in batches:
                if batch.num_rows:
                    x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).reshape(batch.num_rows, -1)
                    found = np.atleast_2d(of(x.astype(np.float64), batch.column("label").to_numpy()))
                    done = found if done is None else combine(done, found)
            if done is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(done), dtype=np.int32)), pa.array([r.tobytes() for r in done], pa.binary())],
                    ["part", "data"],
                )

        def joined(table: pa.Table) -> pa.Table:
            data = reduce(combine, (np.frombuffer(r) for r in sorted(table.column("data").to_pylist())))
            return pa.table({"part": table.column("part")[:1], "data": pa.array([data.tobytes()], pa.binary())})

        parts = rows.mapInArrow(frugal(run), "part int, data binary")
        if of is moments:  # a matrix of each task: added up row by row
            parts = parts.groupBy("part").applyInArrow(joined, "part int, data binary")
        found: dict[int, list[bytes]] = {}
        for row in parts.collect():
            found.setdefault(row["part"], []).append(bytes(row["data"]))
        sums = [reduce(combine, map(np.frombuffer, sorted(found[k]))) for k in sorted(found)]
        return (sums[0] if len(sums) == 1 else np.stack(sums)) if sums else None

    return passes


def with_features(docs: DataFrame, columns: str, finish) -> DataFrame:
    """Map (columns..., text) in Arrow batches through ``finish(batch, features)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kind_table()
        for batch in batches:
            if batch.num_rows:
                rows = [features(t.as_py() or "", table) for t in batch.column("text")]
                yield finish(batch, np.stack(rows))

    return docs.mapInArrow(frugal(run), columns)


def learn(docs: DataFrame, labels: DataFrame) -> Ranking:
    """Fit on all labelled documents outside the held-out fold.

    Several labels of one id count as their mean, rounded, halves down; labels with nulls are
    left out. If one class is missing, everything gets the score of the other.
    """
    voted = (
        labels.select("doc_id", "quality")
        .where("doc_id is not null and quality is not null")
        .where(~held_out(F.col("doc_id"), FOLDS))
        .groupBy("doc_id")
        .agg((F.avg("quality") > 0.5).cast("int").alias("label"))
    )
    voted = land(voted, "quality-labels")
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(MAP_BITS))
    known = land(packed(voted.select(bit.alias("bit")), "bit", F.lit(1)), "quality-map")
    some = docs.select(F.col("doc_id").cast(voted.schema["doc_id"].dataType).alias("doc_id"), "text")
    chosen = unpacked(some, bit, known, "hit").select("doc_id", "text")

    def keep(batch: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "x"]
        )

    vectors = with_features(chosen, f"doc_id {dict(chosen.dtypes)['doc_id']}, x binary", keep)
    # Always by shuffle: the vectors, not the texts, and one row per labelled id.
    rows = land(vectors.join(voted.hint("shuffle_hash"), "doc_id").select("label", "x"), "quality-features")
    model = fit(over_rows(rows))
    return model or Ranking(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0)


def rank(docs: DataFrame, model: Ranking) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``.

    Null and empty texts are scored like any other text. Other columns are ignored, repeated
    rows are kept, an empty table gives no row; a null id is not held out.
    """

    def score(batch: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    scored = with_features(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
        "doc_id long, score double",
        score,
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"),
    )


def kept(docs: DataFrame, model: Ranking) -> DataFrame:
    """The rows of ``docs``, all columns, whose text reaches the threshold."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def keep(batch: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
        return batch.filter(pa.array(model.score(x) >= KEEP_FROM))

    return with_features(docs, kinds, keep)
