"""Importance resampling of documents towards a target distribution.

Features are the runs of one and two words, hashed into buckets. Documents and target texts are
counted per bucket; a bucket's gain is the scaled logarithm of its smoothed odds in the target. A
document's weight is the mean gain of its features. A Gumbel number from the document's id, added
to the weight, makes the highest scores a sample without replacement by importance weight.

Both passes intern the n-grams of each batch in an open-addressed table (``ngrams.py``). The first
adds its counts up per bucket; the second gathers gains through the slots of the occurrences. What
travels between them are 10,000 counts per task, and 10,000 gains to every task.

Scores are whole numbers within some 120,000 of 0, because gains are logarithms of quotients of
64-bit counts and the noise depends on 32 bits. So there are few different scores however many
documents, and ranks come from the number of documents per score plus the order within one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import land
from .ngrams import grams

BUCKETS = 10_000
LONGEST = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7


def texts_of(batch: pa.RecordBatch) -> Iterator[str | None]:
    return (value.as_py() for value in batch["text"])


def bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features per bucket, one row per bucket met by the task."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for piece in grams(texts_of(batch), LONGEST, BUCKETS):
            np.add.at(total, piece.bucket, piece.count)
    met = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])


def histogram(texts: DataFrame) -> np.ndarray:
    """Features of all texts per bucket."""
    text = texts.select(F.col("text").cast("string").alias("text"))
    counted = text.mapInArrow(bucket_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in counted.collect():  # one row per bucket
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's floored, scaled logarithm of its odds in the target."""
    s, t = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    odds = (((b + 1.0) * s) / ((a + 1.0) * t) for a, b in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(x)) for x in odds], dtype=np.int64)


def weighed(batches: Iterator[pa.RecordBatch], gain: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``doc_id, n_words, n_features, weight`` per document."""
    for batch in batches:
        n = batch.num_rows
        words, features, sums = (np.zeros(n, dtype=np.int64) for _ in range(3))
        for piece in grams(texts_of(batch), LONGEST, BUCKETS):
            rows = len(piece.words)
            here = slice(piece.first, piece.first + rows)
            words[here] += piece.words
            features[here] += np.bincount(piece.row, minlength=rows)
            each = gain[piece.bucket][piece.slot]
            # Sums of whole numbers far below 2^53 are exact in doubles.
            sums[here] += np.bincount(piece.row, weights=each, minlength=rows).astype(np.int64)
        weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
        columns = [batch["doc_id"], pa.array(words), pa.array(features), pa.array(weight)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])


def noise(doc_id: str, seed: int):
    """Scaled Gumbel number from the first 32 bits of the id's SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def drawn(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with ``rank`` of the documents drawn: the highest scores, ties to smaller ids.

    A null id comes after the others; rows with equal score and id are told apart by ``row``.
    """
    can = F.col("n_words") >= least_words
    per_score = scored.where(can).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    # One row per different score, see above.
    order = Window.orderBy(F.desc("score"))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = per_score.select(
        F.col("score").alias("of_score"),
        (F.sum("n").over(order) - F.col("n")).alias("before"),
        F.floor(F.sum("n").over(everything) * percent / 100).cast("long").alias("most"),
    ).where("before < most")
    placed = land(placed, "scores")
    # At most 240,000 rows of 24 bytes. The noise spreads the documents of any weight over thousands of scores.
    candidate = scored.join(F.broadcast(placed), can & (F.col("score") == F.col("of_score")), "left")
    within = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "row")
    rank = (F.col("before") + F.row_number().over(within)).cast("long")
    inside = candidate.where("before is not null").withColumn("rank", rank)
    outside = candidate.where("before is null").withColumn("rank", F.lit(None).cast("long"))
    both = inside.unionByName(outside)
    return both.withColumn("rank", F.when(F.col("rank") <= F.col("most"), F.col("rank"))).drop("of_score", "before", "most")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Per document: ``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` (null: not drawn).

    Reads ``doc_id`` and ``text`` of ``docs`` and ``text`` of ``target``; other columns are
    ignored. A null text has no words; a document without features weighs 0. A null id hashes as
    empty text and comes last among equal scores; repeated rows are drawn one by one. An empty
    target leaves the smoothing alone; an empty table gives no row. Texts of any length are taken
    in pieces, cut between words, without losing the pair of words at the cut.
    """
    table = gains(histogram(docs), histogram(target))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_words long, n_features long, weight long"
    weights = texts.mapInArrow(partial(weighed, gain=table), schema)
    scored = weights.withColumn("score", F.col("weight") + noise("doc_id", seed))
    scored = land(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    return drawn(scored, percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")
