"""Repeated byte strings, found by longest-previous-factor arrays in content-made blocks.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts elsewhere.

No single task can hold the suffixes of all texts, so they are dealt into blocks such that
suffixes with the same first ``LENGTH`` bytes meet: every window of that length is keyed by the
smallest hash of its 32-byte strings, its anchor. Neighbouring windows share their anchor and
travel as one stretch of text.

1. Stretches whose anchor occurs once hold no repeated window and are dropped, by hash alone.
2. Stretches that are equal as a whole are one stretch with its number; a number above one means
   that it is repeated throughout.
3. Different stretches with one anchor get a suffix array per block, ordered by their first
   ``LENGTH`` bytes, then by position. The previous and the next smaller position in this order are
   the earlier suffixes that a suffix has most in common with; the longer of the two common
   prefixes is its longest previous factor (LPF). Greater positions give the longest next factor.
   Where a factor reaches ``LENGTH``, the window has an earlier or a later copy.

Anchors with more than ``LONG_LIST`` different stretches would overload a block; their windows
are counted one by one by 128-bit hashes with partial aggregation instead. That is not the method
above, but gives the same spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land, parallelism, text_key
from .shingles import POWERS, mixed, text_chunks

LENGTH = 200
GRAM = 32
LONG_LIST = 50_000
SEGMENT = 1 << 21
#: Blocks per shuffle partition; a task holds one at a time.
BLOCKS = 8
POSITION_BITS = 24
#: Random numbers per byte; unlike those of words they tell upper from lower case.
BYTES = np.random.default_rng(23).integers(1, 2**63, 256, dtype=np.uint64)
STRETCH = "text_key binary, anchor long, content long, place long"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each position on, by doubling."""
    x, step = BYTES[data], 1
    while step < GRAM:
        factor = np.uint64(0x9E3779B97F4A7C15 * (2 * step + 1) % (1 << 64) | 1)
        x = x[:-step] * factor + x[step:]
        x ^= x >> np.uint64(29)
        step *= 2
    return mixed(x)


def stretches(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, anchor hash, content hash) of all stretches.

    ``data`` holds texts that begin and end at ``bounds``; positions count from its start.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none
    hashes = gram_hashes(data)
    position = np.arange(len(hashes), dtype=np.uint64)
    key = hashes >> np.uint64(POSITION_BITS) << np.uint64(POSITION_BITS) | position
    span, width = 1, LENGTH - GRAM + 1
    while 2 * span <= width:
        key, span = np.minimum(key[:-span], key[span:]), 2 * span
    if width > span:
        key = np.minimum(key[: len(key) - (width - span)], key[width - span :])
    at = (key & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    inside = np.zeros(len(at) + 1, dtype=np.int32)
    long_enough = np.diff(bounds) >= LENGTH
    np.add.at(inside, bounds[:-1][long_enough], 1)
    np.add.at(inside, (bounds[1:] - LENGTH + 1)[long_enough], -1)
    inside = np.cumsum(inside)[:-1] > 0
    change = at[1:] != at[:-1]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | change
    last[:-1] &= ~inside[1:] | change
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    up, down = POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTES[data] * up[: len(data)], out=sums[1:], dtype=np.uint64)
    content = mixed((sums[last + LENGTH] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    text = np.searchsorted(bounds, first, side="right") - 1
    return text, first, last, hashes[at[first]].view(np.int64), content.view(np.int64)


def segments(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row, offset in that row's text, bytes, bounds); texts beyond ``SEGMENT`` come in overlapping parts."""
    for row, data, bounds in text_chunks(column, SEGMENT):
        if len(data) <= 2 * SEGMENT:
            yield row, 0, data, bounds
            continue
        for at in range(0, len(data) - LENGTH + 1, SEGMENT):
            part = data[at : at + SEGMENT + LENGTH - 1]
            yield row, at, part, np.array([0, len(part)])


def all_stretches(texts: DataFrame) -> DataFrame:
    """Stretches of ``texts(doc_id, text_key, text)``; place = start * 1024 + number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in STRETCH.split(", ")]
        for batch in batches:
            keys = batch.column("text_key")
            for row, offset, data, bounds in segments(batch.column("text")):
                text, first, last, anchor, content = stretches(data, bounds)
                place = (first - bounds[text] + offset) * 1024 + (last - first + 1)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(text + row)), pa.array(anchor), pa.array(content), pa.array(place)], names
                )

    return texts.select("text_key", "text").mapInArrow(run, STRETCH)


def words_at(data: np.ndarray, beyond: int) -> np.ndarray:
    """The 8 bytes from each position on as a number, ``beyond`` more positions with zeros included."""
    padded = np.concatenate([data, np.zeros(beyond + 8, dtype=np.uint8)])
    words = np.zeros(len(padded) - 7, dtype=np.uint64)
    for k in range(8):
        words = words << np.uint64(8) | padded[k : len(padded) - 7 + k].astype(np.uint64)
    return words


def truncated_ranks(words: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """(size, rank of each position's next ``size`` bytes) for sizes 8, 16, .. up to ``length``.

    Prefix doubling: ranks of strings twice as long come from pairs of ranks. Equal strings have
    equal ranks; positions nearer to the end than a size have ranks that mean nothing.
    """
    ranks, size = np.unique(words, return_inverse=True)[1], 8
    levels = [(size, ranks.astype(np.int32))]
    while size < length:
        shift = min(size, length - size)
        pairs = ranks[: len(ranks) - shift] * (int(ranks.max()) + 1) + ranks[shift:]
        ranks, size = np.unique(pairs, return_inverse=True)[1], size + shift
        levels.append((size, ranks.astype(np.int32)))
    return levels


def common_prefix(words: np.ndarray, levels: list[tuple[int, np.ndarray]], one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many of the first ``LENGTH`` bytes at ``one`` and ``other`` are alike, from the longest level down."""
    longest, whole = levels[-1]
    done = np.where(whole[one] == whole[other], longest, 0)
    open_ = np.flatnonzero(done == 0)
    a, b, n = one[open_], other[open_], np.zeros(len(open_), dtype=np.int64)
    for size, ranks in reversed(levels[:-1]):
        # Less than the whole is alike, so positions stay within it.
        at = np.flatnonzero(n + size < longest)
        n[at] += np.where(ranks[a[at] + n[at]] == ranks[b[at] + n[at]], size, 0)
    differ = words[a + n] ^ words[b + n]
    for k in range(1, 8):
        n += differ < np.uint64(1 << (64 - 8 * k))
    done[open_] = np.minimum(n, longest - 1)
    return done


def previous_smaller(x: np.ndarray) -> np.ndarray:
    """For each place the last one before it with a smaller number, or -1; numbers differ.

    Places in between always hold larger numbers, so a candidate that is larger hands on its own.
    """
    found = np.arange(-1, len(x) - 1)
    open_ = np.arange(len(x))
    while len(open_):
        open_ = open_[found[open_] >= 0]
        open_ = open_[x[found[open_]] > x[open_]]
        found[open_] = found[found[open_]]
    return found


def longest_factors(words: np.ndarray, levels: list[tuple[int, np.ndarray]], at: np.ndarray, rank: np.ndarray, earlier: bool) -> np.ndarray:
    """Per suffix the longest factor, up to ``LENGTH`` bytes, that also begins at an earlier (or a later)
    one of the suffixes; ``at`` are their positions, ascending."""
    order = np.argsort(rank, kind="stable")
    place = order if earlier else -order
    before = previous_smaller(place)
    after = len(place) - 1 - previous_smaller(place[::-1])[::-1]
    out = np.zeros(len(at), dtype=np.int64)
    for near, exists in ((before, before >= 0), (after, after < len(place))):
        mine, theirs = order[exists], order[near[exists]]
        out[mine] = np.maximum(out[mine], common_prefix(words, levels, at[mine], at[theirs]))
    return out


def plausible(data: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Which windows may have a copy: those without a 32-byte string that occurs once.

    Occurrences are counted by a part of their hash, so a count of one is certain.
    """
    hashes = gram_hashes(data)
    size = 1 << min(23, max(12, len(hashes).bit_length() + 1))
    low = (hashes & np.uint64(size - 1)).astype(np.int64)
    once = np.concatenate([[0], np.cumsum(np.bincount(low, minlength=size)[low] == 1)])
    return once[windows + LENGTH - GRAM + 1] == once[windows]


def repeated_windows(data: np.ndarray, windows: np.ndarray, earlier_only: bool) -> np.ndarray:
    """Which of the positions ``windows`` (ascending) have a copy of their ``LENGTH`` bytes at
    another of these positions, or at an earlier one: those whose longest factor reaches ``LENGTH``.

    Only the text of windows that may have a copy is ranked.
    """
    found = np.zeros(len(windows), dtype=bool)
    kept = np.flatnonzero(plausible(data, windows))
    if not len(kept):
        return found
    covered = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(covered, windows[kept], 1)
    np.add.at(covered, windows[kept] + LENGTH, -1)
    covered = np.cumsum(covered)[:-1] > 0
    at = (np.cumsum(covered) - 1)[windows[kept]]
    words = words_at(data[covered], 2 * LENGTH)
    levels = truncated_ranks(words, LENGTH)
    rank = levels[-1][1][at]
    factors = longest_factors(words, levels, at, rank, True)
    if not earlier_only:
        factors = np.maximum(factors, longest_factors(words, levels, at, rank, False))
    found[kept] = factors >= LENGTH
    return found


def spans_of(mask: np.ndarray) -> np.ndarray:
    """(first, last) of each run of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return np.stack([edges[::2], edges[1::2] - 1], axis=1)


def block_spans(table: pa.Table, keep_first: bool) -> pa.Table:
    """Removed spans of the stretches of one block: text_key, first, last byte + 1."""
    table = table.sort_by([("text_key", "ascending"), ("place", "ascending")])
    texts = table.column("bytes").to_pylist()
    place, counted = table.column("place").to_numpy(), place_windows(table)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    of = np.repeat(np.arange(len(texts)), counted)
    windows = np.arange(len(of)) - np.repeat(np.cumsum(counted) - counted, counted) + starts[of]
    found = repeated_windows(data, windows, keep_first)
    out: dict[str, list] = {"text_key": [], "first": [], "last": []}
    keys = table.column("text_key").to_pylist()
    at = 0
    for k, n in enumerate(counted.tolist()):
        for a, b in spans_of(found[at : at + n]).tolist():
            begin = int(place[k]) // 1024
            out["text_key"].append(keys[k])
            out["first"].append(begin + a)
            out["last"].append(begin + b + LENGTH)
        at += n
    return pa.table({"text_key": pa.array(out["text_key"], pa.binary()), **{
        n: pa.array(out[n], pa.int64()) for n in ("first", "last")
    }})


def place_windows(table: pa.Table) -> np.ndarray:
    return table.column("place").to_numpy() % 1024


def with_bytes(rows: DataFrame) -> DataFrame:
    """The bytes of each stretch that ``rows(text_key, text, wanted)`` lists, one row per stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"text_key": [], "anchor": [], "place": [], "hot": [], "bytes": []}
            for key, text, wanted in zip(*(batch.column(x) for x in ("text_key", "text", "wanted"))):
                data = text.as_py().encode("utf-8", "surrogatepass")
                for x in wanted.as_py():
                    begin, n = divmod(x["place"], 1024)
                    out["text_key"].append(key.as_py())
                    out["anchor"].append(x["anchor"])
                    out["place"].append(x["place"])
                    out["hot"].append(x["hot"])
                    out["bytes"].append(data[begin : begin + n + LENGTH - 1])
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out.values(), kinds)], list(out))

    return rows.mapInArrow(run, "text_key binary, anchor long, place long, hot boolean, bytes binary")


def window_spans(hot: DataFrame, keep_first: bool) -> DataFrame:
    """Like ``block_spans`` for any number of stretches with one anchor: windows by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, place, data in zip(*(batch.column(x).to_pylist() for x in ("text_key", "place", "bytes"))):
                n = place % 1024
                digests = [hashlib.blake2b(data[i : i + LENGTH], digest_size=16).digest() for i in range(n)]
                starts = np.arange(n) + place // 1024
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array([key] * n, pa.binary()), pa.array(starts)],
                    ["window", "text_key", "first"],
                )

    windows = land(hot.mapInArrow(run, "window binary, text_key binary, first long").distinct(), "windows")
    counts = windows.groupBy("window").agg(
        F.count("*").alias("n"), F.min(F.struct("text_key", "first")).alias("origin")
    )
    counts = land(counts.where("n > 1"), "window-counts")
    found = windows.join(counts, "window")
    if keep_first:
        found = found.where(F.struct("text_key", "first") != F.col("origin"))
    return found.select("text_key", "first", (F.col("first") + LENGTH).alias("last"))


def removed_spans(texts: DataFrame, keep_first: bool, long_list: int = LONG_LIST) -> DataFrame:
    """Spans (text_key, first, last + 1) of bytes to remove; they may overlap."""
    # Copies of a text give equal rows; they are counted through ``copies`` below.
    found = land(all_stretches(texts), "stretches")
    repeated = found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    repeated = land(repeated, "anchors")
    kept = land(found.join(repeated, "anchor", "left_semi"), "repeated")

    by_content = land(
        kept.groupBy("anchor", "content").agg(
            F.count("*").alias("n"), F.min(F.struct("text_key", "place")).alias("origin")
        ),
        "contents",
    )
    lists = by_content.groupBy("anchor").agg(F.count("*").alias("different")).where("different > 1")
    lists = land(lists, "lists")

    # Whole stretches that occur more than once.
    whole = kept.join(land(by_content.where("n > 1"), "copied"), ["anchor", "content"])
    if keep_first:
        whole = whole.where(F.struct("text_key", "place") != F.col("origin"))
    begin = F.floor(F.col("place") / 1024)
    whole = whole.select("text_key", begin.alias("first"), (begin + F.col("place") % 1024 + LENGTH - 1).alias("last"))

    # One stretch of each content, where an anchor has several.
    wanted = (
        by_content.join(lists, "anchor")
        .select("origin.text_key", "origin.place", "anchor", (F.col("different") > long_list).alias("hot"))
        .groupBy(F.struct("text_key").alias("key"))
        .agg(F.collect_list(F.struct("anchor", "place", "hot")).alias("wanted"))
        .select("key.text_key", "wanted")
    )
    # One copy of each text, made in the map tasks first, however many there are.
    different = texts.groupBy(F.struct("text_key").alias("key")).agg(F.first("text").alias("text"))
    different = different.select("key.text_key", "text").join(wanted, "text_key")
    compared = land(with_bytes(different.select("text_key", "text", "wanted")), "compared")
    blocks = BLOCKS * parallelism(texts)
    block = F.pmod(F.xxhash64("anchor"), F.lit(blocks))
    inside = (
        compared.where("not hot")
        .select(block.alias("block"), "text_key", "place", "bytes")
        .groupBy("block")
        .applyInArrow(lambda t: block_spans(t, keep_first), "text_key binary, first long, last long")
    )
    spans = whole.unionByName(inside)
    if lists.where(F.col("different") > long_list).limit(1).count():
        spans = spans.unionByName(window_spans(compared.where("hot"), keep_first))
    return spans


def without_repeats(
    docs: DataFrame, keep_first: bool = False, keep_text: bool = False, long_list: int = LONG_LIST
) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    With ``keep_first`` the first copy of every string stays, in the order of texts' keys; equal
    texts then count as one text, of which all rows keep what one keeps. With ``keep_text`` the
    remaining bytes follow as ``kept``. A null text is empty; texts shorter than ``LENGTH`` bytes
    stay as they are. Repeated rows, also with equal or null ids, are copies. Other columns are
    ignored; an empty table gives no row.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text).alias("text_key"), text.alias("text"))
    source = texts.select("text_key", "text")
    spans = removed_spans(source.distinct() if keep_first else source, keep_first, long_list)
    by_text = (
        spans.groupBy(F.struct("text_key").alias("key"))
        .agg(F.collect_set(F.struct("first", "last")).alias("spans"))
        .select("key.text_key", "spans")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, found in zip(batch.column("text"), batch.column("spans")):
                data = text.as_py().encode("utf-8", "surrogatepass")
                rest, at, n_spans = [], 0, 0
                for first, last in sorted((x["first"], x["last"]) for x in found.as_py() or ()):
                    if first > at or not n_spans:
                        rest.append(data[at:first])
                        n_spans += 1
                    at = max(at, last)
                kept = b"".join([*rest, data[at:]])
                rows.append((len(data), len(data) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    joined = texts.join(by_text, "text_key", "left").select("doc_id", "text", "spans")
    done = joined.mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    return done if keep_text else done.drop("kept")
