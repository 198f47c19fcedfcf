"""Best-fit packing by exact-complement hashing.

Pieces of at most ``capacity`` tokens go into as few sequences as the method finds. Only the
number of pieces of each length matters for the plan, so the plan is made on a histogram of at
most ``capacity`` counts, whatever the number of documents:

1. index single lengths, then pair sums, then triple sums; a piece with gap ``g`` is combined
   with one, two or three lengths that add up to exactly ``g``, as often as the counts allow;
2. what is left is packed best fit, largest first, again whole patterns at a time.

Pieces then find their slot by their rank among the pieces of the same length. Ranks come from
counts by task and length, so no length, however frequent, passes through one task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import frugal, land, small_batches

CAPACITY = 2048
#: Fixed value: how byte-level tokenizers cut a text before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_RUN = 20_000
RUN = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def byte_alphabet() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable ones stand for
    themselves, the others follow from code point 256 on."""
    plain = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x]
    rest = [x for x in range(256) if x not in plain]
    return {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(rest)}


class Tokens:
    """Token ids of texts under a byte-level vocabulary file of ``tokenizers``.

    The ids are those of ``tokenizers`` itself. The same merges run several times as fast in
    ``tiktoken``, which takes most texts; texts with a special token or with an enormous run
    without a break go to ``tokenizers``, which is loaded when the first of them comes.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.path, exact = path, Tokenizer.from_file(path)
        alphabet = byte_alphabet()
        special = {x.content for x in exact.get_added_tokens_decoder().values()}
        ranks = {
            bytes(map(alphabet.__getitem__, word)): rank
            for word, rank in exact.get_vocab().items()
            if word not in special
        }
        self.special = [x for x in special if x]
        self.fast = tiktoken.Encoding(path, pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def exact(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, text: str) -> np.ndarray:
        if any(x in text for x in self.special) or (len(text) > LONG_RUN and RUN.search(text)):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=())


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones, the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *[(x, capacity) for x in range(first, n, capacity)]]


def tokenized(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """One row per piece, numbered within its task and length."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seen, task = Tokens(tokenizer_path), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                data = tokens.encode(text.as_py() or "").astype("<u4").tobytes() + b"\0\0\0\0"
                for k, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                    crc = zlib.crc32(memoryview(data)[4 * start : 4 * (start + length)])
                    rows.append((doc_id, k, start, length, crc, task, seen[length]))
                    seen[length] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            columns = zip(*rows) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(frugal(pieces), PIECES)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, number of such sequences) that use up ``counts[length]``."""
    left = np.array(counts, dtype=np.int64)
    made: list[tuple[list[int], int]] = []

    def use(lengths: list[int]) -> bool:
        need = Counter(lengths)
        times = min(int(left[x]) // k for x, k in need.items())
        if times > 0:
            made.append((lengths, times))
            for x, k in need.items():
                left[x] -= times * k
        return times > 0

    def pair(total: int) -> tuple[int, int] | None:
        """Two available lengths with this sum, the larger as large as it can be."""
        half = total // 2
        small = np.arange(1, half + 1)
        fits = (left[small] > 0) & (left[total - small] > 0)
        if total % 2 == 0 and half and left[half] < 2:
            fits[-1] = False
        hit = np.flatnonzero(fits)
        return (int(total - small[hit[0]]), int(small[hit[0]])) if len(hit) else None

    if left[capacity]:
        use([capacity])
    longest_first = range(capacity - 1, 0, -1)
    for a in longest_first:
        if left[a]:
            use([a, capacity - a])
    for a in longest_first:
        tried = set()
        while left[a] and (two := pair(capacity - a)) and two not in tried:
            tried.add(two)
            use([a, *two])
    for a in longest_first:
        tried = set()
        while left[a]:
            have = (left[: capacity + 1] > 0).astype(float)
            have[0] = 0
            sums = np.fft.irfft(np.fft.rfft(have, 4 * capacity) ** 2, 4 * capacity)[: capacity + 1] > 0.5
            third = np.arange(1, capacity - a)
            hit = [int(x) for x in third[(have[third] > 0) & sums[capacity - a - third]][::-1] if int(x) not in tried]
            if not hit:
                break
            tried.add(hit[0])
            two = pair(capacity - a - hit[0])
            if two and use([a, hit[0], *two]):
                tried.discard(hit[0])
    for a in longest_first:
        while left[a]:
            left[a] -= 1
            lengths, gap, spare = [a], capacity - a, left.copy()
            left[a] += 1
            while gap:
                fit = np.flatnonzero(spare[1 : gap + 1])
                if not len(fit):
                    break
                best = int(fit[-1]) + 1
                times = min(int(spare[best]), gap // best)
                spare[best] -= times
                gap -= times * best
                lengths += [best] * times
            use(lengths)
    return made


def slots(made: list[tuple[list[int], int]]) -> np.ndarray:
    """Rows (length, first rank, sequences, first sequence, offset), sorted by length and rank."""
    rows, used, sequence = [], Counter(), 0
    for lengths, times in made:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], times, sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Place of every piece of every document (``doc_id``, ``text``; other columns are ignored).

    A null text is empty and holds only the closing id 0; repeated rows and rows with a null id
    are packed each for itself; an empty table gives no row. Which of several pieces of equal
    length gets which slot follows the order of tasks and rows.
    """
    with small_batches(docs.sparkSession):
        pieces = land(tokenized(docs, tokenizer_path, capacity), "pieces")
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        counts[row["length"]] = row["n"]
    table = slots(plan(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = table[:, 0] * (1 << 48) + table[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(x).to_numpy() for x in ("length", "rank"))
            _, first, times, sequence, offset = table[
                np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1
            ].T
            placed = [pa.array(sequence + (rank - first) % times), pa.array(offset)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(x) for x in names], *placed], [*names, "sequence_id", "offset"]
            )

    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    offsets = by_task.select("task", "length", before.alias("before"))
    return (
        pieces.join(offsets, ["task", "length"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
        .mapInArrow(frugal(place), PLACED)
    )
