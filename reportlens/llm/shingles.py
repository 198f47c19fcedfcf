"""Word shingles of whole texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
CHUNK = 1 << 21
BASE = 0x9E3779B97F4A7C15
#: Odd factors that make a shingle's hash depend on the order of its words.
FACTORS = np.random.default_rng(11).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_values() -> np.ndarray:
    """A random number per byte, the same for A-Z and a-z."""
    values = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64)
    values[65:91] = values[97:123]
    return values


def space_bytes() -> np.ndarray:
    """True for the six ASCII white spaces."""
    table = np.zeros(256, dtype=bool)
    table[[32, 9, 10, 11, 12, 13]] = True
    return table


VALUES, IS_SPACE = byte_values(), space_bytes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, as far as needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = pow(BASE, -1, 1 << 64)
            for name, base in (("up", BASE), ("down", inverse)):
                factors = np.full(n, base, dtype=np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hashes of all words, A-Z lower-cased, their begins and ends, and the first word of each text (one
    bound more).

    ``data`` holds the bytes of texts that begin and end at ``bounds``. A word's hash is a
    difference of prefix sums of its bytes' values times powers, brought to a common origin.
    """
    up, down = POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(VALUES[data] * up[: len(data)], out=sums[1:], dtype=np.uint64)
    word = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | edge[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    at, to = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    hashes = mixed((sums[to] - sums[at]) * down[at] + (to - at).astype(np.uint64))
    return hashes, at, to, np.searchsorted(at, bounds)


def segments(data: np.ndarray, limit: int = CHUNK) -> Iterator[np.ndarray]:
    """One text's bytes in pieces of about ``limit``, cut at white space; only a longer word makes a
    longer piece."""
    at = 0
    while at < len(data):
        to = min(at + limit, len(data))
        while to < len(data):
            spaces = np.flatnonzero(IS_SPACE[data[to : to + limit]])
            if len(spaces):
                to += int(spaces[0])
                break
            to = min(to + limit, len(data))
        yield data[at:to]
        at = to


def long_set(data: np.ndarray) -> np.ndarray:
    """The shingle set of one text, whose words are hashed segment by segment."""
    words = [word_hashes(piece, np.array([0, len(piece)]))[0] for piece in segments(data)]
    words = np.concatenate([np.zeros(0, np.uint64), *words])
    return sets_of(words, np.array([0, len(words)]))[0]


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than a shingle make one; none, none."""
    words, _, _, first = word_hashes(data, bounds)
    return sets_of(words, first)


def sets_of(words: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Shingle sets from the hashes of all words and each text's first word."""
    n = max(len(words) - WIDTH + 1, 0)
    joined = np.zeros(n, dtype=np.uint64)
    for k in range(WIDTH):
        joined += words[k : k + n] * FACTORS[k]
    joined = mixed(joined)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= WIDTH:
            x = np.sort(joined[a : b - WIDTH + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif b > a:
            short = (words[a:b] * FACTORS[WIDTH : WIDTH + b - a]).sum(dtype=np.uint64)
            out.append(mixed(np.array([short + np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def text_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds) of runs of whole texts of about ``limit`` bytes; null is empty. A
    longer text comes alone."""
    column = column.cast(pa.large_binary())
    sizes = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + limit, side="right")) - 1)
        yield at, data[sizes[at] : sizes[to]], sizes[at : to + 1] - sizes[at]
        at = to


def batch_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingle set) of every text of a column."""
    for at, data, bounds in text_chunks(column):
        sets = [long_set(data)] if len(bounds) == 2 else shingle_sets(data, bounds)
        for k, hashes in enumerate(sets):
            yield at + k, hashes
