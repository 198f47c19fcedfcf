"""Interning of word n-grams in an open-addressed NumPy table.

The n-grams of a batch are byte ranges of one buffer. Their keys are xxhash64 values, computed
for all ranges of a length at once. A slot of the table belongs to the n-gram that claimed it;
an occurrence that finds its key there compares the bytes as well and goes on to the next slot
where they differ, so unequal n-grams never share a slot.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import xxhash

#: Bytes of text interned at once; a longer text is cut between words.
PIECE = 1 << 19
#: Longer n-grams are hashed one by one.
VECTOR = 31
PAD = bytes(8)

# The primes of xxhash64.
P1, P2, P3, P4, P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
# End of fixed values.


def turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def views(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, and the 4- and 8-byte words that begin at every byte; ``data`` ends with ``PAD``."""
    n = len(data) - len(PAD)
    octets = np.frombuffer(data, dtype=np.uint8)
    fours = np.ndarray((n + 1,), dtype="<u4", buffer=data, strides=(1,))
    eights = np.ndarray((n + 1,), dtype="<u8", buffer=data, strides=(1,))
    return octets, fours, eights


def same_length_keys(at: np.ndarray, length: int, octets: np.ndarray, fours: np.ndarray, eights: np.ndarray) -> np.ndarray:
    """xxhash64 of the ranges of ``length`` (at most ``VECTOR``) bytes that begin at ``at``."""
    h = np.full(len(at), P5 + np.uint64(length), dtype=np.uint64)
    done = 0
    while length - done >= 8:
        h ^= turned(eights[at + done] * P2, 31) * P1
        h = turned(h, 27) * P1 + P4
        done += 8
    if length - done >= 4:
        h ^= fours[at + done].astype(np.uint64) * P1
        h = turned(h, 23) * P2 + P3
        done += 4
    while done < length:
        h ^= octets[at + done].astype(np.uint64) * P5
        h = turned(h, 11) * P1
        done += 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def keys_of(data: bytes, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of each byte range."""
    out = np.empty(len(at), dtype=np.uint64)
    seen = views(data)
    length = np.minimum(to - at, VECTOR + 1).astype(np.uint8)
    order = np.argsort(length, kind="stable")
    bounds = np.searchsorted(length[order], np.arange(VECTOR + 3))
    with np.errstate(over="ignore"):
        for n in range(1, VECTOR + 1):
            which = order[bounds[n] : bounds[n + 1]]
            if len(which):
                out[which] = same_length_keys(at[which], n, *seen)
    for k in order[bounds[VECTOR + 1] :].tolist():
        out[k] = xxhash.xxh64_intdigest(data[at[k] : to[k]])
    return out


def same_bytes(eights: np.ndarray, one: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ranges of equal ``length`` at ``one`` and ``other`` hold the same bytes."""
    equal = np.ones(len(one), dtype=bool)
    left, done = np.flatnonzero(one != other), 0
    while len(left):
        rest = np.minimum(length[left] - done, 8)
        mask = np.uint64(2**64 - 1) >> (np.uint64(64) - rest.astype(np.uint64) * np.uint64(8))
        ok = ((eights[one[left] + done] ^ eights[other[left] + done]) & mask) == 0
        equal[left[~ok]] = False
        done += 8
        left = left[ok & (length[left] > done)]
    return equal


def interned(data: bytes, at: np.ndarray, to: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every occurrence its n-gram's number, and for every n-gram its first occurrence.

    Linear probing over a table at most half full. In each turn, free slots go to the first
    occurrence that asks for them.
    """
    size = 1 << max(4, (2 * len(at) - 1).bit_length())
    owner = np.full(size, -1, dtype=np.int64)
    length, eights = to - at, views(data)[2]
    slot = (keys & np.uint64(size - 1)).astype(np.int64)
    slots = np.empty(len(at), dtype=np.int64)
    left = np.arange(len(at))
    while len(left):
        asked = slot[left]
        free = np.flatnonzero(owner[asked] < 0)[::-1]
        owner[asked[free]] = left[free]
        holder = owner[asked]
        same = (keys[holder] == keys[left]) & (length[holder] == length[left])
        alike = np.flatnonzero(same)
        same[alike] = same_bytes(eights, at[holder[alike]], at[left[alike]], length[left[alike]])
        slots[left[same]] = asked[same]
        left = left[~same]
        slot[left] = (slot[left] + 1) & (size - 1)
    used = np.flatnonzero(owner >= 0)
    number = np.empty(size, dtype=np.int64)
    number[used] = np.arange(len(used))
    return number[slots], owner[used]


@dataclass
class Grams:
    """The n-grams of one piece: ``row`` and number of every occurrence; bucket and count per n-gram."""

    row: np.ndarray
    slot: np.ndarray
    bucket: np.ndarray
    count: np.ndarray
    words: np.ndarray  # words of each row in this piece
    first: int  # the first row of the piece


def word_table() -> bytes:
    """A-Z become a-z; of the other ASCII characters only digits and a-z are part of words."""
    table = bytearray(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
    table[65:91] = table[97:123]
    return bytes(table)


WORDS = word_table()


def runs_of_words(texts: Iterable[str | None]) -> Iterator[tuple[int, list[list[bytes]], bool]]:
    """(first row, words of consecutive rows, whether the first word was already seen).

    Rows are put together up to ``PIECE`` bytes. A longer text comes in several pieces, each
    of which begins with the last word of the one before.
    """
    first, rows, size = 0, [], 0
    for k, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass").translate(WORDS)
        if rows and size + len(data) > PIECE:
            yield first, rows, False
            first, rows, size = k, [], 0
        if len(data) <= PIECE:
            rows.append(data.split())
            size += len(data)
            continue
        begin, last = 0, []
        while begin < len(data):
            end = data.find(b" ", begin + PIECE)
            end = len(data) if end < 0 else end
            words = last + data[begin:end].split()
            if words:
                yield k, [words], bool(last)
                last = words[-1:]
            begin = end
        first = k + 1
    if rows:
        yield first, rows, False


def grams(texts: Iterable[str | None], longest: int, buckets: int) -> Iterator[Grams]:
    """All runs of 1 to ``longest`` (1 or 2) words of each text, interned piece by piece."""
    for first, rows, seen in runs_of_words(texts):
        words = [w for row in rows for w in row]
        counts = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        data = b" ".join(words) + PAD
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        to = np.cumsum(size + 1) - 1
        at, row = to - size, np.repeat(np.arange(len(rows)), counts)
        begins, ends, of = [at[int(seen) :]], [to[int(seen) :]], [row[int(seen) :]]
        if longest == 2:
            pair = np.flatnonzero(row[1:] == row[:-1])
            begins, ends, of = [*begins, at[pair]], [*ends, to[pair + 1]], [*of, row[pair]]
        at, to, row = map(np.concatenate, (begins, ends, of))
        slot, owner = interned(data, at, to, keys_of(data, at, to))
        held = zip(at[owner].tolist(), to[owner].tolist())
        bucket = np.fromiter((zlib.crc32(data[a:b]) % buckets for a, b in held), dtype=np.int64, count=len(owner))
        counts[0:1] -= int(seen)
        yield Grams(row, slot, bucket, np.bincount(slot, minlength=len(owner)), counts, first)
