"""Vectorised splitting and hashing of texts, on the UTF-8 bytes of many documents at once.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D. These bytes never
occur inside a multi-byte character, so words of bytes are words of code points.
Hashes have 64 bits: two different words of a corpus of 10**7 different words
collide with a probability below 10**-5.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Bytes of a word beyond which a digest is taken.
LONG = 512
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 64)
        steps = np.full(size, _STEP, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def joined(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a line feed after each text, and the place where each text begins."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    return buffer, np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(texts) else np.zeros(0, np.int64)


def is_white(buffer: np.ndarray) -> np.ndarray:
    return (buffer == 32) | ((buffer >= 9) & (buffer <= 13))


def lowered(buffer: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return buffer + (((buffer >= 65) & (buffer <= 90)).view(np.uint8) << 5)


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true values."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    if len(inside):
        edge[0], edge[-1] = inside[0], inside[-1]
    place = np.flatnonzero(edge)
    return place[::2], place[1::2]


def span_hashes(buffer: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; it takes eight bytes at a time, and a digest of a span over LONG bytes."""
    size = end - begin
    out = mix(size.astype(np.uint64) + _STEP)
    spare = np.concatenate((buffer, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(buffer) + 1,), "<u8", spare, 0, (1,))
    todo = np.flatnonzero(size <= LONG)
    place, rest = begin[todo], size[todo]
    while len(todo):
        block = eight[place]
        short = rest < 8
        block[short] &= (np.uint64(1) << (rest[short] * 8).astype(np.uint64)) - np.uint64(1)
        out[todo] = mix(out[todo] * _STEP ^ block)
        more = rest > 8
        todo, place, rest = todo[more], place[more] + 8, rest[more] - 8
    for i in np.flatnonzero(size > LONG):
        out[i] = int.from_bytes(hashlib.blake2b(buffer[begin[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def words(texts: Sequence[bytes], fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buffer, begin, end and hash of all words, and for text i the index of its first word at [i], and one entry more.

    fold: A-Z count as a-z.
    """
    buffer, places = joined(texts)
    if fold:
        buffer = lowered(buffer)
    begin, end = spans(~is_white(buffer))
    return buffer, begin, end, span_hashes(buffer, begin, end), np.append(np.searchsorted(begin, places), len(begin))


def packets(texts: Sequence[bytes | None], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about limit bytes; a longer text comes alone, so memory follows the longest text."""
    low = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > low and size + n > limit:
            yield low, i
            low, size = i, 0
        size += n
    if low < len(texts):
        yield low, len(texts)


def as_bytes(column) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct sorted hashes of all windows of width words; of the whole sequence if it is shorter; none without words."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    size = min(width, n)
    total = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        total += hashes[k : n - size + 1 + k] * powers(size + 1)[k + 1]
    return np.unique(mix(total + np.uint64(size)))


def released(run: Callable) -> Callable:
    """run, a function over Arrow batches, that gives what it has freed back to the system at the end of a task; workers live on between tasks."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return go


def release() -> None:
    """Give freed memory back to the system; where the C library can't, it stays with the worker."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)
