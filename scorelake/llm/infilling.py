"""Fill-in-the-middle: a document is cut in two places drawn from its id, and its middle is moved behind its rest.

The bytes of the texts of a packet lie in one buffer under a grid of chunks. Each
chunk also sees the byte before it, so whether a unit begins at a place is told by
two adjacent bytes, and the chunks are counted at once and without regard to each
other. Running sums over the counts lead both cuts of each text to the chunks that
own them; only these are read a second time, to find the place.

A text isn't dealt over several tasks: its output is a string of its own length,
which one task must hold and hash in any case, and moving the chunks would be a
shuffle of all texts that saves none of it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import prepare_python

#: Bytes of a chunk, and of the chunks that are counted at once.
CHUNK, TOGETHER = 1 << 12, 1 << 20
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Documents in a hundred that are transformed, and of those the ones with the suffix in front.
RATE, SUFFIX_FIRST = 90, 20

#: Whether a unit begins at a byte, told from the byte before it and the byte itself.
UNITS: dict[str, Callable[[np.ndarray, np.ndarray], np.ndarray]] = {
    "character": lambda before, here: (here & 0xC0) != 0x80,
    "word": lambda before, here: textops.is_white(before) & ~textops.is_white(here),
    "line": lambda before, here: before == 10,
}


class Grid:
    """Chunks over texts that lie end to end, with the number of inner unit borders before each chunk."""

    def __init__(self, texts: list[bytes], unit: str):
        self.begins = UNITS[unit]
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.place = np.concatenate(([0], np.cumsum(self.size)))
        self.buffer = np.frombuffer(b"\0" + b"".join(texts), np.uint8)  # a byte in front, so that every chunk has one before it
        chunks = -(-self.size // CHUNK)
        self.first = np.concatenate(([0], np.cumsum(chunks)))
        nth = np.arange(self.first[-1]) - np.repeat(self.first[:-1], chunks)
        self.start = np.repeat(self.place[:-1], chunks) + nth * CHUNK
        self.end = np.minimum(self.start + CHUNK, np.repeat(self.place[1:], chunks))
        self.opens = nth == 0
        counts = np.empty(len(self.start), np.int64)
        low = 0
        while low < len(self.start):
            high = max(low + 1, int(np.searchsorted(self.end, self.start[low] + TOGETHER, side="right")))
            counts[low:high] = self._count(low, high)
            low = high
        self.before = np.concatenate(([0], np.cumsum(counts)))
        self.borders = self.before[self.first[1:]] - self.before[self.first[:-1]]

    def _inner(self, low: int, high: int) -> np.ndarray:
        """Whether a unit begins at each byte of chunks low to high, but for the first bytes of texts."""
        a, b = int(self.start[low]), int(self.end[high - 1])
        found = self.begins(self.buffer[a:b], self.buffer[a + 1 : b + 1])
        found[self.start[low:high][self.opens[low:high]] - a] = False
        return found

    def _count(self, low: int, high: int) -> np.ndarray:
        return np.add.reduceat(self._inner(low, high).astype(np.int64), self.start[low:high] - self.start[low])

    def units(self) -> np.ndarray:
        return np.where(self.size > 0, self.borders + 1, 0)

    def cuts(self, rank: np.ndarray) -> np.ndarray:
        """Bytes of each text before its unit number rank; all of them where it has no such unit."""
        out = np.where(rank > self.borders, self.size, 0)
        inner = np.flatnonzero((rank > 0) & (rank <= self.borders))
        wanted = self.before[self.first[inner]] + rank[inner] - 1
        owner = np.searchsorted(self.before, wanted, side="right") - 1
        for i, k, nth in zip(inner.tolist(), owner.tolist(), (wanted - self.before[owner]).tolist(), strict=True):
            out[i] = self.start[k] - self.place[i] + np.flatnonzero(self._inner(k, k + 1))[nth]
        return out


def _draws(keys: list[str], seed: int) -> np.ndarray:
    """Four numbers of 32 bits for each key."""
    digests = b"".join(hashlib.sha256(f"{seed}:{k}".encode()).digest()[:16] for k in keys)
    return np.frombuffer(digests, ">u4").astype(np.int64).reshape(-1, 4)


def _transform(unit: str, seed: int, rate: int, suffix_first: int, marks: tuple[str, str, str]):
    p, s, m = (x.encode() for x in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = textops.as_bytes(batch.column("text")), batch.column("_key").to_pylist()
            others = [k for k in batch.schema.names if k not in ("text", "_key")]
            for low, high in textops.packets(texts):
                part = [t or b"" for t in texts[low:high]]
                grid, h = Grid(part, unit), _draws(keys[low:high], seed)
                n = grid.units()
                ranks = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
                plain = np.array([not t or p in t or s in t or m in t for t in part]) | (h[:, 2] % 100 >= rate)
                front = h[:, 3] % 100 < suffix_first
                a, b = (grid.cuts(np.where(plain, 0, ranks[:, k])).tolist() for k in (0, 1))
                output = [
                    t if is_plain else b"".join((s, t[y:], p, t[:x], m, t[x:y]) if swap else (p, t[:x], s, t[y:], m, t[x:y]))
                    for t, is_plain, swap, x, y in zip(part, plain, front, a, b, strict=True)
                ]
                columns = {k: batch.column(k).slice(low, high - low) for k in others}
                columns |= {
                    "n": pa.array(n),
                    "form": pa.array(np.where(plain, "plain", np.where(front, "spm", "psm")), pa.string()),
                    "prefix_units": pa.array(ranks[:, 0], mask=plain),
                    "middle_units": pa.array(ranks[:, 1] - ranks[:, 0], mask=plain),
                    "output": pa.array(output, pa.binary()).view(pa.string()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def fill_in_middle(docs: DataFrame, *, key: str = "doc_id", unit: str = "character", seed: int = 1, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """Rearrange the text of each row of docs (needs text and the column key; all columns but the text are passed on).

    Adds n (units of the text), form (plain, psm: prefix, suffix, middle, or spm:
    suffix, prefix, middle), prefix_units, middle_units (null if plain) and output.
    unit: character (a code point), word (from its first character up to the next
    word's) or line. The cuts depend on key and seed alone, so equal keys with equal
    texts are cut alike. A text stays plain if it is null or empty (output: the
    empty text), or if it holds one of the marks, for which restored() could take
    them. A null key counts as the empty string. Columns of docs with a name of the
    new ones are replaced, unless they are the key. No row is exchanged between
    tasks. Memory: the bytes of a packet, or of the longest text, three times.
    """
    prepare_python(docs.sparkSession)
    new = [x for x in ("n", "form", "prefix_units", "middle_units", "output") if x != key]
    rows = docs.withColumn("_key", F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))).drop(*new)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in ("text", "_key"))
    schema = f"{kept}{', ' if kept else ''}n long, form string, prefix_units long, middle_units long, output string"
    return rows.mapInArrow(textops.released(_transform(unit, seed, rate, suffix_first, marks)), schema)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that fill_in_middle has rearranged: the three parts between the marks in their first order."""
    parts = F.split(output, "|".join(re.escape(x) for x in marks), -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))
