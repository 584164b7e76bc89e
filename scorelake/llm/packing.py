"""Packing of tokenized documents into sequences of a fixed length.

Each document is cut into full sequences and one rest. First-fit decreasing
places the rests: a tournament tree over the bins holds the largest free
capacity of each subtree and leads to the leftmost bin that has room. It runs in
randomised groups of documents that know nothing of each other.

Tokens come from the tokenizer library. Where the rules of a tokenizer act on
each word alone, every different word is tokenized once per worker and looked up
afterwards; with other rules whole texts are tokenized.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import prepare_python

#: Documents of a group, on average.
GROUP = 4096
#: Words that a worker remembers; beyond, it starts anew with the next packet of texts.
REMEMBERED = 500_000
#: Places of an empty table of words, as a power of two; it grows so that half of them stay free.
PLACES = 16
#: Rules of a tokenizer that fold letter case and take each run of letters, digit, or run of signs by itself.
WORD_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
_workers: dict[str, Words] = {}


class Words:
    """Token ids of words; the ids of word k are flat[start[k]:start[k + 1]]."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        self.by_word = all(rules[k] == v for k, v in WORD_RULES.items())
        self.specials = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        self.letters = {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}
        self.model = self.tokenizer.model
        self.plain = self.by_word and self._one_piece()
        self.forget()

    def forget(self) -> None:
        self.count = 0
        self._empty(PLACES)
        self.flat, self.start = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64)

    def _empty(self, places: int) -> None:
        self.places, self.keys, self.numbers = places, np.zeros(1 << places, np.uint64), np.zeros(1 << places, np.int32)

    def _one_piece(self) -> bool:
        """Whether the shortcut for words of letters gives what the whole tokenizer gives on a few samples."""
        samples = ["the", "straße", "niño", "leçon", "x" * 30, "...", "!?", "über", "ŒUVRE", "ĳsvrĳ"]
        return all(self._short(x) == self.tokenizer.encode(x, add_special_tokens=False).ids for x in samples)

    def _short(self, word: str) -> list[int]:
        """Ids of a word without inner borders."""
        if word.isascii():
            return [t.id for t in self.model.tokenize(word.lower())]
        return [t.id for t in self.model.tokenize(word.lower().encode().decode("latin-1").translate(self.letters))]

    def ids(self, text: bytes) -> list[int]:
        if self.plain:
            if text.isascii():
                if text.isalpha() or not text.strip(b".,;:!?"):
                    return self._short(text.decode())
            else:
                word = text.decode("utf-8", "replace")
                if word.isalpha() and max(word) <= "ſ" and "İ" not in word:
                    return self._short(word)
        return self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids

    def add(self, keys: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Numbers of new words, by their hashes."""
        found = [self.ids(t) for t in texts]
        size = np.fromiter(map(len, found), np.int64, len(found))
        k, at = self.count, int(self.start[self.count])
        while at + int(size.sum()) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while k + len(keys) >= len(self.start):
            self.start = np.concatenate((self.start, np.zeros_like(self.start)))
        self.flat[at : at + int(size.sum())] = np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))
        self.start[k + 1 : k + 1 + len(keys)] = at + np.cumsum(size)
        numbers = np.arange(k, k + len(keys))
        self.count += len(keys)
        if 2 * self.count > len(self.keys):
            there = self.keys != 0
            old, old_numbers = self.keys[there], self.numbers[there]
            self._empty((4 * self.count).bit_length())
            self._insert(old, old_numbers)
        self._insert(keys, numbers)
        return numbers

    def _insert(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Put different keys into the next free places behind their own; there are more free places than keys."""
        todo, place = np.arange(len(keys)), (keys >> np.uint64(64 - self.places)).astype(np.int64)
        while len(todo):
            free, one = np.unique(place, return_index=True)
            one = one[self.keys[free] == 0]
            self.keys[place[one]], self.numbers[place[one]] = keys[todo[one]], numbers[todo[one]]
            todo, place = np.delete(todo, one), np.delete(place, one)
            place = (place + (self.keys[place] != 0)) % len(self.keys)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word in the table, -1 if it isn't there."""
        out = np.full(len(hashes), -1, np.int64)
        todo, place, wanted = np.arange(len(hashes)), (hashes >> np.uint64(64 - self.places)).astype(np.int64), hashes
        while len(todo):
            there = self.keys[place]
            hit = there == wanted
            out[todo[hit]] = self.numbers[place[hit]]
            on = ~hit & (there != 0)
            todo, place, wanted = todo[on], (place[on] + 1) % len(self.keys), wanted[on]
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and where those of each text begin and the last ends."""
        if not self.by_word:
            parts = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *parts]), np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))
        odd = [i for i, t in enumerate(texts) if any(s in t.lower() for s in self.specials)] if any(s[:2] in t for t in texts for s in self.specials) else []
        whole = {i: np.array(self.tokenizer.encode(texts[i].decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32) for i in odd}
        buffer, places = textops.joined([b"" if i in whole else t for i, t in enumerate(texts)])
        buffer = textops.lowered(buffer)
        inside = ~textops.is_white(buffer)
        cut = _cuts(buffer)
        before = np.concatenate(([False], inside[:-1]))
        begin, end = np.flatnonzero(inside & (~before | cut)), np.flatnonzero(before & (~inside | cut))
        first = np.append(np.searchsorted(begin, places), len(begin))
        hashes = np.maximum(textops.span_hashes(buffer, begin, end), np.uint64(1))
        if self.count + len(hashes) > REMEMBERED:
            self.forget()
        known = self.find(hashes)
        unknown = np.flatnonzero(known < 0)
        if len(unknown):
            keys, sample, inverse = np.unique(hashes[unknown], return_index=True, return_inverse=True)
            sample = unknown[sample]
            raw = buffer.tobytes()
            known[unknown] = self.add(keys, [raw[a:b] for a, b in zip(begin[sample].tolist(), end[sample].tolist(), strict=True)])[inverse]
        start = self.start[known]
        size = self.start[known + 1] - start
        last = np.cumsum(size)
        total = int(last[-1]) if len(last) else 0
        ids = self.flat[np.repeat(start - (last - size), size) + np.arange(total)]
        at = np.concatenate(([0], last))[first]
        if whole:
            parts = [whole.get(i, ids[at[i] : at[i + 1]]) for i in range(len(texts))]
            ids, at = np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return ids, at


def _cuts(low: np.ndarray) -> np.ndarray:
    """Places of a stop that follows a letter a-z or a letter of two bytes below U+0100: a word's letters end there."""
    stop = (low == 46) | (low == 44) | (low == 33) | (low == 63) | (low == 58) | (low == 59)
    letter = (low >= 97) & (low <= 122)
    wide = (low >= 0x80) & (low != 0x97) & (low != 0xB7)
    out = np.zeros(len(low), bool)
    out[1:] = stop[1:] & letter[:-1]
    out[2:] |= stop[2:] & wide[1:-1] & (low[:-2] == 0xC3)
    return out


def worker(path: str) -> Words:
    """The words that this Python worker knows."""
    if path not in _workers:
        _workers[path] = Words(path)
    return _workers[path]


def _pieces(path: str, length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tail = worker(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = textops.as_bytes(batch.column("text"))
            for low, high in textops.packets(texts, 2 << 20):
                ids, at = words.encode([t or b"" for t in texts[low:high]])
                raw, rows = memoryview(ids.astype("<u4", copy=False)).cast("B"), []
                for i in range(high - low):
                    n = int(at[i + 1] - at[i]) + 1
                    for start in range(0, n, length):
                        stop = min(start + length, n)
                        crc = zlib.crc32(raw[4 * (int(at[i]) + start) : 4 * (int(at[i]) + min(stop, n - 1))])
                        rows.append((low + i, start, stop - start, zlib.crc32(tail, crc) if stop == n else crc, n))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(columns[0])), batch.column("row").take(pa.array(columns[0])), *(pa.array(c, pa.int64()) for c in columns[1:])],
                    names=["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"],
                )

    return run


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, larger items first and equal ones by their order; the bins are numbered without gaps."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    free = [capacity] * (2 * leaves)
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for i in order:
        size, node = sizes[i], 1
        while node < leaves:
            node *= 2
            if free[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - free[node]
        free[node] -= size
        node //= 2
        while node:
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
            node //= 2
    return bins, offsets


def _pack(length: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("row", "ascending"), ("start", "ascending")])
        sizes = group.column("length").to_numpy()
        rest = np.flatnonzero(sizes < length)
        bins, offsets = first_fit_decreasing(sizes[rest].tolist(), length)
        sequence, offset = np.empty(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        sequence[rest], offset[rest] = bins, offsets
        full = np.flatnonzero(sizes >= length)
        sequence[full] = np.arange(len(full)) + (max(bins) + 1 if bins else 0)
        sequence += group.column("pack")[0].as_py() << 32
        return group.drop_columns(["row", "pack"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def pack(docs: DataFrame, *, tokenizer: str | None = None, length: int = 4096, end_id: int = 2, group: int = GROUP) -> DataFrame:
    """Place all documents of docs (doc_id, text) into sequences of at most length tokens.

    tokenizer: path of a tokenizer file on every machine, with any rules; without
    one, the public word_bpe_49k.json. Returns a row per piece: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset. A null or empty text is one piece with the
    end id alone; repeated rows are packed as often as they occur; null ids are
    allowed; an empty table gives an empty result; other columns are ignored. A
    task holds one group of about `group` documents as a few numbers per piece, or a
    packet of texts with the different words seen so far.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    prepare_python(docs.sparkSession)
    groups = max(1, -(-docs.count() // group))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    pieces = rows.mapInArrow(textops.released(_pieces(tokenizer, length, end_id)), f"doc_id {id_type}, row long, start long, length long, ids_crc32 long, doc_tokens long")
    dealt = pieces.withColumn("pack", F.pmod(F.xxhash64("doc_id", "doc_tokens", "row"), F.lit(groups)))
    return dealt.groupBy("pack").applyInArrow(_pack(length), f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
