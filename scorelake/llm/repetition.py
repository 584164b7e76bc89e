"""Quality rules: word and line statistics, and repetition found with a suffix array.

The suffix array of the words of many documents is built at once by prefix
doubling: the symbols of different documents differ, so no suffix of one equals
one of another. The ranks of every doubling step are kept; longest common
prefixes of neighbours follow from them by binary lifting. A pass over these
lengths with a stack enumerates their intervals, which are the substrings that
occur more than once and can't grow to the right. One whose occurrences do not all
follow the same word can't grow to the left either: it is a maximal repeat. The
spans of all maximal repeats are united. A document fails if they cover too much
of it, or if its longest repeat is too long for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textops
from .common import prepare_python

#: Repeats of fewer words are ordinary language.
MIN_WORDS = 8
#: A document fails if a larger share of its words lies in repeats, or if one repeat has LONG words or more and a larger share of them.
MAX_COVERED, MAX_REPEAT, LONG = 0.15, 0.05, 20
#: Base rule: fewest words, window of the repeated-words rule, most words in repeated windows in a hundred.
LEAST_WORDS, WINDOW, MAX_REPEATED = 10, 5, 20
#: Bytes of texts whose suffixes are sorted together.
PACKET = 1 << 18
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_BLANKS = b" \t\n\x0b\x0c\r"


def suffix_array(symbols: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words in the order of the suffixes that begin there, and the common prefix of each with the one before it; 0 at both ends.

    symbols: 64-bit hashes of words; doc: ascending number of the document of each.
    """
    n = len(symbols)
    if n < 2:
        return np.arange(n), np.zeros(n + 1, np.int64)
    keys = textops.mix(symbols ^ textops.mix(doc.astype(np.uint64) + np.uint64(1)))
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts + 1)[inverse]
    last = np.searchsorted(doc, doc, side="right")
    levels = [rank]
    active = np.flatnonzero(counts[inverse] > 1)
    step = 1
    while len(active):
        ahead = active + step
        second = np.where(ahead < last[active], rank[np.minimum(ahead, n - 1)], 0)
        key = rank[active] * np.int64(n + 1) + second
        order = np.argsort(key)
        active, key = active[order], key[order]
        old = rank[active]
        place = np.arange(len(active))
        group = np.maximum.accumulate(np.where(np.diff(old, prepend=-1) != 0, place, 0))
        fresh = np.diff(key, prepend=-1) != 0
        part = np.maximum.accumulate(np.where(fresh, place, 0))
        rank = rank.copy()
        rank[active] = old + part - group
        levels.append(rank)
        alone = fresh & np.append(fresh[1:], True)
        active = active[~alone]
        step *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank - 1] = np.arange(n)
    common = np.zeros(n + 1, np.int64)
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    near = np.flatnonzero(levels[0][left] == levels[0][right])
    left, right, length = left[near], right[near], np.zeros(len(near), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (left < n) & (right < n)
        same = inside & (levels[k][np.minimum(left, n - 1)] == levels[k][np.minimum(right, n - 1)])
        jump = np.int64(1 << k) * same
        left, right, length = left + jump, right + jump, length + jump
    common[near + 1] = length
    return suffixes, common


def longest_repeats(symbols: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest substring that begins there and occurs again in the same document."""
    suffixes, common = suffix_array(symbols, doc)
    best = np.empty(len(symbols), np.int64)
    best[suffixes] = np.maximum(common[:-1], common[1:])
    return best


def maximal_repeats(suffixes: np.ndarray, common: np.ndarray, symbols: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Maximal repeats of `least` words or more: begins and lengths of spans whose union is that of all their occurrences, and (words, first rank) of each.

    The stack holds the open intervals from the outermost in, as [words, first
    rank, word before all occurrences or None where they differ, ranks that lie in
    no interval within]. An occurrence counts for the innermost interval with it:
    if that one can grow to the left, what it covers lies in the span of the grown
    one, and what outer ones cover lies in its own. So each rank gives one span.
    """
    begins, lengths, found = [], [], []
    inside = np.flatnonzero(common >= least)
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), found
    runs = np.split(inside, np.flatnonzero(np.diff(inside) > 1) + 1)
    for run in runs:
        ranks = suffixes[run[0] - 1 : run[-1] + 1]
        opens = (ranks == 0) | (doc[ranks] != doc[ranks - 1])
        before = [("begin",) if o else s for o, s in zip(opens.tolist(), symbols[ranks - 1].tolist(), strict=True)]  # only one suffix begins a document
        stack: list[list] = []
        for k, length in enumerate([*common[run].tolist(), 0]):
            first, word, place = k, before[k], int(ranks[k])
            waiting = True
            while stack and stack[-1][0] > length:
                top = stack.pop()
                if waiting:
                    top[3].append(place)
                    waiting = False
                first, word = top[1], word if top[2] == word else None
                if word is None:
                    found.append((top[0], int(run[0]) - 1 + first))
                    begins += top[3]
                    lengths += [top[0]] * len(top[3])
            if length:
                if stack and stack[-1][0] == length:
                    stack[-1][2] = word if stack[-1][2] == word else None
                else:
                    stack.append([length, first, word, []])
                if waiting:
                    stack[-1][3].append(place)
    return np.array(begins, np.int64), np.array(lengths, np.int64), found


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in the union of spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]


def _duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Statistics of each text, with the spans of united repeats as word numbers."""
    buffer, begin, _, hashes, first = textops.words(texts)
    places = np.append(textops.joined(texts)[1], len(buffer))
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    suffixes, common = suffix_array(hashes, doc)
    best = np.empty(len(hashes), np.int64)
    best[suffixes] = np.maximum(common[:-1], common[1:])
    window = np.flatnonzero(best >= WINDOW)
    repeated = covered(window, window + WINDOW, len(best))
    at, size, _ = maximal_repeats(suffixes, common, hashes, doc, MIN_WORDS)
    inside = covered(at, at + size, len(best))
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, doc[at], size)
    lo, hi = textops.spans(inside & True)
    if len(inside):  # spans that touch at the border of two documents
        cuts = first[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(inside))]
        cuts = np.unique(cuts[inside[cuts] & inside[cuts - 1]])
        lo, hi = np.sort(np.append(lo, cuts)), np.sort(np.append(hi, cuts))
    return {
        "n_words": np.diff(first),
        "word_chars": _sums(~textops.is_white(buffer) & ((buffer & 0xC0) != 0x80), places),
        "n_symbols": _sums(_SYMBOL[buffer], places),
        "n_dup_lines": np.fromiter(map(_duplicate_lines, texts), np.int64, len(texts)),
        "n_repeat_words": _sums(repeated, first),
        "covered_words": _sums(inside, first),
        "longest_repeat": longest,
        "span_lo": lo,
        "span_hi": hi,
        "first": first,
    }


_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


def _base_failed(x: dict[str, np.ndarray]) -> np.ndarray:
    return (x["n_words"] < LEAST_WORDS) | (100 * x["n_repeat_words"] > MAX_REPEATED * x["n_words"])


def _kept(x: dict[str, np.ndarray]) -> np.ndarray:
    long = (x["longest_repeat"] >= LONG) & (x["longest_repeat"] > MAX_REPEAT * x["n_words"])
    return ~_base_failed(x) & (x["covered_words"] <= MAX_COVERED * x["n_words"]) & ~long


def _judge(with_spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = textops.as_bytes(batch.column("text"))
            for low, high in textops.packets(texts, PACKET):
                x = measure([t or b"" for t in texts[low:high]])
                base_failed, kept = _base_failed(x), _kept(x)
                columns = {k: batch.column(k).slice(low, high - low) for k in batch.schema.names if k != "text" or with_spans}
                columns |= {k: pa.array(x[k].astype(np.int64)) for k in _COLUMNS} | {"base_failed": pa.array(base_failed), "kept": pa.array(kept)}
                if with_spans:
                    owner = np.searchsorted(x["first"], x["span_lo"], side="right") - 1
                    ends = np.searchsorted(owner, np.arange(high - low + 1)).astype(np.int32)
                    pairs = [pa.array((x[k] - x["first"][owner]).astype(np.int64)) for k in ("span_lo", "span_hi")]
                    columns["repeats"] = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(pairs, names=["begin", "end"]))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def quality(docs: DataFrame, *, with_spans: bool = False) -> DataFrame:
    """Statistics and verdict of each row of docs (needs text; its other columns are passed on).

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words
    (words in maximal repeats of MIN_WORDS or more), longest_repeat (words of the
    longest of these, 0 without any), base_failed and kept.
    with_spans keeps the text and adds repeats, the united spans as word numbers;
    otherwise the text is dropped. Columns of docs with one of these names are
    replaced. A null text is taken as empty: all counts are 0 and it is rejected.
    Repeated rows get equal verdicts; an empty table gives an empty result. No row
    is exchanged between tasks. Memory: for the words of a packet, or of the longest
    text, an array of ranks for each doubling up to the longest repeat.
    """
    prepare_python(docs.sparkSession)
    new = [*_COLUMNS, "base_failed", "kept"] + ["repeats"] * with_spans
    docs = docs.drop(*new)
    kept = [f for f in docs.schema.fields if with_spans or f.name != "text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{k} long" for k in _COLUMNS] + ["base_failed boolean", "kept boolean"] + ["repeats array<struct<begin: long, end: long>>"] * with_spans)
    return docs.mapInArrow(textops.released(_judge(with_spans)), schema)


def _sound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, keep = textops.as_bytes(batch.column("text")), []
        for low, high in textops.packets(texts, PACKET):
            keep.append(_kept(measure([t or b"" for t in texts[low:high]])))
        if keep:
            yield batch.filter(pa.array(np.concatenate(keep)))


def keep_sound(docs: DataFrame) -> DataFrame:
    """The rows of docs that quality() keeps, with all their columns."""
    prepare_python(docs.sparkSession)
    return docs.mapInArrow(textops.released(_sound), docs.schema)
