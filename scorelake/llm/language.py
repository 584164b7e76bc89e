"""Language identification with interpolated Kneser-Ney character models.

One model of order ORDER per language is fitted on a bounded sample of labelled
documents. The probabilities of all languages stand side by side: for every
n-gram that any language has seen, a row of log probabilities (with the shorter
contexts already interpolated), in an array sorted by the hash of the n-gram;
for every context, a row of log back-off weights. Scoring a text is a binary
search per character. A document gets the language of the lowest cross-entropy
per character. A confidence is calibrated on labelled documents that the counts
have not seen, and so is the bound beyond which a text fits no learned language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import bounded, checkpointed, prepare_python

ORDER = 4
#: Bounds of the training sample: different texts of each language, by expectation, one in four of them for calibration; and their bytes.
SAMPLE, SAMPLE_BYTES = 4000, 16 << 20
#: Languages from which on each gets fewer bytes, in inverse proportion to the square of their number, as the model has a row of all languages for each n-gram.
MANY = 8
#: Languages with fewer sampled documents than this outside the calibration fold learn those of the calibration fold as well, after the calibration.
FEW = 100
#: A text is rejected if its cross-entropy lies beyond what this share of the calibration documents show.
ACCEPTED = 0.999
_R = np.random.default_rng(77).integers(1, 2**63, ORDER, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_fold: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """For each code point its lower-case letter, or 32 if it is no letter. Of a lower case of several letters the first counts."""
    if not _fold:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                table[c] = ord(x.lower()[0])
        _fold.append(table)
    return _fold[0]


def letters(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters of all texts, the text of each, and which of them are predicted.

    A text is ORDER - 1 spaces, its letters with one space for each run of other
    characters, and a space. All but the first spaces are predicted.
    """
    table = fold_table()
    points = [np.frombuffer(t.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32) for t in texts]
    sizes = np.fromiter((len(p) + ORDER for p in points), np.int64, len(points))
    ends = np.cumsum(sizes)
    codes = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint32)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    pad = np.zeros(len(codes), bool)
    for p, end in zip(points, ends.tolist(), strict=True):
        codes[end - len(p) - 1 : end - 1] = table[p]
    for k in range(ORDER - 1):
        pad[ends - sizes + k] = True
    space = codes == 32
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep |= pad
    return codes[keep], doc[keep], ~pad[keep]


def _hashes(codes: np.ndarray, at: np.ndarray, first: int, last: int) -> np.ndarray:
    """Hash of the characters from `first` to `last` places back."""
    total = np.zeros(len(at), np.uint64)
    for j in range(first, last + 1):
        total += (codes[at - j].astype(np.uint64) + np.uint64(1)) * _R[j]
    return total


@dataclass
class Model:
    languages: list[str]
    #: For n = 1 .. ORDER: sorted hashes of n-grams, and their log probabilities in bits by language.
    grams: list[tuple[np.ndarray, np.ndarray]]
    #: For n = 1 .. ORDER: sorted hashes of contexts of n - 1 characters, and log back-off weights by language.
    contexts: list[tuple[np.ndarray, np.ndarray]]
    #: Log probability of a character that no model has seen.
    unseen: np.ndarray
    temperature: float = 1.0
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    bound: float = 0.0

    def entropies(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text (row) by language (column), and the number of predicted characters; both are 0 without a letter."""
        codes, doc, predicted = letters(texts)
        at = np.flatnonzero(predicted)
        bits = np.zeros((len(at), len(self.languages)), np.float32)
        todo = np.arange(len(at))
        for n in range(ORDER, 0, -1):
            keys, rows = self.grams[n - 1]
            wanted = _hashes(codes, at[todo], 0, n - 1)
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[place] == wanted
            if n == ORDER:
                bits = rows[place]
                bits[~hit] = 0
            else:
                bits[todo[hit]] += rows[place[hit]]
            todo = todo[~hit]
            if len(todo):
                keys, rows = self.contexts[n - 1]
                wanted = _hashes(codes, at[todo], 1, n - 1)
                place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                bits[todo] += np.where((keys[place] == wanted)[:, None], rows[place], 0)
        bits[todo] += self.unseen
        owner = doc[at]
        counts = np.bincount(owner, minlength=len(texts))
        some = counts > 0
        total = np.zeros((len(texts), len(self.languages)))
        if some.any():
            first = np.cumsum(counts) - counts
            total[some] = np.add.reduceat(bits, first[some], axis=0, dtype=np.float64)
        return -total / np.maximum(counts, 1)[:, None], counts

    def judge(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its confidence, its bits per character, and whether the text fits none."""
        bits, n = self.entropies(texts)
        best = bits.argmin(axis=1)
        low = bits[np.arange(len(bits)), best]
        score = 1 / np.exp2((low[:, None] - bits) * np.sqrt(n)[:, None] / self.temperature).sum(axis=1)
        odd = (low - self.mean[best]) * np.sqrt(n) > self.bound * self.spread[best]
        return best, score, low, odd

    def calibrate(self, bits: np.ndarray, n: np.ndarray, label: np.ndarray) -> None:
        """Choose the temperature of the best log likelihood, and the rejection bound, on labelled texts."""
        own = bits[np.arange(len(bits)), label] if len(bits) else np.zeros(0)
        count = len(self.languages)
        self.mean, self.spread, z = np.full(count, np.inf), np.ones(count), [0.0]
        for k in range(count):
            if (x := label == k).sum() >= 2:
                self.mean[k] = np.average(own[x], weights=n[x])
                dev = (own[x] - self.mean[k]) * np.sqrt(n[x])
                self.spread[k] = max(float(dev.std()), 1e-6)
                z += (dev / self.spread[k]).tolist()
        self.bound = float(np.quantile(z, ACCEPTED)) * 1.25 + 1
        if len(bits):
            gaps = (own[:, None] - bits) * np.sqrt(n)[:, None]
            cost = {t: np.log2(np.exp2(np.minimum(gaps / t, 500)).sum(axis=1)).mean() for t in np.geomspace(0.05, 20, 40)}
            self.temperature = float(min(cost, key=cost.get))


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """values of the wanted keys, 0 where there are none."""
    if not len(keys):
        return np.zeros(len(wanted))
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], 0)


def fit(languages: list[str], lang: np.ndarray, chars: np.ndarray, counts: np.ndarray) -> Model:
    """Models from counts of n-grams of ORDER characters: lang is a number, chars has a row of ORDER code points."""

    def key(rows: np.ndarray, back: int) -> np.ndarray:
        total = np.zeros(len(rows), np.uint64)
        for j in range(rows.shape[1]):
            total += (rows[:, rows.shape[1] - 1 - j].astype(np.uint64) + np.uint64(1)) * _R[j + back]
        return total

    alphabet = len(np.unique(chars[:, -1])) + 1
    size, below = len(languages), None
    grams, contexts = [], []
    levels = {}
    rows, who, weight = chars, lang, counts.astype(np.float64)
    for n in range(ORDER, 0, -1):  # n-grams of the highest order are counted; shorter ones by what stands before them
        levels[n] = (rows, who, weight)
        if n > 1:
            both, inverse = np.unique(np.column_stack((who, rows[:, 1:])), axis=0, return_inverse=True)
            weight = np.bincount(inverse.ravel(), minlength=len(both)).astype(np.float64)
            who, rows = both[:, 0], both[:, 1:]
    uniform = np.full(size, 1 / alphabet)
    for n in range(1, ORDER + 1):
        rows, who, weight = levels[n]
        keys, first = np.unique(key(rows, 0), return_index=True)
        union = rows[first]
        shorter = np.tile(uniform, (len(keys), 1)) if n == 1 else below[1][np.searchsorted(below[0], key(union[:, 1:], 0))]
        context_keys = np.unique(key(rows[:, :-1], 1))
        union_context = key(union[:, :-1], 1)
        prob, back = np.empty((len(keys), size)), np.empty((len(context_keys), size))
        for k in range(size):
            mine = who == k
            own, cont, c = key(rows[mine], 0), key(rows[mine][:, :-1], 1), weight[mine]
            once, twice = (c == 1).sum(), (c == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            ctx, where = np.unique(cont, return_inverse=True)
            total, kinds = np.bincount(where, c, len(ctx)), np.bincount(where, minlength=len(ctx)).astype(np.float64)
            order = np.argsort(own)
            seen = _lookup(own[order], np.maximum(c[order] - discount, 0), keys)
            sums, gamma = _lookup(ctx, total, union_context), _lookup(ctx, discount * kinds / np.maximum(total, 1), union_context)
            known = sums > 0
            prob[:, k] = np.where(known, seen / np.maximum(sums, 1) + gamma * shorter[:, k], shorter[:, k])
            g = _lookup(ctx, discount * kinds / np.maximum(total, 1), context_keys)
            back[:, k] = np.where(g > 0, np.log2(np.maximum(g, 1e-300)), 0)
        below = (keys, prob)
        grams.append((keys, np.log2(prob).astype(np.float32)))
        contexts.append((context_keys, back.astype(np.float32)))
    return Model(languages, grams, contexts, np.log2(uniform).astype(np.float32))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, groups = textops.as_bytes(batch.column("text")), list(zip(batch.column("lang").to_pylist(), batch.column("part").to_pylist(), strict=True))
        for low, high in textops.packets(texts):
            for lang, part in set(groups[low:high]):
                codes, _, predicted = letters([texts[i] for i in range(low, high) if groups[i] == (lang, part)])
                at = np.flatnonzero(predicted)
                packed = [(codes[at - j].astype(np.int64) << 21) | codes[at - j + 1] for j in (ORDER - 1, 1)]
                both, counts = np.unique(np.column_stack(packed), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(both), pa.string()), pa.array([part] * len(both), pa.int32()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(counts)], names=["lang", "part", "front", "back", "n"])


def _entropy(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = textops.as_bytes(batch.column("text"))
            for low, high in textops.packets(texts):
                bits, n = model.value.entropies(texts[low:high])
                yield pa.RecordBatch.from_arrays([batch.column("lang").slice(low, high - low), batch.column("part").slice(low, high - low), pa.array(list(bits), pa.list_(pa.float64())), pa.array(n)], names=["lang", "part", "bits", "n"])

    return run


def _predict(model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = fold_table()
        for batch in batches:
            texts = textops.as_bytes(batch.column("text"))
            for low, high in textops.packets(texts):
                part = [t or b"" for t in texts[low:high]]
                n = high - low
                lang, score, low_bits, odd = np.full(n, "und", object), np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
                some = [i for i, t in enumerate(part) if (table[np.frombuffer(t.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)] != 32).any()]
                if model.value is not None and some:
                    best, score[some], low_bits[some], odd[some] = model.value.judge([part[i] for i in some])
                    lang[some] = np.array(model.value.languages, object)[best]
                columns = [batch.column(k).slice(low, n) for k in names]
                new = [pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(low_bits, mask=np.isnan(low_bits)), pa.array(odd)]
                yield pa.RecordBatch.from_arrays([*columns, *new], names=[*names, "lang_pred", "score", "bits_per_char", "rejected"])

    return run


def remainder(doc_id: Column) -> Column:
    """crc32 of an id as text, modulo 4; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def train(docs: DataFrame, *, sample: int = SAMPLE) -> Model | None:
    """A model of all languages of docs (text, lang, and fold: 3 serves for calibration), or None without any labelled letter.

    About `sample` different texts of each language, and SAMPLE_BYTES, are taken by a
    threshold on a hash of the text; with more than MANY languages the bytes shrink
    so that the model stays as large. Copies count once, as learnt if one of them
    is; texts without a letter are not sampled. Only counts of n-grams and
    entropies of the calibration documents come to the driver; both are bounded by
    the sample. A language with FEW texts or more learns none of fold 3. A rarer
    one is calibrated by a model without fold 3 and then learns fold 3 too; if it
    has no other fold, the calibration's model learns one half of fold 3 and is
    held against the other.
    """
    spark = docs.sparkSession
    prepare_python(spark)
    labelled = docs.filter("lang is not null").filter(F.col("text").rlike(r"\p{L}")).select("lang", "text", "fold", F.xxhash64("text").alias("draw"))
    texts = checkpointed(labelled.groupBy("lang", "draw").agg(F.min("fold").alias("fold"), F.max(F.octet_length("text")).alias("bytes")))
    per_lang = checkpointed(texts.groupBy("lang").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes"), F.count_if(F.col("fold") != 3).alias("others")).withColumnRenamed("bytes", "held"))
    languages = per_lang.count()
    most = float(SAMPLE_BYTES) * min(1.0, (MANY / max(1, languages)) ** 2)
    share = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("rows"), F.lit(most) / F.col("held"))
    few = F.col("others") * share < FEW
    # 0 is learnt, 1 and 2 are learnt after the calibration, 3 is never learnt
    part = F.when(F.col("fold") != 3, 0).when(F.col("fold") == 3, F.when(few, 1 + F.pmod(F.shiftright("draw", 30), F.lit(2))).otherwise(3)).cast("int")
    drawn = texts.join(bounded(per_lang, languages, 72), "lang").filter(F.pmod("draw", F.lit(1 << 30)) < (1 << 30) * share).select("lang", "draw", part.alias("part"))
    drawn = checkpointed(drawn)
    chosen = labelled.join(bounded(drawn, drawn.count(), 48), ["lang", "draw"]).groupBy("lang", "draw", "part").agg(F.first("text").alias("text")).select("text", "lang", "part")
    chosen = checkpointed(chosen)
    counts = chosen.filter("part < 3").mapInArrow(textops.released(_count), "lang string, part int, front long, back long, n long").groupBy("lang", "part", "front", "back").agg(F.sum("n").alias("n")).toArrow()
    if not counts.num_rows:
        return None
    names, lang = np.unique(np.array(counts.column("lang").to_pylist(), object).astype(str), return_inverse=True)
    parts, n = counts.column("part").to_numpy(), counts.column("n").to_numpy()
    front, back = counts.column("front").to_numpy(), counts.column("back").to_numpy()
    mask = (1 << 21) - 1
    chars = np.column_stack((front >> 21, front & mask, back >> 21, back & mask))
    learnt = np.full(len(names), 3)
    np.minimum.at(learnt, lang, parts)
    early = parts == learnt[lang]
    model = fit(names.tolist(), lang[early], chars[early], n[early])
    check = chosen.filter("part > 0").mapInArrow(textops.released(_entropy(spark.sparkContext.broadcast(model))), "lang string, part int, bits array<double>, n long")
    rows = check.filter(F.col("lang").isin(names.tolist()) & (F.col("n") > 0)).toArrow()  # Python and Java may differ on new letters
    label = np.searchsorted(names, np.array(rows.column("lang").to_pylist(), str))
    unseen = rows.column("part").to_numpy() > learnt[label]
    bits = np.array(rows.column("bits").to_pylist(), float).reshape(-1, len(names))
    model.calibrate(bits[unseen], rows.column("n").to_numpy()[unseen], label[unseen])
    if not early.all():
        both, inverse = np.unique(np.column_stack((lang, chars)), axis=0, return_inverse=True)
        full = fit(names.tolist(), both[:, 0], both[:, 1:], np.bincount(inverse.ravel(), n))
        full.temperature, full.mean, full.spread, full.bound = model.temperature, model.mean, model.spread, model.bound
        model = full
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs (text and other columns) without the text, with lang_pred, score, bits_per_char and rejected.

    A null text or a text without a letter, or any text without a model, is `und`
    with score 0, null bits and rejected true. Columns of docs with one of the new
    names are replaced. Rows stay where they are; memory follows the longest text.
    """
    prepare_python(docs.sparkSession)
    docs = docs.drop("lang_pred", "score", "bits_per_char", "rejected")
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string, score double, bits_per_char double, rejected boolean"])
    return docs.mapInArrow(textops.released(_predict(docs.sparkSession.sparkContext.broadcast(model), [f.name for f in kept])), schema)
