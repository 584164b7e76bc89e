"""Near duplicates, quality rules, packing and language."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorelake.llm import language, near_duplicates, packing, repetition, textops

from .conftest import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def shingle_set(text):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    return sets, group


@pytest.mark.parametrize("percent", [85, 80])
def test_components_equal_brute_force(docs, percent):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets, group = brute_components(rows, percent)
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    want = collections.Counter((rows[i][0], len(sets[i]), least[group[i]], rows[i][0] == least[group[i]]) for i in range(len(rows)))
    got = near_duplicates.near_duplicates(docs, percent=percent).drop("tkey", "first").collect()
    assert collections.Counter(map(tuple, got)) == want


def test_one_document_of_each_group_stays(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets, group = brute_components(rows, 85)
    left = near_duplicates.deduplicate(docs)
    assert left.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in left.collect()]
    assert len([t for _, t in kept if shingle_set(t)]) == len({group[i] for i in range(len(rows)) if sets[i]})
    assert sum(not shingle_set(t) for _, t in kept) == sum(not s for s in sets)


def test_near_duplicates_of_nothing(empty):
    assert near_duplicates.near_duplicates(empty).count() == 0 and near_duplicates.deduplicate(empty).count() == 0


def test_large_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "JOINED", 3)
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    rows = [(i, t) for i, t in enumerate(corpus(9)[30:60])]
    _, group = brute_components(rows, 85)
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: min(j for j in range(len(rows)) if group[j] == group[i]) for i in range(len(rows))}


def test_chains_are_joined(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 51), (51, 50), (60, 60)], "a long, b long")
    got = {r.node: r.component for r in near_duplicates.connected_components(edges).collect()}
    assert {k: v for k, v in got.items() if k <= 40} == {i: 1 for i in range(1, 41)} and got[51] == 50 == got[50]


def brute_quality(text):
    text = text or ""
    w = WORD.findall(text)
    n, marks, longest = len(w), {}, 0
    for size in (5, 8):
        seen, hit = collections.Counter(tuple(w[i : i + size]) for i in range(n - size + 1)), set()
        for i in range(n - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                hit |= set(range(i, i + size))
        marks[size] = len(hit)
    low, high = 0, n
    while low < high:
        mid = (low + high + 1) // 2
        if len({tuple(w[i : i + mid]) for i in range(n - mid + 1)}) < n - mid + 1:
            low = mid
        else:
            high = mid - 1
    lines = [x for x in text.split("\n") if WORD.search(x)]
    longest = low if low >= 8 else 0
    long = longest >= 20 and 20 * longest > n
    failed = n < 10 or 100 * marks[5] > 20 * n
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), marks[5], marks[8], longest, failed, not failed and 100 * marks[8] <= 15 * n and not long)


def test_quality_equals_brute_force(docs):
    got = repetition.quality(docs, with_spans=True)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat", "base_failed", "kept")
    rows = got.collect()
    assert len(rows) == docs.count() and set(docs.columns) <= set(got.columns)
    for r in rows:
        assert tuple(r[n] for n in names) == brute_quality(r.text)
        assert sum(s.end - s.begin for s in r.repeats) == r.covered_words
    kept = repetition.keep_sound(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)


def test_the_method_rejects_what_the_base_rule_keeps(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    line, part = fresh(9), fresh(22)
    texts = [
        " ".join(fresh(45) + line + fresh(40) + line),  # 18 of 103 words in repeats of nine
        " ".join(fresh(180) + part + fresh(180) + part),  # one repeat of 22 words in 404
        " ".join(fresh(300) + part + fresh(300) + part),  # the same, too small a part of 644
        " ".join(fresh(70) + line + fresh(70) + line),
        " ".join(fresh(30) + line[:7] + fresh(42) + line[:7]),  # too short for a repeat
        " ".join(fresh(100)),
    ]
    got = repetition.quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert not any(r.base_failed for r in got) and [r.kept for r in got] == [False, False, True, True, True, True]
    assert [brute_quality(t)[-1] for t in texts] == [r.kept for r in got]


def plain_maximal_repeats(words, least):
    """Occurrences of each repeated substring that can grow neither to the left nor to the right."""
    places = collections.defaultdict(list)
    for i in range(len(words)):
        for j in range(i + least, len(words) + 1):
            places[tuple(words[i:j])].append(i)
    grows = lambda at, step: len({words[i + step] if 0 <= i + step < len(words) else ("end", i) for i in at}) == 1
    return {w: at for w, at in places.items() if len(at) > 1 and not grows(at, -1) and not grows(at, len(w))}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=24), min_size=1, max_size=4), st.integers(1, 4))
def test_maximal_repeats(docs_of_numbers, least):
    symbols = np.array([x for d in docs_of_numbers for x in d], np.uint64)
    doc = np.array([i for i, d in enumerate(docs_of_numbers) for _ in d], np.int64)
    suffixes, common = repetition.suffix_array(symbols, doc)
    at, size, found = repetition.maximal_repeats(suffixes, common, symbols, doc, least)
    first, want, union = 0, collections.Counter(), set()
    for d in docs_of_numbers:
        for w, places in plain_maximal_repeats(d, least).items():
            want[len(w)] += 1
            union |= {first + p + k for p in places for k in range(len(w))}
        first += len(d)
    assert collections.Counter(n for n, _ in found) == want
    assert {p + k for p, n in zip(at.tolist(), size.tolist(), strict=True) for k in range(n)} == union
    assert len(at) <= len(symbols)


def test_quality_of_nothing(empty):
    assert repetition.quality(empty).count() == 0 and repetition.keep_sound(empty).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=30), min_size=1, max_size=4))
def test_longest_repeats(docs_of_numbers):
    symbols = np.array([x for d in docs_of_numbers for x in d], np.uint64)
    doc = np.array([i for i, d in enumerate(docs_of_numbers) for _ in d], np.int64)
    want = []
    for d in docs_of_numbers:
        for i in range(len(d)):
            want.append(max((next((k for k in range(min(len(d) - i, len(d) - j)) if d[i + k] != d[j + k]), min(len(d) - i, len(d) - j)) for j in range(len(d)) if j != i), default=0))
    assert repetition.longest_repeats(symbols, doc).tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n\x0b\x0c\ré\x85 ", max_size=20), min_size=1, max_size=5))
def test_words_are_those_of_the_pattern(texts):
    buffer, begin, end, hashes, first = textops.words([t.encode() for t in texts])
    raw = buffer.tobytes()
    got = [[raw[begin[k] : end[k]].decode() for k in range(first[i], first[i + 1])] for i in range(len(texts))]
    assert got == [WORD.findall(t) for t in texts]
    flat = [w for ws in got for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat))


def test_pieces_hold_every_token_once(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = collections.Counter()
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for s in range(0, len(ids), 512):
            part = ids[s : s + 512]
            want[i, s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    out = packing.pack(docs, length=512, group=16)
    got = out.collect()
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 512


def test_packing_of_nothing(empty):
    assert packing.pack(empty).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_first_fit_decreasing(sizes):
    bins, offsets = packing.first_fit_decreasing(sizes, 20)
    free, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        k = next((k for k, f in enumerate(free) if f >= sizes[i]), len(free))
        free += [20] * (k == len(free))
        want[i] = (k, 20 - free[k])
        free[k] -= sizes[i]
    assert {i: (bins[i], offsets[i]) for i in range(len(sizes))} == want


def test_tokens_of_odd_texts():
    import public_tokenizers

    known = packing.Words(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["don't it's 'tis a.b ,x <|endoftext|> y<|EndOfText|>", "é.à!?x", "İstanbul ΣΑΣ ﬁn x y", "éa 12.5 3,000 $x! …. ¿qué?", "a\x1cb\x85c", "中文。x 🙂🙂.", "ĲſK", "", "x" * 3000]
    for low, high in textops.packets([t.encode() for t in texts], 40):
        ids, at = known.encode([t.encode() for t in texts[low:high]])
        for i in range(high - low):
            assert ids[at[i] : at[i + 1]].tolist() == known.tokenizer.encode(texts[low + i], add_special_tokens=False).ids


SPEECH = {"aa": "lo mi fa lo ra mi lofa rami ", "bb": "kret stom brag krest stog brom ", "cc": "ñu ñi éa ñué iñe éañ "}


def test_languages_of_held_out_documents(spark):
    import random

    rng, rows = random.Random(2), []
    for i in range(240):
        lang = list(SPEECH)[i % 3]
        rows.append((i, " ".join(rng.choice(SPEECH[lang].split()) for _ in range(rng.randrange(3, 40))), lang, i % 4))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, fold int")
    model = language.train(docs.filter("fold <> 2"))
    for n, (keys, values) in enumerate(model.grams, 1):  # probabilities of all successors of a context add up to one
        assert (np.diff(keys.astype(object)) > 0).all() and len(values) == len(keys) and n
    odd = spark.createDataFrame([(900, None, "x"), (901, "", "x"), (902, "12 34 !!", "x"), (903, "щщ жж", "x")], "doc_id long, text string, score string")
    out = language.identify(docs.filter("fold = 2").select("doc_id", "text", "lang"), model).collect()
    assert all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in out) and sum(r.rejected for r in out) <= 0.05 * len(out)
    got = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0 and got[903].lang_pred in SPEECH and got[903].rejected


def test_probabilities_add_up():
    text = ["lo mi fa lo ra mi lofa rami"]
    codes, _, predicted = language.letters([t.encode() for t in text])
    at = np.flatnonzero(predicted)
    rows, counts = np.unique(np.column_stack([codes[at - 3], codes[at - 2], codes[at - 1], codes[at]]).astype(np.int64), axis=0, return_counts=True)
    model = language.fit(["aa"], np.zeros(len(rows), np.int64), rows, counts)
    alphabet = sorted(set(codes.tolist()))
    for context in ("   ", "o m", "zzz", "lo "):
        total = 0.0
        for c in [*map(chr, alphabet), "q"]:
            line = np.array([ord(x) for x in context + c], np.uint32)
            bits = None
            logs = 0.0
            for n in range(4, 0, -1):
                keys, values = model.grams[n - 1]
                k = language._hashes(line, np.array([3]), 0, n - 1)[0]
                hit = np.searchsorted(keys, k)
                if hit < len(keys) and keys[hit] == k:
                    bits = logs + values[hit, 0]
                    break
                keys, values = model.contexts[n - 1]
                k = language._hashes(line, np.array([3]), 1, n - 1)[0]
                hit = np.searchsorted(keys, k)
                logs += values[hit, 0] if hit < len(keys) and keys[hit] == k else 0
            total += 2 ** float(bits if bits is not None else logs + model.unseen[0])
        assert total == pytest.approx(1, abs=1e-4)


def test_language_without_labels(docs, empty):
    assert language.train(empty.select("text", "lang", F.lit(0).alias("fold"))) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(empty, None).count() == 0


def spoken(lang, seed, count=60):
    rng = random.Random(seed)
    return [" ".join(rng.choice(SPEECH[lang].split()) for _ in range(rng.randrange(3, 40))) for _ in range(count)]


def test_labelled_texts_without_a_letter_do_not_reach_the_calibration(spark):
    rows = [(t, lang, i % 4) for lang in ("aa", "bb") for i, t in enumerate(spoken(lang, 7))]
    bare = [(t, lang, fold) for t in ("", "12 34", "!?", " ") for lang in ("aa", "bb", "dd") for fold in (0, 3)]
    schema = "text string, lang string, fold int"
    plain = language.train(spark.createDataFrame(rows, schema).coalesce(1))
    for mixed in (bare + rows, rows[:50] + bare + rows[50:], rows + bare):
        model = language.train(spark.createDataFrame(mixed, schema).coalesce(1))
        assert model.languages == ["aa", "bb"] and np.isfinite([*model.mean, *model.spread, model.bound]).all()
        assert model.temperature == plain.temperature and model.bound == pytest.approx(plain.bound) and model.mean == pytest.approx(plain.mean)
    texts = [b"", b"lo mi", b"12", b"kret", b"!"]
    bits, n = plain.entropies(texts)
    assert n.tolist()[::2] == [0, 0, 0] and np.isfinite(bits).all() and bits[[1, 3]] == pytest.approx(plain.entropies(texts[1::2])[0])
    assert plain.entropies([b"", b"1"])[0].tolist() == [[0, 0], [0, 0]] and len(plain.entropies([])[0]) == 0


@pytest.mark.parametrize("folds", [(3,), (3, 3, 3, 3, 3, 3, 3, 3), (0, 3, 3)])
def test_rare_languages_learn_their_calibration_documents(spark, folds):
    rows = [(t, lang, i % 4) for lang in ("aa", "bb") for i, t in enumerate(spoken(lang, 7, 600))]
    rows += [("ñié", "cc", fold) if fold == 0 else (t, "cc", fold) for t, fold in zip(spoken("cc", 5, len(folds)), folds, strict=True)]
    model = language.train(spark.createDataFrame(rows, "text string, lang string, fold int"))
    plain = language.train(spark.createDataFrame([r for r in rows if r[1] != "cc"], "text string, lang string, fold int"))
    assert model.languages == ["aa", "bb", "cc"] and np.isfinite(model.bound)
    new = [t.encode() for t in spoken("cc", 6, 20)]
    best, _, bits, odd = model.judge(new)
    assert (best == 2).all() and np.mean(bits) < 5
    assert model.mean[:2] == pytest.approx(plain.mean, abs=0.1) and (model.judge([t.encode() for t in spoken("bb", 9)])[0] == 1).all()
    assert np.isfinite(model.mean[2]) == (len(folds) > 1)


def plain_kneser_ney(texts, alphabet, order=4):
    """Interpolated Kneser-Ney of characters, written out: a function from a context and a character to a probability."""
    lines = []
    for t in texts:
        folded = re.sub(" +", " ", "".join(c.lower()[0] if c.isalpha() else " " for c in t)).strip()
        lines.append(" " * (order - 1) + folded + " ")
    counts = {order: collections.Counter(x[i - order + 1 : i + 1] for x in lines for i in range(order - 1, len(x)))}
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
    discount = {}
    for n, c in counts.items():
        one, two = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        discount[n] = one / (one + 2 * two) if one and two else 0.5

    def p(context, ch, n=order):
        if n == 0:
            return 1 / alphabet
        c = context[len(context) - n + 1 :] if n > 1 else ""
        lower = p(context, ch, n - 1)
        follow = {g[-1]: v for g, v in counts[n].items() if g[:-1] == c}
        total = sum(follow.values())
        if not total:
            return lower
        return max(follow.get(ch, 0) - discount[n], 0) / total + discount[n] * len(follow) / total * lower

    return p


def test_entropies_equal_a_plain_version(spark):
    train = {lang: spoken(lang, 3, 30) for lang in ("aa", "bb")}
    rows = [(t, lang, 0) for lang, ts in train.items() for t in ts]
    rows += rows[:10] * 3  # copies are learnt once
    model = language.train(spark.createDataFrame(rows, "text string, lang string, fold int"))
    new = [*spoken("aa", 4, 6), *spoken("bb", 4, 6), "Lo 12 MI-fa ñ!"]
    bits, n = model.entropies([t.encode() for t in new])
    alphabet = len({c for ts in train.values() for t in ts for c in t}) + 1
    for k, lang in enumerate(model.languages):
        own = plain_kneser_ney(sorted(set(train[lang])), alphabet)
        for i, t in enumerate(new):
            x = "   " + re.sub(" +", " ", "".join(c.lower() if c.isalpha() else " " for c in t)).strip() + " "
            want = -sum(np.log2(own(x[j - 3 : j], x[j])) for j in range(3, len(x))) / (len(x) - 3)
            assert bits[i, k] == pytest.approx(want, abs=1e-3) and n[i] == len(x) - 3
