import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from scorelake.llm import infilling


def units(text, unit):
    """The text cut into its units, by plain means."""
    if unit == "character":
        return list(text)
    pattern = r"(?<=[ \t-\r])(?=[^ \t-\r])" if unit == "word" else r"(?<=\n)(?=.)"
    return [x for x in re.split(pattern, text, flags=re.S) if x] if text else []


def plain_version(key, text, unit, seed=1, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    parts = units(text, unit)
    n = len(parts)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in marks) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"{marks[1]}{s}{marks[0]}{p}{marks[2]}{m}"
    return n, "psm", a, b - a, f"{marks[0]}{p}{marks[1]}{s}{marks[2]}{m}"


@pytest.mark.parametrize("unit", ["character", "word", "line"])
def test_equals_a_plain_version(spark, docs, unit, monkeypatch):
    rows = docs.select("doc_id", "text").collect()
    got = infilling.fill_in_middle(docs, unit=unit).select("doc_id", "n", "form", "prefix_units", "middle_units", "output")
    want = sorted(str((r.doc_id, *plain_version(r.doc_id, r.text, unit))) for r in rows)
    assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_text_comes_back(docs):
    moved = infilling.fill_in_middle(docs.withColumn("whole", F.coalesce("text", F.lit(""))))
    assert moved.filter(infilling.restored(F.col("output"), F.col("form")) != F.col("whole")).count() == 0
    assert {r.form for r in moved.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_texts_with_marks_stay_plain(spark):
    texts = ["a<P>b", "<S>", "x<M", "<P", "S>", "<", "<<S", "P><M"] * 20
    moved = infilling.fill_in_middle(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = moved.withColumn("back", infilling.restored(F.col("output"), F.col("form"))).orderBy("doc_id").collect()
    assert [r.back for r in rows] == texts
    assert all(r.form == "plain" for r in rows if texts[r.doc_id] in ("a<P>b", "<S>"))
    assert any(r.form != "plain" for r in rows if texts[r.doc_id] == "<<S")


def test_every_cut_of_long_texts(monkeypatch):
    monkeypatch.setattr(infilling, "CHUNK", 7)
    monkeypatch.setattr(infilling, "TOGETHER", 20)
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "é", "🙂", " ", "\n", "中"]) for _ in range(rng.randrange(90))) for _ in range(60)] + [""]
    for unit in infilling.UNITS:
        grid = infilling.Grid([t.encode() for t in texts], unit)
        parts = [units(t, unit) for t in texts]
        assert grid.units().tolist() == [len(p) for p in parts]
        for rank in range(92):
            want = [len("".join(p[:rank]).encode()) for p in parts]
            assert grid.cuts(infilling.np.full(len(texts), rank)).tolist() == want


def test_other_columns_and_empty_tables(docs, empty):
    odd = docs.withColumn("form", F.lit("mine")).withColumn("output", F.lit(1))
    got = infilling.fill_in_middle(odd)
    assert got.columns == [c for c in docs.columns if c != "text"] + ["n", "form", "prefix_units", "middle_units", "output"]
    assert got.count() == docs.count()
    assert infilling.fill_in_middle(empty).count() == 0
    other = infilling.fill_in_middle(docs, seed=2, marks=("[a]", "[b]", "[c]"))
    assert other.filter("form <> 'plain' AND output NOT LIKE '[%'").count() == 0
