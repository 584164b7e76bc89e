import random

import pytest
from pyspark.sql import functions as F

from scorelake.operators import grams
from scorelake.plans import store

PATTERNS = ["kim", "KIM 3", "m 3 ab", "a%b", "ki_ 3", "x\\_y", "10\\%", "é ß", "", "%", "_", "im", "kim%able", "nobody here", "\\", "İst", "müll", "l e"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    words = ["Kim 3 Able", "Kim 4 Cole", "x_y z", "xay z", "10% of", "100 of", "É ß", "Müller", "İstanbul", "ab", "", None, "a\\b", "Al Eve"]
    rows = [(rng.choice([1, 2, 3, 4, None]) if i % 3 else i, i, rng.choice(words), rng.choice([*words, f"p{i}"])) for i in range(800)]
    return spark.createDataFrame(rows, "contest_id long, id long, a string, b string").cache()


@pytest.mark.parametrize("pattern", PATTERNS)
def test_search_equals_the_scan(table, pattern):
    index = grams.index_of(table, ["a", "b"], "contest_id")
    try:
        want = sorted(r.id for r in table.filter(F.col("a").ilike(f"%{pattern}%") | F.col("b").ilike(f"%{pattern}%")).collect())
    except Exception as e:  # a pattern that is no pattern
        with pytest.raises(type(e)):
            grams.search(table, index, ["a", "b"], "contest_id", pattern).collect()
        return
    assert sorted(r.id for r in grams.search(table, index, ["a", "b"], "contest_id", pattern).collect()) == want


def test_literal_parts():
    assert grams.literals("abc%de_fghi") == ["abc", "fghi"] and grams.literals("a\\%b") == ["a%b"] and grams.literals("a%b") == []


def test_an_index_leaves_out_files_and_rows(spark, tmp_path):
    plays = spark.range(4000).select((F.col("id") / 100).cast("long").alias("contest_id"), "id", F.concat(F.lit("Kim "), (F.col("id") / 100).cast("int").cast("string"), F.lit(" Able")).alias("name"))
    store.replace_keys(spark, tmp_path / "grams", grams.index_of(plays, ["name"], "contest_id"), "gram", None, files=8)
    found = grams.wanted(plays, "im 17 a")
    index = store.read_table(spark, tmp_path / "grams", keys=("gram", found))
    assert len(found) == 5 and len(index.inputFiles()) < 6 and index.count() < grams.index_of(plays, ["name"], "contest_id").count() / 4
    assert [r.contest_id for r in grams.keys_with(index, "contest_id", found).collect()] == [17]
    assert sorted(r.id for r in grams.search(plays, index, ["name"], "contest_id", "im 17 a").collect()) == list(range(1700, 1800))
    assert store.read_table(spark, tmp_path / "grams", keys=("gram", [5])).count() == 0
    many = store.read_table(spark, tmp_path / "grams", keys=("gram", [*found, *range(2000)]))
    assert many.count() == index.count()
