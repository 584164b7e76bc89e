import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tkey string, node string, row long, kept string, size string"


def words(rng, n, vocabulary=400):
    return " ".join(rng.choice("abcdefghijklm") + str(rng.randrange(vocabulary)) + "x" for _ in range(n))


def corpus(seed=5):
    """Texts of many kinds: plain, copies, near copies, repeated passages, very long, empty, null, odd characters."""
    rng = random.Random(seed)
    texts = [words(rng, rng.randrange(1, 120)) for _ in range(30)]
    base = words(rng, 90).split(" ")
    texts += [" ".join(base)] * 6
    for _ in range(14):  # near copies that are not all alike among themselves
        one = list(base)
        for k in rng.sample(range(90), rng.randrange(1, 4)):
            one[k] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(one))
    passage = words(rng, 60)
    texts += [f"{words(rng, 20)}\n{passage}\n{words(rng, 20)}" for _ in range(8)]
    texts += [words(rng, 12) + "\n" + "\n".join([words(random.Random(3), 25)] * 9), words(rng, 9000), "", None, " \t\n", "one", "One  TWO\tthree", "é🙂 ü ß #*$ a|b <c>", "a " * 50]
    return texts


@pytest.fixture(scope="session")
def docs(spark):
    """Rows with nulls in every column, a repeated row, and columns whose names the operators use themselves."""
    rows = [(i, t, ["de", "en", None][i % 3], f"s{i % 4}" if i % 9 else None, len(t or ""), "x", "y", 1, "z", "w") for i, t in enumerate(corpus())]
    rows += [rows[0], (None, rows[1][1], None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.filter("false")
