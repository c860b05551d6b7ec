import random

import pytest

SF = "/root/testdata/sf0.001"

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _text string, _row int"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, copies and near copies."""
    rng = random.Random(5)
    passage, base = words(rng, 70), words(rng, 200)
    near = base.split()
    near[100] = "changed"
    texts = [base, base, " ".join(near), passage, "start " + passage + " end " + words(rng, 30), words(rng, 40) + "\n" + passage,
             "", None, "   \n\t ", "one", "one", "a b c d", "the " * 3000, "x" * 5000, words(rng, 20_000), passage[:200],
             "日本語 のテキスト 😀 " * 20, "nul\x00byte \x1c\x85\u00a0 sep " * 30]
    rows = [(i * 3 + 1, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[3], (None, passage, None, None, None), (None, base, None, None, None), (200, None, None, None, None),
             (rows[4][0], words(rng, 60) + " " + passage, "en", "s", 1)]  # an id with two texts
    return [(*r, 0.5, "other", 7) for r in rows]


@pytest.fixture(scope="session")
def hard_docs(spark, hard_rows):
    return spark.createDataFrame(hard_rows, DOC_SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")
