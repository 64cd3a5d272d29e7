import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, kept string, n int, size int, print string, _lane int, title string"


def make_docs(spark, rows):
    """Documents from (doc_id, text, source), with columns whose names the operators use inside."""
    full = [(i, t, None if s is None else "en", s, None if t is None else len(t), "k", "yes", 7, -1, "p", 3, None) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    """Null and empty texts, blanks only, one very long text, ties, repeated rows, null sources and ids."""
    random.seed(11)
    words = [f"w{k}" for k in range(400)]
    prose = lambda n: " ".join(random.choices(words, k=n)) + "."
    long = prose(30_000)
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "One", "b"), (5, "one", "b"), (6, "ONE", "b"), (7, long, "c"), (8, long, None)]
    rows += [(9, prose(120), "b"), (9, None, "b"), (None, "no id here " * 9, "d"), (None, None, None)]
    same = (10, prose(80), "c")
    rows += [same, same, (11, same[1] + " and a tail", "é"), (12, "Ärger " * 30, "z"), (13, "x " * 60, "z"), (14, "x " * 60, "z")]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return make_docs(spark, odd_rows())


@pytest.fixture(scope="session")
def empty(spark):
    return make_docs(spark, [])


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
