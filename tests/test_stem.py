"""Stems against pairs of the published algorithm's description."""

import pytest
from pyspark.sql import functions as F

from moodlens.functions import stem
from moodlens.operators import stemmed_term_counts

# Words and their stems, by step.
PAIRS = """
caresses caress, ponies poni, ties ti, caress caress, cats cat, feed feed, agreed agre, plastered plaster, bled bled,
motoring motor, sing sing, conflated conflat, troubled troubl, sized size, hopping hop, tanned tan, falling fall,
hissing hiss, fizzed fizz, failing fail, filing file, happy happi, sky sky, relational relat, conditional condit,
rational ration, digitizer digit, operator oper, feudalism feudal, decisiveness decis, hopefulness hope, formaliti formal,
triplicate triplic, formative form, electrical electr, goodness good, revival reviv, allowance allow, airliner airlin,
adjustable adjust, irritant irrit, replacement replac, adoption adopt, communism commun, effective effect, probate probat,
rate rate, cease ceas, controll control, roll roll, generalizations gener, oscillators oscil, played plai, syzygy syzygi
"""
# not stemmed: two letters, an apostrophe, another script, digits, capitals, nothing
KEPT = ["is", "as", "it's", "été", "abc1s", "Cats", "", "42", "+s"]


def test_pairs_of_the_paper(spark):
    pairs = [tuple(pair.split()) for pair in PAIRS.replace("\n", " ").split(",")]
    rows = spark.createDataFrame(pairs, "term string, expected string").select("term", "expected", stem("term").alias("stem"))
    assert [r for r in rows.collect() if r["stem"] != r["expected"]] == []


def test_other_terms_stay(spark):
    rows = spark.createDataFrame([(term,) for term in [*KEPT, None]], "term string").select("term", stem("term").alias("stem"))
    assert all(r["stem"] == r["term"] for r in rows.collect())


def test_words_without_vowels_and_long_words(spark):
    words = ["sss", "bbb", "yyy", "eed", "ing", "ion", "x" * 20_000 + "ing", "a" * 20_000]
    rows = spark.createDataFrame([(w,) for w in words], "term string").select("term", stem("term").alias("stem")).collect()
    stems = {r["term"]: r["stem"] for r in rows}
    assert [stems[w] for w in words[:6]] == ["sss", "bbb", "yyi", "eed", "ing", "ion"]
    assert stems[words[6]] == words[6] and stems[words[7]] == words[7]


@pytest.mark.parametrize("texts", [[], [None, ""], ["Connect connected, connecting THE connections the", None, "42 thé"]])
def test_counts(spark, texts):
    counts = stemmed_term_counts(spark.createDataFrame([(t,) for t in texts], "tweet string"))
    found = {r["term"]: r["count"] for r in counts.collect()}
    assert found == ({"connect": 4, "42": 1, "thé": 1} if len(texts) == 3 else {})


def test_filtered_stems_stay_small_in_the_plan(spark):
    terms = spark.range(3).select(F.col("id").cast("string").alias("term"))
    plan = terms.select(stem("term").alias("stem")).where("stem <> 'x'")._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 100_000
