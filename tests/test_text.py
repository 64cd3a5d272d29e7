"""Cleaning, tokens, length buckets and sentiment."""

import importlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodlens.functions import clean_text, index_terms, length_bucket, sentiment_tokens
from moodlens.operators import add_sentiment, sentiment, term_counts
from moodlens.operators.sentiment import score_by_join
from moodlens.schemas import LEXICON
from moodlens.session import salted_join

# the package has a function of the same name
polarity_module = importlib.import_module("moodlens.functions.polarity")
ALPHABET = "abyzAZ019@@::// \t\n.,!?#'\"éßñ中  \x1c\x85_-"


def texts_df(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, tweet string")


def values(df, column):
    return [row[0] for row in df.orderBy("id").select(column).collect()]


def _is_ascii_alnum(sign):
    return sign.isascii() and sign.isalnum()


def _address_end(text, at):
    """Where a spaced-out address that starts with the blank at ``at`` ends; ``at`` if there is none."""
    word = at + 1
    while word < len(text) and (text[word].isalnum() or text[word] == "_"):
        word += 1
    rest = word + len(": /  / ")
    if word == at + 1 or text[word:rest] != ": /  / ":
        return at
    end = rest
    while end < len(text) and not text[end].isspace():
        end += 1
    return end if end > rest else at


def scan_clean(text):
    """The rules of cleaning, sign by sign: mentions, signs before a blank and spaced-out addresses become one blank."""
    kept, at = [], 0
    while at < len(text):
        sign, end = text[at], at
        if sign == "@":
            end = at + 1
            while end < len(text) and _is_ascii_alnum(text[end]):
                end += 1
            end = at if end == at + 1 else end
        if end == at and not _is_ascii_alnum(sign) and sign not in " \t" and text[at + 1 : at + 2] == " ":
            end = at + 2
        if end == at and sign == " ":
            end = _address_end(text, at)
        kept.append(sign if end == at else " ")
        at = max(end, at + 1)
    return " ".join("".join(kept).split())


@pytest.mark.parametrize(
    "text, expected",
    [
        ("@bob hi, there! http://x.y/z ok... #tag", "hi there http://x.y/z ok.. #tag"),
        ("café, olé ! ok", "café ol ok"),
        ("x w: /  / foo bar", "x bar"),
        ("", ""),
        (None, None),
    ],
)
def test_clean_examples(spark, text, expected):
    assert values(texts_df(spark, [text]), clean_text("tweet")) == [expected]


def test_clean_can_drop_urls(spark):
    df = texts_df(spark, ["see http://x.y/z now"])
    assert values(df, clean_text("tweet", strip_urls=True)) == ["see now"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ALPHABET, max_size=60) | st.text(max_size=30), min_size=100, max_size=200))
def test_clean_equals_scanner(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert values(texts_df(spark, texts), clean_text("tweet")) == [scan_clean(t) for t in texts]


def test_length_bucket(spark):
    texts = ["", "x" * 9, "x" * 10, "x" * 280, "é" * 15]
    assert values(texts_df(spark, texts), length_bucket("tweet")) == [0, 0, 10, 280, 10]
    assert values(texts_df(spark, texts), length_bucket("tweet", size=100)) == [0, 0, 0, 200, 0]


def test_index_terms(spark):
    assert values(texts_df(spark, ["Don't PANIC: l'été 42!"]), index_terms("tweet")) == [["don't", "panic", "l'été", "42"]]


def test_term_counts(spark):
    counts = term_counts(texts_df(spark, ["The cat and the Cat", "no dog", None]))
    assert {row["term"]: row["count"] for row in counts.collect()} == {"cat": 2, "dog": 1}


LEXICON_ROWS = [("good", 0.5), ("bad", -0.75), ("fine", 0.25), ("fine", 0.75)]


def python_score(text, polarity):
    found = [polarity[t] for t in re.findall("[a-z]+", scan_clean(text).lower()) if t in polarity] if text else []
    return sum(found) / len(found) if found else 0.0


def test_sentiment_examples(spark):
    lexicon = spark.createDataFrame(LEXICON_ROWS, LEXICON)
    texts = ["Good, bad day", "fine", "@good nothing", "", None, "GOOD good bad"]
    scored = add_sentiment(texts_df(spark, texts), lexicon)
    assert scored.schema["tweet_sentiment"].dataType.simpleString() == "double"
    assert values(scored, "tweet_sentiment") == [-0.125, 0.5, 0.0, 0.0, 0.0, (0.5 + 0.5 - 0.75) / 3]


def test_empty_lexicon(spark):
    scored = add_sentiment(texts_df(spark, ["good"]), spark.createDataFrame([], LEXICON))
    assert values(scored, "tweet_sentiment") == [0.0]


@pytest.mark.parametrize("row", [("good", 1.5), ("good", None), (None, 0.5), ("don't", 0.5), ("olé", 0.5)])
def test_bad_lexicon_is_refused_at_any_size(spark, row):
    lexicon = spark.createDataFrame([("fine", 0.5), row], LEXICON)
    for max_bytes in (1 << 20, 1):
        with pytest.raises(ValueError):
            add_sentiment(texts_df(spark, ["fine"]), lexicon, max_table_bytes=max_bytes)


def test_lexicon_terms_match_in_any_case(spark):
    lexicon = spark.createDataFrame([("Good", 0.5), ("GOOD", 1.0)], LEXICON)
    df = texts_df(spark, ["good day"])
    for max_bytes in (1 << 20, 1):
        assert values(add_sentiment(df, lexicon, max_table_bytes=max_bytes), "tweet_sentiment") == [0.75]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ALPHABET + "\u212a\u0130\u0131", max_size=40), min_size=100, max_size=200))
def test_tokens_are_those_of_the_cleaned_text(spark, texts):
    texts += ["x w: /  / foo bar", "a. w: /  / foo. b: /  / c d", "K \u212a x\u212ay \u0130 \u0130x", "@ab cd@ef"]
    df = texts_df(spark, texts)
    cleaned = values(df, F.regexp_extract_all(F.lower(clean_text("tweet")), F.lit("[a-z]+"), F.lit(0)))
    assert values(df, sentiment_tokens("tweet")) == cleaned


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["good", "Bad", "t7", "t99", "@t7", "x", "the.", "!"]), max_size=12), min_size=50, max_size=80))
def test_sentiment_inline_joined_and_python_agree(spark, words):
    polarity = {"good": 0.5, "bad": -0.75, **{f"t{chr(97 + i)}": (i - 8) / 8 for i in range(16)}}
    texts = [" ".join(w).replace("7", "c").replace("99", "p") for w in words] + [None, "tc tp " * 50]
    df = texts_df(spark, texts + texts[:3])
    lexicon = spark.createDataFrame(list(polarity.items()), LEXICON)
    expected = [python_score(t, polarity) for t in texts + texts[:3]]
    assert values(add_sentiment(df, lexicon), "tweet_sentiment") == expected
    assert values(score_by_join(df, lexicon), "tweet_sentiment") == expected


def test_large_lexicon_is_joined(spark):
    lexicon = spark.range(500).select(
        F.concat(F.lit("w"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("term"),
        ((F.col("id") % 9 - 4) / 4).alias("polarity"),
    )
    df = texts_df(spark, ["wb wcd", "wzz", "wejj wa wa"])
    inline = add_sentiment(df, lexicon)
    joined = add_sentiment(df, lexicon, max_table_bytes=100)
    assert "Join" not in inline._jdf.queryExecution().executedPlan().toString()
    assert "Join" in joined._jdf.queryExecution().executedPlan().toString()
    assert values(inline, "tweet_sentiment") == values(joined, "tweet_sentiment") != [0.0] * 3


def test_pairs_of_a_join_are_short(spark, monkeypatch):
    """A pair of text and term took the 64 digits of the text's digest, and each array of tokens was copied."""
    pairs = []
    monkeypatch.setattr(sentiment, "salted_join", lambda left, *rest, **how: (pairs.append(left), salted_join(left, *rest, **how))[1])
    lexicon = spark.createDataFrame(LEXICON_ROWS, LEXICON)
    scored = score_by_join(texts_df(spark, [" Good, bad day. ", "  ", "", None, "1 good", "Good bad day"]), lexicon)
    assert values(scored, "tweet_sentiment") == [-0.125, 0.0, 0.0, 0.0, 0.5, -0.125]
    counted = pairs[0]
    assert {(row["term"], row["n"]) for row in counted.collect()} == {("good", 1), ("bad", 1), ("day", 1)} and counted.count() == 7
    assert {row["size"] for row in counted.select(F.octet_length("_digest").alias("size")).collect()} == {16}
    assert "array_remove" not in counted._jdf.queryExecution().executedPlan().toString()


def test_joined_lexicon_is_checked_once_and_hashed(spark, monkeypatch):
    """The lexicon was checked twice, and all pairs of text and term were sorted to meet it."""
    checks, check = [], sentiment.check_lexicon
    for module in (sentiment, polarity_module):
        monkeypatch.setattr(module, "check_lexicon", lambda lexicon: (checks.append(1), check(lexicon))[1])
    joins = []
    monkeypatch.setattr(sentiment, "LEAST_HASHED_BYTES", 1)
    monkeypatch.setattr(sentiment, "salted_join", lambda *sides, **how: (joins.append(salted_join(*sides, **how)), joins[-1])[1])
    lexicon, df = spark.createDataFrame(LEXICON_ROWS, LEXICON), texts_df(spark, ["Good, bad day", "fine", None])
    assert values(add_sentiment(df, lexicon, max_table_bytes=1), "tweet_sentiment") == [-0.125, 0.5, 0.0]
    assert len(checks) == 1
    assert "ShuffledHashJoin" in joins[0]._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(sentiment, "MAX_HASHED_BYTES", -1)
    assert values(score_by_join(df, lexicon), "tweet_sentiment") == [-0.125, 0.5, 0.0]
    assert "ShuffledHashJoin" not in joins[2]._jdf.queryExecution().executedPlan().toString()


def test_joined_texts_are_scored_in_rounds(spark, monkeypatch):
    """All pairs of text and term lay in exchanges at once, and were exchanged before they were counted."""
    pairs = []
    monkeypatch.setattr(sentiment, "salted_join", lambda left, *rest, **how: (pairs.append(left), salted_join(left, *rest, **how))[1])
    words = ["good", "bad", "the", "day", "fine", "none", "x"]
    texts = [" ".join(words[i % min(k, 7)] for i in range(k + 2)) + f" w{k}" for k in range(1, 60)] + [None, "", "good day"] * 3
    df, lexicon = texts_df(spark, texts), spark.createDataFrame(LEXICON_ROWS, LEXICON)
    wanted = values(add_sentiment(df, lexicon), "tweet_sentiment")
    assert values(score_by_join(df, lexicon), "tweet_sentiment") == wanted and len(pairs) == 2
    plan = pairs[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Exchange hashpartitioning(_digest" in plan
    monkeypatch.setattr(sentiment, "ROUND_ROWS", 0)
    monkeypatch.setattr(sentiment, "ROUND_BYTES", 1000)
    pairs.clear()
    assert values(score_by_join(df, lexicon), "tweet_sentiment") == wanted and len(set(wanted)) > 5
    assert len(pairs) > 3
    empty = spark.createDataFrame([], df.schema)
    assert values(score_by_join(empty, lexicon), "tweet_sentiment") == []
    nothing = texts_df(spark, [None, None])
    assert values(score_by_join(nothing, lexicon), "tweet_sentiment") == [0.0, 0.0]


def test_sentiment_needs_no_shuffle(spark):
    scored = add_sentiment(texts_df(spark, ["good"]), spark.createDataFrame(LEXICON_ROWS, LEXICON))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_scores_do_not_extract_tokens(spark):
    """Extraction of every token took most of the time of a score."""
    scored = add_sentiment(texts_df(spark, ["  Good, bad day", "bad "]), spark.createDataFrame(LEXICON_ROWS, LEXICON))
    assert "regexp_extract_all" not in scored._jdf.queryExecution().executedPlan().toString()
    assert values(scored, "tweet_sentiment") == [-0.125, -0.75]
    assert values(texts_df(spark, [" a b ", "", "1", None]), sentiment_tokens("tweet")) == [["a", "b"], [], [], None]
