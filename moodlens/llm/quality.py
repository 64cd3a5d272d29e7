"""Quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.llm.shared import WORD, fresh, words_of
from moodlens.session import checkpointed

# fixed value: the characters that count as symbols
SYMBOLS = "[#*$%&|<>]"

MIN_WORDS = 20
REPEAT_WINDOW = 8
#: Rows of the sample from which cost and selectivity of the rules are estimated. It decides their order, never a verdict.
SAMPLE_ROWS = 2000


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column, window: int) -> Column:
    """Words inside windows that occur twice or more in the text.

    Distinct hashes prove that all windows differ, which settles most texts. Else the windows themselves are sorted; neighbours that
    are equal repeat, and the words they cover are counted once.
    """
    starts = F.sequence(F.lit(0), F.size(words) - window)

    def all_differ(hashes: Column, width: int) -> Column:
        """Hashes of ``width`` words are joined in pairs until they span a window; ``window`` is a power of two."""
        if width == window:
            return _let(F.slice(hashes, 1, F.size(words) - window + 1), lambda h: F.size(F.array_distinct(h)) == F.size(h))
        return _let(F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + width))), lambda h: all_differ(h, 2 * width))

    def covered(ordered: Column) -> Column:
        def repeated(e: Column, k: Column) -> Column:
            same_before = F.coalesce(F.get(ordered, k - 1)["w"] == e["w"], F.lit(False))
            return F.when(same_before | F.coalesce(F.get(ordered, k + 1)["w"] == e["w"], F.lit(False)), e["i"])

        found = F.sort_array(F.filter(F.transform(ordered, repeated), lambda i: i.isNotNull()))
        steps = lambda at: F.transform(
            at, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - p, F.lit(window)))
        )
        return _let(found, lambda at: F.aggregate(steps(at), F.lit(0), lambda a, b: a + b))

    windows = F.transform(starts, lambda i: F.struct(F.slice(words, i + 1, window).alias("w"), i.alias("i")))
    none_repeats = _let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: all_differ(h, 1))
    return F.when(F.size(words) < window, F.lit(0)).when(none_repeats, F.lit(0)).otherwise(_let(F.sort_array(windows), covered))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The base measures of a text, all whole numbers. ``words`` are its words; ``text`` is not null."""
    return {
        "n_words": F.size(words),
        "word_chars": F.aggregate(words, F.lit(0), lambda total, w: total + F.char_length(w)),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": _dup_lines(text),
        "n_repeat_words": _repeat_words(words, REPEAT_WINDOW),
    }


#: The base rules: these reject whatever the others say. A rule is true for a text that is to go.
BASE_RULES = {
    "too_few_words": lambda m, text: m["n_words"] < MIN_WORDS,
    "repeats_itself": lambda m, text: 100 * m["n_repeat_words"] > 30 * m["n_words"],
}

#: The further rules of the cascade. Each is loose enough that ordinary prose never meets it.
RULES = {
    "symbols": lambda m, text: 10 * m["n_symbols"] > 3 * m["n_words"],
    "shouting": lambda m, text: 10 * F.regexp_count(text, F.lit(r"\p{Lu}")) > 6 * m["word_chars"],
    "exclamations": lambda m, text: 10 * F.regexp_count(text, F.lit("!")) > 5 * m["n_words"],
    "long_words": lambda m, text: m["word_chars"] > 30 * m["n_words"],
    "repeated_lines": lambda m, text: 10 * m["n_dup_lines"] > 7 * F.size(F.split(text, "\n")),
}


def rule_statistics(docs: DataFrame, rules: dict, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Cost in seconds and share of rejected rows of each rule, from a run over a sample of about ``sample_rows`` rows."""
    rows = docs.count()
    sample = docs.select(F.coalesce(docs["text"], F.lit("")).alias("text"))
    if rows > sample_rows:
        sample = sample.sample(fraction=sample_rows / rows, seed=9)
    sample = checkpointed(sample)
    text = F.col("text")
    size = sample.count()
    found = []
    for name, rule in rules.items():
        began = time.perf_counter()
        rejects = _first_of(text, {name: rule}, [name]).isNotNull()
        rejected = sample.agg(F.sum(rejects.cast("long"))).first()[0] or 0
        found.append({"rule": name, "cost": time.perf_counter() - began, "rejects": rejected / max(1, size)})
    return found


def cascade_order(statistics: list[dict]) -> list[str]:
    """The rules by rejections per cost, the best first; ties by name."""
    return [s["rule"] for s in sorted(statistics, key=lambda s: (-s["rejects"] / max(s["cost"], 1e-9), s["rule"]))]


def _first_of(text: Column, rules: dict, order: list[str]) -> Column:
    """The first rule in ``order`` that rejects a text, null if none does. Later rules are not evaluated."""

    def verdict(words: Column) -> Column:
        m = measures(text, words)
        found = F.when(F.lit(False), F.lit(None).cast("string"))
        for name in order:
            found = found.when(rules[name](m, text), F.lit(name))
        return found

    return _let(words_of(text), verdict)


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base measures, base_failed, kept.

    A null text has no words and fails, as does an empty one. Repeated rows are judged alike; other columns are ignored; an empty table
    gives no rows. The measures are in the result, so every row has them all; only the further rules run as a cascade, whose order
    comes from a sample and does not change the verdict.
    """
    order = cascade_order(rule_statistics(docs, RULES))
    text = F.col("text")
    worded = docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text")).withColumn("words", words_of(text))
    names = list(measures(text, F.col("words")))
    measured = worded.select("doc_id", "text", *[c.cast("long").alias(n) for n, c in measures(text, F.col("words")).items()])
    m = {n: F.col(n) for n in names}
    verdict = F.when(F.lit(False), F.lit(True))
    for name in order:
        verdict = verdict.when(RULES[name](m, text), F.lit(False))
    base = BASE_RULES["too_few_words"](m, text) | BASE_RULES["repeats_itself"](m, text)
    return measured.withColumn("base_failed", base).select(
        "doc_id", *names, "base_failed", F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict.otherwise(F.lit(True))).alias("kept")
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that a rule rejects, columns unchanged. All rules run as one cascade, in the order of a sample."""
    rules = {**BASE_RULES, **RULES}
    order = cascade_order(rule_statistics(docs, rules))
    (rejected,) = fresh(docs, "_rejected")
    return docs.withColumn(rejected, _first_of(F.coalesce(docs["text"], F.lit("")), rules, order)).filter(F.col(rejected).isNull()).select(*docs.columns)
