"""Secret scan: fixed patterns, and a battery of randomness tests over long tokens; DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: the patterns of the base kinds, as listed
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
MIN_ASSIGNED = 12

#: Tokens that are tested for randomness: long runs of the letters of usual encodings.
TOKEN = "[A-Za-z0-9+/_=-]{20,}"

# fixed values: the alphabets of the encodings, from narrow to wide
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "upper_hex": DIGITS + "ABCDEF",
    "lower26": LOWER,
    "upper26": UPPER,
    "lower32": LOWER + "234567",
    "base32": UPPER + "234567",
    "lower36": DIGITS + LOWER,
    "upper36": DIGITS + UPPER,
    "letters52": UPPER + LOWER,
    "alnum62": DIGITS + UPPER + LOWER,
    "base64": DIGITS + UPPER + LOWER + "+/",
    "base64url": DIGITS + UPPER + LOWER + "_-",
    "every66": DIGITS + UPPER + LOWER + "+/_-",
}
#: Letters from which what is left of a token without padding and separators is tested.
MIN_BODY = 16
# fixed values: usual shares of the letters a to z in written text, in percent
LETTER_PERCENT = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)

#: A token is called random only if no test of the battery rejects randomness at this level.
BATTERY_LEVEL = 0.001
#: Share of false discoveries accepted among the tokens called random.
FALSE_DISCOVERIES = 0.001
#: log10 evidence is kept in steps of this size, between 0 and the limit, so the discovery table has a bounded number of rows.
EVIDENCE_STEP, EVIDENCE_LIMIT = 0.05, 400.0


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(text: Column, pattern: str, order: int, keep=None) -> Column:
    """Spans of the matches of ``pattern``: start and end in code points, the order of the kind and the matched string.

    The matches and the gaps between them alternate, so their lengths give the places. ``keep`` filters by the match and its second
    group. Texts without a match cost one search.
    """
    second = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if keep is not None else None

    def placed(matches: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))
        sizes = F.transform(matches, lambda m: F.char_length(m))
        both = F.zip_with(gaps, sizes, lambda g, s: F.struct(g.alias("g"), s.alias("s")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends"))
        ends = F.aggregate(
            F.filter(both, lambda b: b["s"].isNotNull()),
            start,
            lambda a, b: F.struct((a["at"] + b["g"] + b["s"]).alias("at"), F.array_append(a["ends"], a["at"] + b["g"] + b["s"]).alias("ends")),
            lambda a: a["ends"],
        )
        full = F.zip_with(matches, ends, lambda m, e: F.struct((e - F.char_length(m)).alias("start"), F.lit(order).alias("order"), e.alias("end"), m.alias("value")))
        if keep is None:
            return full
        judged = F.zip_with(full, second, lambda x, v: F.struct(x.alias("x"), v.alias("v")))
        return F.transform(F.filter(judged, lambda j: keep(j["v"])), lambda j: j["x"])

    found = F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed))
    empty = F.array().cast("array<struct<start:int,order:int,end:int,value:string>>")
    return F.coalesce(found, empty)


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of the three base kinds of a text that is not null."""
    return {
        "assign": _spans(text, ASSIGN, 0, lambda value: F.char_length(value) >= MIN_ASSIGNED),
        "access": _spans(text, ACCESS, 1),
        "hex": _spans(text, HEX, 2),
    }


def _body(token: Column) -> Column:
    """The longest part of a token between signs of assignment or padding; hex digits in groups, as in a UUID, without what parts them."""
    parts = F.transform(F.split(token, "="), lambda p: F.struct(F.char_length(p).alias("n"), p.alias("part")))
    grouped = "^(?:[0-9a-f]+[-_])+[0-9a-f]+$|^(?:[0-9A-F]+[-_])+[0-9A-F]+$"
    return _let(F.array_max(parts)["part"], lambda p: F.when(p.rlike(grouped), F.regexp_replace(p, "[-_]", "")).otherwise(p))


def _encoding(token: Column) -> Column:
    """The narrowest alphabet that holds every letter of a token."""
    *narrow, widest = ALPHABETS.values()
    found = F.lit(widest)
    for letters in reversed(narrow):
        found = F.when(token.rlike(f"^[{letters}]+$"), F.lit(letters)).otherwise(found)
    return found


def _tail(z: Column) -> Column:
    """Upper bound of the two-sided tail of a normal variate: 2 exp(-z^2/2) / (|z| + sqrt(z^2 + 8/pi)) * sqrt(2/pi)."""
    size = F.abs(z)
    return F.least(F.lit(1.0), 2 * math.sqrt(2 / math.pi) * F.exp(-size * size / 2) / (size + F.sqrt(size * size + 8 / math.pi)))


def _text_cost() -> Column:
    """log10 of the share of each base64 letter in ordinary text, as an array by code point (only letters of the alphabets count)."""
    shares = {c: 0.9 * LETTER_PERCENT[ord(c) - ord("a")] / 100 for c in "abcdefghijklmnopqrstuvwxyz"}
    shares |= {c.upper(): 0.05 * LETTER_PERCENT[ord(c) - ord("a")] / 100 for c in "abcdefghijklmnopqrstuvwxyz"}
    shares |= {c: 0.004 for c in "0123456789"} | {c: 0.002 for c in "+="} | {c: 0.02 for c in "/_-"}
    return F.array(*[F.lit(math.log10(shares.get(chr(k), 1e-4))) for k in range(128)])


def evidence(token: Column) -> Column:
    """log10 evidence that a token is random rather than text, or -1 if a test of the battery finds it not random.

    Against randomness: chi-squared of the letter counts over the inferred alphabet (by the cube-root normal approximation), runs above
    and below the middle of the alphabet, and the serial correlation of neighbours; the smallest of the three tails, times three, is
    compared with the level. For it: the likelihood ratio of a uniform draw against letters of text, which grows with the length. By
    Markov's inequality its inverse bounds the chance that a token of text scores so high. All is counted over the body of the token,
    without padding and the separators of grouped hex digits.
    """
    return _let(_body(token), lambda body: F.when(F.char_length(body) >= MIN_BODY, _body_evidence(body)).otherwise(F.lit(-1.0)))


def _body_evidence(token: Column) -> Column:
    def by_alphabet(alphabet: Column) -> Column:
        k = F.char_length(alphabet).cast("double")
        n = F.char_length(token).cast("double")
        chars = F.split(token, "(?<=.)(?=.)")
        places = F.transform(chars, lambda c: F.instr(alphabet, c).cast("double") - 1)
        counts = F.transform(F.sequence(F.lit(1), F.char_length(alphabet)), lambda j: n - F.char_length(F.replace(token, F.substring(alphabet, j, F.lit(1)), F.lit(""))))
        squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + (c - n / k) * (c - n / k))
        df = k - 1
        chi_z = (F.cbrt(squares * k / n / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        chi_p = F.when(chi_z <= 0, F.lit(1.0)).otherwise(_tail(chi_z))

        def of_places(p: Column) -> Column:
            high = F.transform(p, lambda x: (x >= k / 2).cast("int"))

            def runs_p(h: Column) -> Column:
                up = F.aggregate(h, F.lit(0), lambda a, x: a + x).cast("double")
                down = n - up
                runs = 1 + F.aggregate(F.transform(h, lambda x, i: (x != F.coalesce(F.get(h, i - 1), x)).cast("int")), F.lit(0), lambda a, x: a + x)
                expected = 2 * up * down / n + 1
                variance = (expected - 1) * (expected - 2) / (n - 1)
                return F.when(variance > 0, _tail((runs - expected) / F.sqrt(variance))).otherwise(F.lit(0.0))

            mean = F.aggregate(p, F.lit(0.0), lambda a, x: a + x) / n

            def serial_p(m: Column) -> Column:
                spread = F.aggregate(p, F.lit(0.0), lambda a, x: a + (x - m) * (x - m))
                pairs = F.aggregate(F.transform(p, lambda x, i: (x - m) * (F.coalesce(F.get(p, i + 1), m) - m)), F.lit(0.0), lambda a, x: a + x)
                return F.when(spread > 0, _tail(pairs / spread * F.sqrt(n))).otherwise(F.lit(0.0))

            return F.least(_let(high, runs_p), _let(mean, serial_p))

        def weight(costs: Column) -> Column:
            as_text = F.aggregate(chars, F.lit(0.0), lambda a, c: a + F.get(costs, F.least(F.ascii(c), F.lit(127))))
            return -n * F.log10(k) - as_text

        battery = 3 * F.least(chi_p, _let(places, of_places))
        return F.when(battery >= BATTERY_LEVEL, F.least(F.lit(EVIDENCE_LIMIT), F.greatest(F.lit(0.0), _let(_text_cost(), weight)))).otherwise(F.lit(-1.0))

    return _let(_encoding(token), by_alphabet)


def discovery_threshold(docs: DataFrame, rate: float = FALSE_DISCOVERIES) -> float | None:
    """Least log10 evidence of a discovery, by the step-up procedure over all tokens of all texts; None if there is none.

    With M tokens tested, the k-th best is a discovery if its bound 10**-evidence is at most rate * k / M. Evidence is counted in
    steps, rounded down, so the table behind it has a bounded number of rows however many tokens there are.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    tokens = docs.select(F.explode(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))).alias("token"))
    steps = tokens.select(F.floor(evidence(F.col("token")) / EVIDENCE_STEP).cast("int").alias("step"))
    counted = steps.groupBy("step").agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit(0))
    ranks = counted.withColumn("k", F.sum("n").over(every.orderBy(F.desc("step")))).withColumn("m", F.sum("n").over(every))
    passed = ranks.filter((F.col("step") >= 0) & (F.pow(F.lit(10.0), -F.col("step") * EVIDENCE_STEP) <= rate * F.col("k") / F.col("m")))
    step = passed.agg(F.min("step")).first()[0]
    return None if step is None else step * EVIDENCE_STEP


def _joined(spans: Column) -> Column:
    names = F.array(F.lit("assign"), F.lit("access"), F.lit("hex"), F.lit("random"))
    texts = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["order"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def find_secrets(docs: DataFrame, rate: float = FALSE_DISCOVERIES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, by start and then by kind. Tokens that the battery calls random are added
    as kind ``random`` unless they overlap a base span. A null text counts as empty and has no span. Repeated rows are scanned alike;
    other columns are ignored; an empty table gives no rows.
    """
    threshold = discovery_threshold(docs, rate)
    text = F.col("text")
    texts = docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"))
    spans = texts.select("doc_id", "text", *[c.alias(n) for n, c in base_spans(text).items()])
    base = F.sort_array(F.concat("assign", "access", "hex"))
    found = spans.select("doc_id", "text", *[F.size(n).cast("long").alias(f"n_{n}") for n in base_spans(text)], base.alias("base"))
    if threshold is None:
        added = F.array().cast("array<struct<start:int,order:int,end:int,value:string>>")
    else:
        tokens = _spans(text, TOKEN, 3)
        clear = lambda t: ~F.exists(F.col("base"), lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
        added = F.filter(tokens, lambda t: clear(t) & (evidence(t["value"]) >= threshold))
    found = found.withColumn("every", F.sort_array(F.concat("base", added)))
    counts = [f"n_{n}" for n in base_spans(text)]
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("every")).alias("spans"))
