"""English stems by the published suffix-stripping algorithm (Porter 1980, with its two later rules), as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffix rules of steps 2 to 4 of the algorithm, in its order.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous",
    "ive", "ize",
)

STEMMED_TERM = "^[a-z]{3,}$"

# A y that counts as a consonant is written Y on the way.
_CONSONANT, _VOWEL = "[^aeiouy]", "[aeiouy]"
_HAS_VOWEL = _VOWEL
_MEASURE_1 = f"^{_CONSONANT}*{_VOWEL}+{_CONSONANT}"
_MEASURE_2 = f"{_MEASURE_1}+{_VOWEL}+{_CONSONANT}"
_SHORT_END = f"{_CONSONANT}{_VOWEL}[^aeiouywxY]$"
_DOUBLED = "(" + "|".join(c * 2 for c in "bcdfghjkmnpqrtvwx") + ")$"


def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _longest(word: Column, rules: Sequence[tuple[str, str]], measure: str) -> Column:
    """The longest suffix that fits is replaced if what stays in front of it has the measure; no other is tried."""
    result = None
    for suffix, ending in sorted(rules, key=lambda rule: -len(rule[0])):
        front = _cut(word, len(suffix))
        value = F.when(front.rlike(measure), F.concat(front, F.lit(ending))).otherwise(word)
        fits = F.endswith(word, F.lit(suffix))
        result = F.when(fits, value) if result is None else result.when(fits, value)
    return result.otherwise(word)


def _plural(word: Column) -> Column:
    ends = lambda *suffixes: word.rlike(f"({'|'.join(suffixes)})$")
    return F.when(ends("sses", "ies"), _cut(word, 2)).when(ends("s") & ~ends("ss"), _cut(word, 1)).otherwise(word)


def _past(word: Column) -> Column:
    """Without -ed or -ing; a trailing mark says that the word was cut and needs a look at its new end."""
    cut = lambda n: F.when(_cut(word, n).rlike(_HAS_VOWEL), F.concat(_cut(word, n), F.lit("+"))).otherwise(word)
    shorter = F.when(_cut(word, 3).rlike(_MEASURE_1), _cut(word, 1)).otherwise(word)
    ends = lambda suffix: F.endswith(word, F.lit(suffix))
    return F.when(ends("eed"), shorter).when(ends("ed"), cut(2)).when(ends("ing"), cut(3)).otherwise(word)


def _mended(word: Column) -> Column:
    front = _cut(word, 1)
    short = front.rlike(_MEASURE_1) & ~front.rlike(_MEASURE_2) & front.rlike(_SHORT_END)
    mended = (
        F.when(front.rlike("(at|bl|iz)$") | short, F.concat(front, F.lit("e")))
        .when(front.rlike(_DOUBLED), _cut(front, 1))
        .otherwise(front)
    )
    return F.when(F.endswith(word, F.lit("+")), mended).otherwise(word)


def _last_y(word: Column) -> Column:
    front = _cut(word, 1)
    return F.when(word.rlike("[yY]$") & front.rlike(_HAS_VOWEL), F.concat(front, F.lit("i"))).otherwise(word)


def _step_4(word: Column) -> Column:
    # -ion goes after s and t alone; otherwise it is no suffix, and no other one ends like it
    rules = [(suffix, "") for suffix in STEP_4 if suffix != "ion"]
    front = _cut(word, 3)
    ion = F.when(front.rlike("[st]$") & front.rlike(_MEASURE_2), front).otherwise(word)
    return F.when(F.endswith(word, F.lit("ion")), ion).otherwise(_longest(word, rules, _MEASURE_2))


def _last_e(word: Column) -> Column:
    front = _cut(word, 1)
    drop = front.rlike(_MEASURE_2) | (front.rlike(_MEASURE_1) & ~front.rlike(_SHORT_END))
    return F.when(F.endswith(word, F.lit("e")) & drop, front).otherwise(word)


def _last_l(word: Column) -> Column:
    return F.when(F.endswith(word, F.lit("ll")) & word.rlike(_MEASURE_2), _cut(word, 1)).otherwise(word)


_STEPS = (
    _plural,
    _past,
    _mended,
    _last_y,
    lambda word: _longest(word, STEP_2, _MEASURE_1),
    lambda word: _longest(word, STEP_3, _MEASURE_1),
    _step_4,
    _last_e,
    _last_l,
)


def stem(term: Column | str) -> Column:
    """The stem of a lower-case term.

    Terms of three or more letters a-z are stemmed; others, such as numbers, words of other scripts, words with an apostrophe and
    null, are their own stem. Every step looks at the word many times, so it is bound to a variable and not repeated in the plan.
    The work is per row: give it distinct terms.
    """
    column = F.col(term) if isinstance(term, str) else term
    words = F.array(F.regexp_replace(column, "(^|[aeiouy])y", "$1Y"))
    for step in _STEPS:
        words = F.transform(words, step)
    return F.when(column.rlike(STEMMED_TERM), F.lower(F.get(words, F.lit(0)))).otherwise(column)
