"""Cleaning, tokens and length buckets of a text column."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# What cleaning replaces by a space, and the size of a length bucket. The three branches are a mention,
# a sign followed by a space, and a spaced-out address. The POSIX class matches the same characters as 0-9A-Za-z but
# several times faster in the JVM; (?U:...) makes \w and \S cover Unicode.
MENTION_OR_SIGN = r"@\p{Alnum}+|[^\p{Alnum} \t] "
SPACED_ADDRESS = r"(?U: \w+: /  / \S+)"
ADDRESS_MARK = ": /  / "
LENGTH_BUCKET_SIZE = 10
MAX_TWEET_CHARS = 280

URL_PATTERN = r"(?U)\w+://\S+"
# whitespace that is not a single blank already
WHITESPACE_PATTERN = r"(?U) [\s\x1c-\x1f]+|[\s\x1c-\x1f&&[^ ]][\s\x1c-\x1f]*"
SENTIMENT_TOKEN_PATTERN = "[a-z]+"
SENTIMENT_GAP_PATTERN = "[^a-z]+"
INDEX_TERM_PATTERN = r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)*"


def _as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _without_signs(column: Column) -> Column:
    # looking for an address after every blank is slow, and texts that hold one are rare
    return F.when(
        F.contains(column, F.lit(ADDRESS_MARK)),
        F.regexp_replace(column, f"{MENTION_OR_SIGN}|{SPACED_ADDRESS}", " "),
    ).otherwise(F.regexp_replace(column, MENTION_OR_SIGN, " "))


def clean_text(text: Column | str, strip_urls: bool = False) -> Column:
    """Drop mentions and punctuation before a space, then collapse whitespace.

    URLs stay unless ``strip_urls`` is set.
    """
    column = _as_column(text)
    if strip_urls:
        column = F.regexp_replace(column, URL_PATTERN, " ")
    column = _without_signs(column)
    return F.trim(F.regexp_replace(column, WHITESPACE_PATTERN, " "))


# Cleaning changes the words of a text only where one of these occurs: they start a mention or a spaced-out address, or
# are signs whose lower case holds an ASCII letter. Other signs and whitespace separate words with or without cleaning.
_WORDS_NEED_CLEANING = ("@", ADDRESS_MARK, "\u212a", "\u0130")


def split_tokens(text: Column | str) -> Column:
    """The tokens of ``sentiment_tokens``, with an empty one where a text begins or ends with another sign."""
    column = _as_column(text)
    needed = reduce(or_, [F.contains(column, F.lit(part)) for part in _WORDS_NEED_CLEANING])
    cleaned = F.when(needed, _without_signs(column)).otherwise(column)
    # splitting at what is no token takes half the time of extracting the tokens
    return F.split(F.lower(cleaned), SENTIMENT_GAP_PATTERN)


def sentiment_tokens(text: Column | str) -> Column:
    """Lower-case ASCII words of the cleaned text, in order."""
    return F.array_remove(split_tokens(text), "")


def index_terms(text: Column | str) -> Column:
    """Lower-case words and numbers in any script, in order; an inner apostrophe stays."""
    return F.regexp_extract_all(F.lower(_as_column(text)), F.lit(INDEX_TERM_PATTERN), F.lit(0))


def length_bucket(text: Column | str, size: int = LENGTH_BUCKET_SIZE) -> Column:
    """Lower bound of the length bucket a text falls in, counted in characters."""
    return F.floor(F.length(_as_column(text)) / size) * size
