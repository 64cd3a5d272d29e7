"""Sentiment polarity as one stateless expression over a lexicon."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.functions.text import SENTIMENT_TOKEN_PATTERN, split_tokens
from moodlens.session import checkpointed

#: Bytes that the slot table of a lexicon may take, some eight million terms. It goes to every executor with the plan, so
#: this bounds what each of them holds; a larger lexicon is joined.
MAX_TABLE_BYTES = 256 << 20
# what an entry takes besides its term: its polarity, two places and its share of a slot
_BYTES_PER_ENTRY = 64
_TERMS_PER_SLOT = 2


@dataclass(frozen=True)
class SlotTable:
    """Terms grouped by the slot their hash falls in: one row whose ``table`` holds a map of terms for each of ``slots``."""

    slots: int
    row: DataFrame


def usable_terms(lexicon: DataFrame) -> DataFrame:
    """``term`` in lower case, each once, with the mean of its polarities. Needs ``check_lexicon``."""
    return lexicon.groupBy(F.lower("term").alias("term")).agg(F.avg(F.col("polarity").cast("double")).alias("polarity"))


def check_lexicon(lexicon: DataFrame) -> tuple[int, int]:
    """Bytes and rows that the terms take as a slot table, from one pass; a row that is no use is an error at any size.

    That is a row without term or polarity, with a polarity outside [-1, 1], or with a term that no token can equal.
    """
    term, value = F.lower("term"), F.col("polarity").cast("double")
    fits = term.rlike(f"^(?:{SENTIMENT_TOKEN_PATTERN})$") & value.between(-1.0, 1.0)
    wrong = F.when(~F.coalesce(fits, F.lit(False)), F.struct(F.col("term"), value.alias("polarity")))
    size, rows, first, n = lexicon.agg(
        F.sum(F.octet_length(term) + _BYTES_PER_ENTRY), F.count("*"), F.first(wrong, ignorenulls=True), F.count(wrong)
    ).first()
    if n:
        raise ValueError(f"{n} lexicon rows are out of range, such as {first['term']!r}, {first['polarity']!r}")
    return size or 0, rows


def _slot(term: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(slots)).cast("int")


def slot_table(lexicon: DataFrame, max_bytes: int = MAX_TABLE_BYTES, checked: tuple[int, int] | None = None) -> SlotTable | None:
    """The slot table of a lexicon that takes at most ``max_bytes``; None for a larger one. ``checked`` is what ``check_lexicon`` found.

    Spark groups the terms by slot and puts the slots in order; the table is written once to the shared folder, so every
    plan and every micro-batch that scores reads that one row.
    """
    size, rows = checked or check_lexicon(lexicon)
    if size > max_bytes:
        return None
    slots = max(1, rows // _TERMS_PER_SLOT)
    terms = usable_terms(lexicon).select(_slot(F.col("term"), slots).alias("slot"), F.struct("term", "polarity").alias("entry"))
    filled = terms.groupBy("slot").agg(F.collect_list("entry").alias("entries"))
    every = lexicon.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot")).join(filled, "slot", "left")
    nothing = F.array().cast("array<struct<term:string,polarity:double>>")
    ordered = F.array_sort(F.collect_list(F.struct("slot", F.coalesce("entries", nothing).alias("entries"))))
    row = every.agg(ordered.alias("slots")).select(F.transform("slots", lambda slot: F.map_from_entries(slot["entries"])).alias("table"))
    return SlotTable(slots, checkpointed(row))


def polarity(text: Column | str, table: Column | str, slots: int) -> Column:
    """Mean polarity of the known terms of a text, 0.0 when there are none; ``table`` is that of a ``SlotTable`` with ``slots``.

    Needs no shuffle and no state, so it works on streams as well. A token is looked up in its slot, so the cost does not grow
    with the lexicon.
    """
    known = F.col(table) if isinstance(table, str) else table
    found = F.transform(split_tokens(text), lambda token: F.try_element_at(F.get(known, _slot(token, slots)), token))
    # an array of one array names the polarities found, so that they are looked up once for both sum and number
    mean = F.transform(
        F.array(F.filter(found, lambda value: value.isNotNull())),
        lambda values: F.try_divide(F.aggregate(values, F.lit(0.0), lambda total, value: total + value), F.size(values)),
    )
    return F.coalesce(F.get(mean, F.lit(0)), F.lit(0.0))
