"""Helpers of the operators: inputs, word patterns, joins and ranks that stand hot keys."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodlens.session import checkpointed

# fixed values: the blanks that separate words, the word pattern, the letters that are lower-cased
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A key holding at least one part in so many of all rows is hot; there are at most so many of them.
HOT_SHARE = 1000
#: Numbers of 64 bits in the table of ``maybe_in``.
BLOOM_WORDS = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowered(text: Column) -> Column:
    """A-Z in lower case, everything else as it is, null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for a null text."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def word_count(text: Column) -> Column:
    """How many words a text has; 0 for a null text."""
    return F.size(words_of(text)).cast("long")


def sliced(batches: Iterator, rows: int = 256) -> Iterator:
    """The same Arrow rows in short batches, so that a task turns few texts at a time into Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], weight: str, spread_by: str) -> DataFrame:
    """Left join on ``keys`` (unique in ``right``) in which no hot key meets in one task.

    ``weight`` of a right row is the number of left rows it meets. The keys holding a thousandth of the weight or more are at most
    a thousand, so they are broadcast; the rows they match take part in the shuffled join under lanes made from ``spread_by``, where
    they match nothing and are spread.
    """
    values = [c for c in right.columns if c not in keys]
    total = right.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * HOT_SHARE >= F.lit(total)
    hot = right.filter(is_hot).select(*keys, *[F.col(c).alias(f"_hot_{c}") for c in values], F.lit(True).alias("_is_hot"))
    cold = right.filter(~is_hot).withColumn("_lane", F.lit(0).cast("long"))
    lane = F.when(F.col("_is_hot"), F.pmod(F.xxhash64(spread_by), F.lit(1 << 30)) + 1).otherwise(F.lit(0)).cast("long")
    joined = left.join(F.broadcast(hot), keys, "left").withColumn("_lane", lane).join(cold, [*keys, "_lane"], "left")
    merged = [F.when(F.col("_is_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in values]
    return joined.select(*left.columns, *merged)


def maybe_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The rows of ``left`` whose ``key`` may be in ``right``: all that are, and some that are not.

    The keys of ``right`` set bits in a table of ``BLOOM_WORDS`` numbers, whatever their number, and that table is broadcast. It only
    spares a following join rows; when it fills up, it spares fewer.
    """
    place = F.pmod(F.xxhash64(key), F.lit(BLOOM_WORDS * 64))
    bits = right.select(place.alias("_p")).groupBy(F.floor(F.col("_p") / 64).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_p % 64 as int))")).alias("_bits"))
    probed = left.withColumn("_at", place).withColumn("_word", F.floor(F.col("_at") / 64))
    found = probed.join(F.broadcast(bits), "_word").filter(F.expr("(shiftrightunsigned(_bits, cast(_at % 64 as int)) & 1L) = 1L"))
    return found.select(*left.columns)


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str, rows: int, rows_per_task: int = 100_000, lot: Column | None = None) -> DataFrame:
    """Add ``name``, the rank from 0 of a row among the rows of its ``keys``, by lots drawn from ``order`` or ``lot``.

    The rows of a key are dealt into buckets by a hash and numbered within them; a bucket starts where those before it end. So a key of
    any size is numbered by many tasks; there are about as many buckets as partitions, and more when the rows ask for it. ``keys`` hold no
    nulls.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, math.ceil(rows / rows_per_task), min(partitions, math.ceil(rows / 1000)))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order) if lot is None else lot, F.lit(buckets)))
    sizes = dealt.groupBy(*keys, "_bucket").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    numbered = dealt.withColumn("_place", F.row_number().over(inside) - 1)
    return numbered.join(starts, [*keys, "_bucket"]).withColumn(name, F.col("_start") + F.col("_place")).drop("_bucket", "_start", "_place")


def row_key(docs: DataFrame, *more: str) -> Column:
    """A digest of id, text (A-Z in lower case, null as empty) and the columns ``more``; rows that share it are copies in all of these."""
    parts = [docs["doc_id"].cast("string"), *[docs[name].cast("string") for name in more]]
    # a length before each part keeps the parts apart
    named = [F.when(part.isNull(), F.lit("-")).otherwise(F.concat(F.length(part).cast("string"), F.lit(":"), part)) for part in parts]
    return F.sha2(F.concat(*named, F.lit("|"), lowered(docs["text"])), 256)


def rows_with(docs: DataFrame, keys: DataFrame, *more: str) -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` is in ``keys``, as the struct ``_row`` beside the columns of ``keys``.

    ``keys`` holds every ``_key`` once, with ``_n``, the number of rows that share it.
    """
    row = F.struct(*[docs[name] for name in docs.columns])
    packed = docs.select(row.alias("_row"), row_key(docs, *more).alias("_key"), F.monotonically_increasing_id().alias("_spread"))
    return join_hot(packed, keys, ["_key"], "_n", "_spread").drop("_spread").filter("_n is not null")


def one_of_each(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """One row of ``docs`` for each ``row_key`` in ``keys``, columns unchanged; only rows that have copies are compared with each other."""
    found = rows_with(docs, keys).select("_row", "_key", "_n")
    return found.filter("_n = 1").union(found.filter("_n > 1").dropDuplicates(["_key"])).select("_row.*")


def _in_ranges(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` dealt to ranges of ``order`` and sorted within them: ``_part`` numbers the ranges, ``_at`` rises along each."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # written once, so that every task sees the same places; the upper bits of the number are the partition, the lower ones the place
    placed = checkpointed(placed.withColumn("_at", F.monotonically_increasing_id()))
    return placed.withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})


def _with_starts(placed: DataFrame, sums: list[str]) -> DataFrame:
    """Add ``_start_<name>``, the sum of each column over all ranges before; a row per range reaches the driver."""
    kinds = dict(placed.dtypes)
    starts, before = [], {name: 0.0 if kinds[name] == "double" else 0 for name in sums}
    for total in placed.groupBy("_part").agg(*[F.sum(name).alias(name) for name in sums]).orderBy("_part").collect():
        starts.append((total["_part"], *before.values()))
        before = {name: value + (total[name] or 0) for name, value in before.items()}
    schema = "_part long, " + ", ".join(f"_start_{name} {kinds[name]}" for name in sums)
    return placed.join(F.broadcast(placed.sparkSession.createDataFrame(starts, schema)), "_part")


def global_rank(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``, the rank from 1 of every row in ``order``, which must tell all rows apart.

    Rows are dealt to ranges of the order and numbered within them by many tasks; a range starts where those before it end.
    """
    placed = _with_starts(_in_ranges(rows, order).withColumn("_one", F.lit(1).cast("long")), ["_one"])
    return placed.select(*rows.columns, (F.col("_start__one") + F.col("_at") + 1).cast("long").alias(name))


def running(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Add the running totals ``sums`` (not null) of ``rows`` in ``order``, which must tell all rows apart; each includes the row itself.

    The totals run within ranges of the order, by many tasks, on top of those of the ranges before.
    """
    placed = _with_starts(_in_ranges(rows.withColumns(sums), order), list(sums))
    along = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = [(F.col(f"_start_{name}") + F.sum(name).over(along)).alias(name) for name in sums]
    return placed.select(*[name for name in rows.columns if name not in sums], *totals)
