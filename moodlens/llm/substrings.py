"""Substring deduplication: a join of 50-word blocks by hash with their smallest owners, and the union of the hits; no Lempel-Ziv parse."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.llm.shared import join_hot, maybe_in
from moodlens.session import checkpointed

#: Words of a block, and words of the grams from which the signature of a block is chosen.
BLOCK, GRAM = 50, 12
#: Odd multipliers of the block hashes.
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _runs(hashes: np.ndarray, width: int, odd: int) -> np.ndarray:
    """Hash of every run of ``width`` words, joined from runs of powers of two."""
    total, covered, power, span = None, 0, hashes, 1
    base = np.uint64(odd)
    while True:
        if width & span:
            part = power[covered:]
            if total is None:
                total = part
            else:
                n = len(hashes) - covered - span + 1
                total = total[:n] * np.uint64(pow(odd, span, 1 << 64)) + part[:n]
            covered += span
            if covered == width:
                return total
        power = power[:-span] * base + power[span:]
        base, span = np.uint64(pow(odd, 2 * span, 1 << 64)), 2 * span


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def signatures(hashes: np.ndarray, block: int, gram: int) -> np.ndarray:
    """For every block its least gram, scrambled so that the choice is fair; equal blocks have equal signatures."""
    grams = _runs(hashes, gram, ODD[1])
    grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return _least(grams ^ (grams >> np.uint64(32)), block - gram + 1)


def _scan(block: int, gram: int):
    """Task that gives every document its number of words, the digest of its words and the distinct signatures of its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, found = [], [], []
            for text in batch.column(1).to_pylist():
                words = (text or b"").split()
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                long = len(words) >= block
                found.append(np.unique(signatures(_word_hashes(words), block, gram)).view(np.int64) if long else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(digests), pa.array(found, pa.list_(pa.int64()))],
                ["doc_id", "key", "n_words", "sha", "signs"],
            )

    return run


def _blocks(block: int, gram: int):
    """Task that hashes the blocks whose signature other documents have too: twice 64 bits and the place of the first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, key, text, signs in zip(*(c.to_pylist() for c in batch.columns)):
                hashes = _word_hashes(text.split())
                if len(hashes) < block:
                    continue
                at = np.flatnonzero(np.isin(signatures(hashes, block, gram).view(np.int64), np.array(signs, np.int64)))
                x, y = (_runs(hashes, block, odd)[at].view(np.int64) for odd in ODD)
                ids = [pa.array(np.full(len(at), value, np.int64)) for value in (doc_id, key)]
                yield pa.RecordBatch.from_arrays([*ids, pa.array(at.astype(np.int32)), pa.array(x), pa.array(y)], ["doc_id", "key", "at", "x", "y"])

    return run


def factors(starts: np.ndarray, block: int) -> list[tuple[int, int]]:
    """The longest spans (first word, word after the last) of a document that indexed blocks cover.

    The parse goes from left to right: a factor begins at a block found in the index and is extended while the next block at or before
    its end is found too. As blocks are looked up at every word, also across the end of a factor, none that straddles a boundary is missed.
    """
    starts = np.unique(starts)
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > block) + 1
    return [(int(run[0]), int(run[-1]) + block) for run in np.split(starts, cuts)]


def _trim(block: int):
    """Task that removes the spans: doc_id, key, words removed, and the digest of what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, key, text, starts in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.split()
                spans = [s for s in factors(np.array(starts, np.int64), block) if s[1] <= len(words)]
                kept, at = [], 0
                for first, after in spans:
                    kept += words[at:first]
                    at = after
                kept += words[at:]
                left = b" ".join(kept)
                rows.append((doc_id, key, len(words) - len(kept), hashlib.sha256(left).hexdigest()))
            names = ["doc_id", "key", "cut", "left_sha"]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def substring_dedup(docs: DataFrame, block: int = BLOCK, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    A word goes if a block of ``block`` words around it also starts in a document with a smaller id. The steps:

    - every block has a signature, the least hash among its grams; only blocks whose signature two documents share can repeat;
    - the shared blocks are the reference index, 128-bit hash to smallest id; equal hashes are taken as equal words;
    - every document is factored against the whole index, and factors owned by smaller ids become spans.

    Whole copies are settled by their digest beforehand. A null text has no words. Rows without id are left whole and are no reference;
    rows that repeat an id are judged each by its own text, told apart by a 64-bit hash of it, and do not make each other go. Other
    columns are ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    texts = texts.withColumn("key", F.xxhash64("text"))
    base = checkpointed(texts.mapInArrow(_scan(block, gram), "doc_id long, key long, n_words long, sha string, signs array<long>"))
    long = base.filter(f"n_words >= {block} and doc_id is not null")
    firsts = long.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    rows = checkpointed(join_hot(base, checkpointed(firsts), ["sha"], "n", "doc_id").withColumn("copy", F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))))

    signed = rows.filter("not copy and doc_id is not null").select("doc_id", "key", F.explode("signs").alias("sign"))
    shared = signed.groupBy("sign").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).filter("a < b").select("sign", "n")
    shared = checkpointed(shared)
    found = join_hot(maybe_in(signed, shared, "sign"), shared, ["sign"], "n", "key").filter("n is not null")
    suspects = checkpointed(found.groupBy("doc_id", "key").agg(F.collect_set("sign").alias("signs")))
    held = checkpointed(maybe_in(texts.filter("text is not null"), suspects, "key").join(suspects, ["doc_id", "key"]))

    hashed = held.select("doc_id", "key", "text", "signs").mapInArrow(_blocks(block, gram), "doc_id long, key long, at int, x long, y long")
    blocks = checkpointed(hashed)
    index = blocks.groupBy("x", "y").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    index = checkpointed(index.filter("owner < last").select("x", "y", "owner", "n"))
    owned = join_hot(maybe_in(blocks, index, "x"), index, ["x", "y"], "n", "key").filter("owner < doc_id")
    starts = owned.groupBy("doc_id", "key").agg(F.collect_set("at").alias("starts"))
    trimmed = held.select("doc_id", "key", "text").join(starts, ["doc_id", "key"]).mapInArrow(_trim(block), "doc_id long, key long, cut long, left_sha string")
    # copies of a row, text and id, were trimmed alike
    trimmed = trimmed.dropDuplicates(["doc_id", "key"])

    nothing = hashlib.sha256(b"").hexdigest()
    whole = rows.select("doc_id", "key", "n_words", "sha", "copy").join(trimmed, ["doc_id", "key"], "left")
    return whole.select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(nothing)).otherwise(F.coalesce("left_sha", "sha")).alias("kept_sha256"),
    )
