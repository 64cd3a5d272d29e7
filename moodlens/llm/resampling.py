"""Target-distribution importance resampling: hashed n-gram gains from Arrow kernels, and a draw by perturbed scores."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.llm.shared import global_rank, sliced
from moodlens.session import checkpointed

#: Hash buckets of the features, words a drawn document has at least, percentage that is drawn, seed of the draw.
BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
# fixed value: what separates words once A-Z are lower case
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def feature_buckets(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, the buckets of all features of all texts, and the text that each feature belongs to.

    Features are the words and the runs of two words. The words are dictionary-encoded, so a run is a pair of neighbouring indices, and
    only distinct words and distinct pairs are hashed; every feature takes its bucket from them.
    """
    # the kernels that follow misread a slice whose bytes do not start where its buffer does, so its rows are copied out
    rows = texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts))))
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(rows, "")), SEPARATORS)
    words, owner = pc.list_flatten(split), pc.list_parent_indices(split).to_numpy()
    real = pc.not_equal(words, "")
    encoded = pc.dictionary_encode(words.filter(real))
    owner, index = owner[real.to_numpy(zero_copy_only=False)], encoded.indices.to_numpy().astype(np.int64)
    known = encoded.dictionary.cast(pa.large_binary()).to_pylist()
    n_words = np.bincount(owner, minlength=len(texts))
    sums = np.array([zlib.crc32(word) for word in known], np.int64)
    beside = owner[1:] == owner[:-1]
    pairs, place = np.unique(index[:-1][beside] * len(known) + index[1:][beside], return_inverse=True)
    after = [b" " + word for word in known]
    crc, size = sums.tolist(), max(1, len(known))
    pair_sums = np.array([zlib.crc32(after[pair % size], crc[pair // size]) for pair in pairs.tolist()], np.int64)
    found = np.concatenate([sums[index], pair_sums[place]]) % buckets
    return n_words, found, np.concatenate([owner, owner[1:][beside]])


def _count(buckets: int):
    """Task that counts its features by bucket: at most one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in sliced(batches):
            counts += np.bincount(feature_buckets(batch.column(0), buckets)[1], minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows of ``texts``; one number per bucket reaches the driver."""
    counted = texts.select("text").mapInArrow(_count(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.collect():
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / source share)) by bucket, both smoothed by one count."""
    buckets, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    ratios = (((t + 1) * (all_source + buckets)) / ((s + 1) * (all_target + buckets)) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """The Gumbel perturbation of a document in thousandths, drawn by its id; a null id counts as an empty text."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    drawn = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def _score(gains: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            n_words, found, owner = feature_buckets(batch.column(1), len(gains))
            n_features = np.maximum(2 * n_words - 1, 0)
            order = np.argsort(owner, kind="stable")
            used = np.flatnonzero(n_features)
            totals = np.zeros(batch.num_rows, np.int64)
            if len(used):
                starts = np.concatenate(([0], np.cumsum(n_features[used])[:-1]))
                totals[used] = np.add.reduceat(gains.take(found[order]), starts)
            weight = totals // np.maximum(n_features, 1)
            score = weight + np.array([noise(doc_id, seed) for doc_id in batch.column(0).to_pylist()], np.int64)
            columns = [pa.array(c.astype(np.int64)) for c in (n_words, n_features, weight, score)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_features", "weight", "score"])

    return run


def score_documents(docs: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row; the gains are one number per bucket."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_score(gains, seed), "doc_id long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank.

    The weight is the floored mean gain of the features, 0 without any; the score adds a perturbation drawn from the id, so the highest
    scores are a sample without replacement by importance. Of the rows with ``least_words`` words or more ``percent`` of a hundred are
    drawn by falling score, equal ones by rising id, null ids last; the others have no rank. Rows that repeat an id share its
    perturbation and are drawn as rows of their own. A null or empty text has no words. Other columns are ignored; an empty table gives no
    rows, and an empty target leaves the smoothed shares of the source alone.
    """
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = checkpointed(score_documents(docs, gains, seed))
    long_enough = F.col("n_words") >= least_words
    drawn = scored.filter(long_enough).count() * percent // 100
    numbered = scored.filter(long_enough).withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row").asc()]
    ranks = global_rank(numbered, order, "rank").drop("_row").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranks.unionByName(scored.filter(~long_enough).withColumn("rank", F.lit(None).cast("long")))
