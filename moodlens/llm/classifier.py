"""Quality classifier from weak labels: accuracies by expectation-maximisation, then a hashed linear scorer."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.llm.shared import WORD, words_of

#: Rows of the sample on which the scorer is fitted; the labellers' accuracies use all rows.
FIT_ROWS = 8000
#: Buckets of the hashed features, passes of the fit, and the decay of its weights.
BUCKETS, PASSES, DECAY = 1 << 13, 300, 1e-4
#: Score from which a document is kept.
KEEP = 0.15


def votes(text: Column) -> dict[str, Column]:
    """The heuristic labellers: 1 for good, -1 for bad, 0 for no opinion. ``text`` is not null."""
    words = F.regexp_count(text, F.lit(WORD))
    per_word = lambda pattern: F.regexp_count(text, F.lit(pattern)) / F.greatest(words, F.lit(1))
    letters = F.regexp_count(text, F.lit(r"\p{L}+"))
    capitals = F.regexp_count(text, F.lit(r"\p{Lu}\p{Lu}+"))
    vote = lambda bad, good: F.when(bad, -1).when(good, 1).otherwise(0)
    repeats = F.size(F.array_distinct(words_of(text))) < 0.25 * words
    stops = per_word(r"[\p{L}][.,;:?](?=\s|$)")
    return {
        "symbols": vote(per_word(r"[#*$%&|<>^~=]") > 0.3, F.lit(False)),
        "shouting": vote(capitals > 0.5 * F.greatest(letters, F.lit(1)), F.lit(False)),
        "exclamations": vote(per_word("!") > 0.3, F.lit(False)),
        "separators": vote(per_word(r"(?<=\s)[^\p{L}\p{N}\s]+(?=\s)") > 0.2, F.lit(False)),
        "endings": vote(per_word(r"[^\p{L}\p{N}\s.,;:?)\"'](?=\s|$)") > 0.4, F.lit(False)),
        "sentences": vote(F.lit(False), (stops > 0.03) & (stops < 0.5) & ~repeats),
        "repetition": vote(repeats, F.lit(False)),
        "letters": vote(letters < 0.5 * words, F.lit(False)),
    }


def estimate_labellers(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> tuple[float, np.ndarray]:
    """Share of good documents and, by labeller, class and vote, the chance of the vote: expectation-maximisation over vote patterns.

    It starts from the balance of votes, a bad one counting for two good ones, as most labellers know only one kind of bad text.
    """
    seen = np.array([p for p, _ in patterns]) + 1
    n = np.array([c for _, c in patterns], float)
    signed = seen - 1
    good = 1 / (1 + np.exp(-(np.where(signed > 0, 1, 0).sum(1) - 2.5 * np.where(signed < 0, 1, 0).sum(1))))
    share, chances = 0.5, np.full((seen.shape[1], 2, 3), 1 / 3)
    for _ in range(rounds):
        weights = np.stack([(1 - good) * n, good * n])
        share = (weights[1].sum() + 1) / (n.sum() + 2)
        for j in range(seen.shape[1]):
            for c in (0, 1):
                chances[j, c] = (np.bincount(seen[:, j], weights[c], 3) + 0.1) / (weights[c].sum() + 0.3)
        now = posterior(seen - 1, share, chances)
        if np.abs(now - good).max() < 1e-9:
            break
        good = now
    return share, chances


def posterior(patterns: np.ndarray, share: float, chances: np.ndarray) -> np.ndarray:
    """Chance that a document with given votes is good."""
    log = np.full((2, len(patterns)), [[math.log(1 - share)], [math.log(share)]])
    for j in range(patterns.shape[1]):
        log += np.log(chances[j][:, patterns[:, j] + 1])
    return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


_SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"a{2,}|A{2,}|0{2,}")


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text and their weights.

    The shapes of its words (letters, capitals and digits stand for their kind, runs count once) make a vector of unit length. The share
    of distinct words, in tenths, is a feature of its own.
    """
    body = text.encode()
    words = body.split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    shapes = Counter(_RUN.sub(lambda m: m[0][:1], body.translate(_SHAPE)).split())
    names = [*shapes, b"distinct %d" % (10 * len(set(words)) // len(words))]
    weight = np.sqrt(np.array(list(shapes.values()), float))
    return np.array([zlib.crc32(s) % BUCKETS for s in names]), np.append(weight / np.linalg.norm(weight), 1.0)


def fit(found: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray) -> np.ndarray:
    """Weights of the logistic scorer, the last one for the constant, by gradient steps with a momentum over hashed features."""
    rows = np.repeat(np.arange(len(found)), [len(a) for a, _ in found])
    at = np.concatenate([a for a, _ in found] or [np.empty(0, np.int64)]).astype(np.int64)
    value = np.concatenate([w for _, w in found] or [np.empty(0)])
    weights, speed = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for _ in range(PASSES):
        score = np.bincount(rows, value * weights[at], len(found)) + weights[-1]
        gap = (1 / (1 + np.exp(-score)) - targets) / max(1, len(found))
        slope = np.append(np.bincount(at, value * gap[rows], BUCKETS), gap.sum()) + DECAY * weights
        speed = 0.9 * speed - 4.0 * slope
        weights = weights + speed
    return weights


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task that turns texts into their features, a number per bucket at most, beside the votes."""
    for batch in batches:
        sums = []
        for text in batch.column(0).to_pylist():
            at, value = features(text)
            used, place = np.unique(at, return_inverse=True)
            sums.append((used, np.bincount(place, value, len(used))))
        lists = [pa.array([row[0].astype(np.int32) for row in sums], pa.list_(pa.int32())), pa.array([row[1] for row in sums], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays([*lists, *batch.columns[1:]], ["at", "value", *batch.schema.names[1:]])


def _score(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for text in batch.column(1).to_pylist():
                at, value = features(text)
                scores.append(1 / (1 + math.exp(-float(value @ weights[at] + weights[-1]))))
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array([s >= KEEP for s in scores])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "kept"])

    return run


def train(docs: DataFrame, fit_rows: int = FIT_ROWS) -> np.ndarray | None:
    """Weights of the scorer, from the votes on all rows and the hashed features of about ``fit_rows`` sampled ones; None without rows."""
    text = F.coalesce(docs["text"], F.lit(""))
    voted = votes(text)
    patterns = docs.select(*[c.alias(n) for n, c in voted.items()]).groupBy(*voted).count().collect()
    if not patterns:
        return None
    share, chances = estimate_labellers([(tuple(r[n] for n in voted), r["count"]) for r in patterns])
    rows = sum(r["count"] for r in patterns)
    sample = docs.select(text.alias("text"), *[c.alias(n) for n, c in voted.items()])
    if rows > fit_rows:
        sample = sample.sample(fraction=fit_rows / rows, seed=5)
    kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in sample.schema.fields[1:])
    taken = sample.limit(2 * fit_rows).mapInArrow(_hashed, f"at array<int>, value array<double>, {kinds}").toArrow()
    if not taken.num_rows:
        return None
    seen = np.stack([taken.column(n).to_numpy() for n in voted], 1)
    lists = (taken.column(n).to_pylist() for n in ("at", "value"))
    return fit([(np.array(at, np.int64), np.array(value, float)) for at, value in zip(*lists)], posterior(seen, share, chances))


def classify_quality(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (chance of good quality) and kept (score of at least ``KEEP``).

    All that reaches the driver is the table of vote patterns, at most three to the number of labellers, and of about ``fit_rows`` sampled
    texts a number per hash bucket they use. A null text counts as empty and gets the score of a text without features. Repeated rows score alike; other columns are
    ignored; an empty table gives no rows.
    """
    weights = train(docs, fit_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return texts.mapInArrow(_score(np.zeros(BUCKETS + 1) if weights is None else weights), "doc_id long, score double, kept boolean")
