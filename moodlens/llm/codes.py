"""Vector code compression: a codebook per part of the vectors, trained by active-entry Lloyd rounds in whole numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.llm.shared import join_hot
from moodlens.session import discard, scratch_path

#: Parts of a vector, entries of a codebook, rounds of training, steps of a component per unit.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Whole components are held within this, so that squared distances of vectors of up to 500 components stay 64-bit numbers.
LARGEST = 1 << 26
#: Below this, sums of products of up to 4,096 components are exact as doubles.
_EXACT = 1 << 20
#: Rows compared at once.
_ROWS = 4096

_STATE = "vec_id long, label string, labelled boolean, whole array<int>, codes array<int>, distances array<long>"


@dataclass(frozen=True)
class Codebooks:
    """Entries by part and position within the part, and which of them the last update moved."""

    entries: np.ndarray  # parts x entries x width, whole numbers
    moved: np.ndarray  # parts x entries

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def whole_components(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), held within ``LARGEST``."""
    return np.clip(np.floor(vectors.astype(np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int64)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the entry nearest to each point, the lower index of equals."""
    if max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0)) < _EXACT:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        distances = (p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)[None, :]
    else:
        distances = np.stack([((points - entry) ** 2).sum(axis=1) for entry in entries], axis=1)
    best = distances.argmin(axis=1)
    return best, distances[np.arange(len(points)), best].astype(np.int64)


def reassign(points: np.ndarray, entries: np.ndarray, moved: np.ndarray, codes: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries after ``moved`` ones changed, from the nearest ones and distances before.

    A part whose entry stayed where it was can only be won by an entry that moved, so it is compared with those alone; the others, whose
    entry moved, are compared with all.
    """
    codes, distances = codes.copy(), distances.copy()
    lost = moved[codes]
    if lost.any():
        codes[lost], distances[lost] = nearest(points[lost], entries)
    active = np.flatnonzero(moved)
    stayed = np.flatnonzero(~lost)
    if len(active) and len(stayed):
        place, near = nearest(points[stayed], entries[active])
        entry = active[place]
        wins = (near < distances[stayed]) | ((near == distances[stayed]) & (entry < codes[stayed]))
        codes[stayed[wins]], distances[stayed[wins]] = entry[wins], near[wins]
    return codes, distances


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1), kind))


def _assign(books: Codebooks, first: bool):
    """Task that assigns every part: from the vectors in the first round, from the state of the round before afterwards."""
    parts, _, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, _ROWS):
                batch = whole_batch.slice(at, _ROWS)
                if first:
                    points = whole_components(_matrix(batch.column(3), parts * width, np.float64))
                else:
                    points = _matrix(batch.column(3), parts * width, np.int64)
                    before, apart = _matrix(batch.column(4), parts, np.int64), _matrix(batch.column(5), parts, np.int64)
                codes, distances = np.empty((len(points), parts), np.int64), np.empty((len(points), parts), np.int64)
                for part in range(parts):
                    mine, entries = points[:, part * width : (part + 1) * width], books.entries[part]
                    found = nearest(mine, entries) if first else reassign(mine, entries, books.moved[part], before[:, part], apart[:, part])
                    codes[:, part], distances[:, part] = found
                lists = [_lists(points.astype(np.int32), pa.int32()), _lists(codes.astype(np.int32), pa.int32()), _lists(distances, pa.int64())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], ["vec_id", "label", "labelled", "whole", "codes", "distances"])

    return run


def _sum_entries(parts: int, entries: int, width: int):
    """Task that sums the components and counts the parts of every entry over its split: one row per entry in use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            points, codes = _matrix(batch.column(0), parts * width, np.int64), _matrix(batch.column(1), parts, np.int64)
            for part in range(parts):
                place = part * entries + codes[:, part]
                np.add.at(sums, place, points[:, part * width : (part + 1) * width])
                counts += np.bincount(place, minlength=parts * entries)
        used = np.flatnonzero(counts)
        # positions become rows of their own so that Spark's sum adds them up
        place, position = np.repeat(used, width), np.tile(np.arange(width), len(used))
        columns = [place.astype(np.int32), position.astype(np.int32), sums[used].reshape(-1), np.repeat(counts[used], width)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["place", "position", "total", "n"])

    return run


def update_entries(state: DataFrame, books: Codebooks) -> Codebooks:
    """Entries replaced by the floored means of their parts; unused ones stay. A number per component of the codebooks is collected."""
    parts, entries, width = books.entries.shape
    sums = state.select("whole", "codes").mapInArrow(_sum_entries(parts, entries, width), "place int, position int, total long, n long")
    found = sums.groupBy("place", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    after = books.entries.copy().reshape(parts * entries, width)
    for place, position, total, n in found:
        after[place, position] = total // n
    after = after.reshape(parts, entries, width)
    return Codebooks(after, (after != books.entries).any(axis=2))


def usable_vectors(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS) -> DataFrame:
    """vec_id, label (as text), labelled and ``vector`` as doubles of the rows that can be coded.

    Dropped are null vectors, vectors with null, infinite or NaN components, and vectors whose length is no multiple of ``parts``.
    """
    doubles = F.col(vector).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), doubles.alias("vector"))
    usable = rows.filter(F.coalesce((F.size("vector") > 0) & (F.size("vector") % parts == 0) & finite, F.lit(False)))
    return usable.select("vec_id", "label", F.col("label").isNotNull().alias("labelled"), "vector")


def train_codes(usable: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks] | None:
    """The state after training, one row per vector, and the final codebooks; None without vectors.

    Codebooks start as the vectors of the ``entries`` smallest ids (equal ids by their components), which is all that reaches the driver
    besides sums by entry. Each round writes a row per vector with its whole components, codes and distances to the shared folder.
    Only vectors as long as that of the smallest id are coded.
    """
    spark = usable.sparkSession
    least = usable.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(1).select(F.size("vector")).collect()
    if not least:
        return None
    length = least[0][0]
    same = usable.filter(F.size("vector") == length)
    seeds = same.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    start = whole_components(np.array([row[0] for row in seeds], np.float64)).reshape(len(seeds), parts, length // parts)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)), np.ones((parts, len(seeds)), bool))
    state, last = same, None
    for turn in range(rounds + 1):
        path = scratch_path(spark, "codes")
        state.mapInArrow(_assign(books, turn == 0), _STATE).write.parquet(path)
        if last:
            discard(spark, last)
        state, last = spark.read.parquet(path), path
        if turn < rounds:
            books = update_entries(state, books)
    return state, books


def vector_codes(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``vectors`` that can be coded: vec_id, codes, error, label, label_error, codebooks_sha256.

    ``codes`` are the entries' indexes by part, ``error`` the sum of the squared distances to them, ``label_error`` the sum of the errors
    of the label's rows, null labels together. Rows are dropped as ``usable_vectors`` and ``train_codes`` say. Repeated rows and null ids
    (last in order) are coded like any other; other columns are ignored; an empty table gives no rows. Labels are summed before they are
    joined, and a label that holds many rows is spread.
    """
    trained = train_codes(usable_vectors(vectors, vector, parts), parts, entries, rounds)
    if trained is None:
        nothing = "vec_id long, codes array<int>, error long, label string, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], nothing)
    state, books = trained
    error = F.aggregate("distances", F.lit(0).cast("long"), lambda total, d: total + d)
    coded = state.select("vec_id", "label", F.concat(F.col("labelled").cast("string"), F.coalesce("label", F.lit(""))).alias("_label"), "codes", error.alias("error"))
    by_label = coded.groupBy("_label").agg(F.try_sum("error").alias("label_error"), F.count("*").alias("_n"))
    joined = join_hot(coded, by_label, ["_label"], "_n", "vec_id")
    return joined.select("vec_id", "codes", "error", "label", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
