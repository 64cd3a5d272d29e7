"""Best-fit packing of token pieces by exact complements of their lengths."""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from moodlens.llm.shared import ranked, sliced
from moodlens.session import checkpointed

#: Tokens a sequence holds, and the id that ends a document.
CAPACITY, END_ID = 1024, 2
#: Texts with a run of so many blanks go to ``tokenizers``, as the matcher of ``tiktoken`` takes stack for every blank.
BLANK_RUN = 10_000
_BLANK_RUN = re.compile(r"\s{%d}" % BLANK_RUN)
# fixed value: how byte-level vocabularies split a text before merging
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: printable Latin-1 signs for themselves, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class TextEncoder:
    """Ids of texts as the library ``tokenizers`` gives them for the file at ``path``.

    A byte-level vocabulary whose ids rise in the order of its merges is run by ``tiktoken``, which gives the same ids several times
    faster; any other one, and every text that ``tiktoken`` cannot split, by ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.known = json.load(file)
        self.path, self.tokenizer, self.fast = path, None, self._fast()
        del self.known

    def encode(self, text: str) -> list[int]:
        if self.fast and not (len(text) >= BLANK_RUN and _BLANK_RUN.search(text)):
            try:
                return self.fast(text)
            except ValueError:
                pass  # its matcher ran out of stack
        if self.tokenizer is None:
            self.tokenizer = Tokenizer.from_file(self.path)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _fast(self):
        model, split = self.known["model"], self.known["pre_tokenizer"]
        simple = model["type"] == "BPE" and not model.get("dropout") and not self.known["normalizer"] and split and split["type"] == "ByteLevel"
        if not simple or split["add_prefix_space"] or not split.get("use_regex", True):
            return None
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != list(range(256, 256 + len(merged))):
            return None
        signs = _byte_signs()
        special = {t["content"]: t["id"] for t in self.known["added_tokens"]}
        ranks = {bytes(signs[c] for c in token): n for token, n in model["vocab"].items() if token not in special}
        encoding = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: encoding.encode(text, allowed_special="all")

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return np.array(self.encode(text), "<u4").tobytes()


def _cut(tokenizer: str, capacity: int, with_ids: bool):
    """Task that encodes documents and cuts those longer than a sequence; only the first piece of one may be shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(tokenizer)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in sliced(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.ids(text or "") + END_ID.to_bytes(4, "little")
                total = len(ids) // 4
                start, piece = 0, 0
                while start < total:
                    length = (total - start) % capacity or min(capacity, total)
                    body = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(body), body if with_ids else None))
                    start, piece = start + length, piece + 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of the documents: doc_id, piece, start, length, ids_crc32, ids (null unless ``with_ids``)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_cut(tokenizer, capacity, with_ids), "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences follow each, from the number of pieces of every length.

    Pieces are first combined with exact complements, then the rest is packed by best fit. Combinations use up short pieces that best
    fit could have used, which tells when pieces are few; so triples, or pairs and triples, are left out where that takes fewer
    sequences. The work depends on the capacity alone, as pieces of one length are planned together.
    """
    plans = (_complement_plan(counts, capacity, depth) for depth in (3, 2, 1))
    return sorted(min(plans, key=lambda plan: sum(plan.values())).items())


def _complement_plan(counts: dict[int, int], capacity: int, depth: int) -> dict[tuple[int, ...], int]:
    """A plan with complements of up to ``depth`` pieces.

    For single lengths, then pairs, then triples, lengths are taken from the longest down: the gap that a piece leaves is looked up
    among the sums, and what fills it exactly is used as often as the counts allow.
    """
    left = {k: n for k, n in counts.items() if n > 0}
    plan: dict[tuple[int, ...], int] = defaultdict(int)
    if left.get(capacity):
        plan[(capacity,)] = left.pop(capacity)
    sums: dict[int, list[tuple[int, int]]] = {}

    def use(*pattern: int) -> None:
        need = {k: pattern.count(k) for k in set(pattern)}
        times = min(left.get(k, 0) // n for k, n in need.items())
        if times:
            plan[pattern] += times
            for k, n in need.items():
                left[k] -= times * n

    def with_single(size: int) -> None:
        use(size, capacity - size)

    def with_pair(size: int) -> None:
        for a, b in sums.get(capacity - size, ()):
            if not left[size]:
                break
            use(size, a, b)

    def with_triple(size: int) -> None:
        for a in sorted(k for k, n in left.items() if n and k < capacity - size):
            for b, c in sums.get(capacity - size - a, ()):
                if not left[size]:
                    return
                if not left[a]:
                    break
                use(size, a, b, c)

    for fill in (with_single, with_pair, with_triple)[:depth]:
        sums = {} if fill is with_single else _sums_of_two({k: n for k, n in left.items() if n}, capacity)
        for size in sorted(left, reverse=True):
            if left[size]:
                fill(size)
    for pattern, times in _best_fit({k: n for k, n in left.items() if n}, capacity):
        plan[pattern] += times
    return plan


def _sums_of_two(left: dict[int, int], capacity: int) -> dict[int, list[tuple[int, int]]]:
    """For every sum, the pairs of lengths that make it, the most even first."""
    sums: dict[int, list[tuple[int, int]]] = defaultdict(list)
    sizes = sorted(left)
    for i, a in enumerate(sizes):
        for b in reversed(sizes[: i + 1]):
            if a + b < capacity:
                sums[a + b].append((a, b))
    return sums


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit by falling length; sequences with the same content are kept as one pattern with a count."""
    open_bins: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # by gap

    def put(gap: int, pattern: tuple[int, ...], times: int) -> None:
        if times:
            open_bins[gap][pattern] = open_bins[gap].get(pattern, 0) + times

    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            gap = min((g for g in open_bins if g >= size), default=None)
            if gap is None:
                each = capacity // size
                put(capacity - each * size, (size,) * each, n // each)
                rest = n % each
                put(capacity - rest * size, (size,) * rest, 1 if rest else 0)
                break
            pattern, times = next(iter(open_bins[gap].items()))
            times_used = min(times, n)
            del open_bins[gap][pattern]
            put(gap, pattern, times - times_used)
            if not open_bins[gap]:
                del open_bins[gap]
            put(gap - size, (*pattern, size), times_used)
            n -= times_used
    return [(p, n) for patterns in open_bins.values() for p, n in patterns.items()]


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For every length the runs of its pieces: first rank of the run, first sequence of the run, offset in the sequence."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for size in pattern:
            runs[size].append((used[size], sequence, offset))
            used[size] += times
            offset += size
        sequence += times
    return {size: tuple(np.array(c, np.int64) for c in zip(*found)) for size, found in runs.items()}


def _place(slots: dict[int, tuple[np.ndarray, ...]]):
    """Task that looks up sequence and offset of a piece by its length and its rank among pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for size in np.unique(lengths):
                mine = lengths == size
                first_rank, first_sequence, at = slots[int(size)]
                found = np.searchsorted(first_rank, ranks[mine], side="right") - 1
                sequence[mine] = first_sequence[found] + ranks[mine] - first_rank[found]
                offset[mine] = at[found]
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for.

    A null text counts as empty and gives one piece with the end id alone. Repeated rows are packed each. Other columns are ignored; an
    empty table gives no rows. The plan is made from the number of pieces of each length, ``capacity`` numbers at most, which is all that
    reaches the driver; pieces are ranked by length by many tasks and look up their places.
    """
    pieces = checkpointed(cut_pieces(docs, tokenizer, capacity, with_ids))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = _slots(plan_packing(counts, capacity))
    placed = ranked(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "rank", sum(counts.values()))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, " + "ids binary, " * with_ids + "sequence_id long, offset long"
    return placed.select(*columns, F.col("rank").cast("long").alias("rank")).mapInArrow(_place(slots), schema)
