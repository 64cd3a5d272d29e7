"""Exact deduplication with radix tries that hold whole byte strings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlens.llm.shared import join_hot, lowered, one_of_each, row_key, sliced
from moodlens.session import checkpointed

#: Bytes a task's trie takes before it hands on the largest subtree.
TRIE_BYTES = 24 << 20
#: What a node takes besides its bytes: a list, a dictionary and its place in that of its parent.
NODE_BYTES = 400
#: Bytes of text in an Arrow batch that a task hands on.
BATCH_BYTES = 4 << 20


class RadixTrie:
    """Compressed trie over byte strings; the node where a string ends keeps its owner and number of rows."""

    def __init__(self, smallest: bool):
        self.better = min if smallest else max
        self.root = [b"", {}, None, 0]
        self.held: dict[int, int] = {}  # what each child of the root takes, with all below it

    def insert(self, body: bytes, owner: int | None, rows: int) -> None:
        node, at = self.root, 0
        while at < len(body):
            child = node[1].get(body[at])
            if child is None:
                child = node[1][body[at]] = [body[at:], {}, None, 0]
                self.held[body[0]] = self.held.get(body[0], 0) + len(body) - at + NODE_BYTES
                node, at = child, len(body)
                continue
            edge = child[0]
            if not body.startswith(edge, at):
                shared = _common(edge, body, at)
                middle = [edge[:shared], {edge[shared]: child}, None, 0]
                child[0] = edge[shared:]
                node[1][body[at]] = child = middle
                self.held[body[0]] += NODE_BYTES
            node, at = child, at + len(child[0])
        node[2] = owner if node[2] is None else node[2] if owner is None else self.better(node[2], owner)
        node[3] += rows

    def bytes_held(self) -> int:
        return sum(self.held.values())

    def take_largest(self) -> Iterator[tuple[bytes, int | None, int]]:
        """Remove the largest subtree below the root and yield its strings."""
        first = max(self.held, key=self.held.get)
        del self.held[first]
        yield from self._below(self.root[1].pop(first), b"")

    def take_all(self) -> Iterator[tuple[bytes, int | None, int]]:
        yield from self._below(self.root, b"")
        self.root, self.held = [b"", {}, None, 0], {}

    @staticmethod
    def _below(node: list, prefix: bytes) -> Iterator[tuple[bytes, int | None, int]]:
        stack = [(node, prefix)]
        while stack:
            (edge, children, owner, rows), prefix = stack.pop()
            prefix += edge
            if rows:
                yield prefix, owner, rows
            stack += [(child, prefix) for child in children.values()]


def _common(edge: bytes, body: bytes, at: int) -> int:
    """Length of the common prefix of ``edge`` and ``body[at:]``, by halving."""
    low, high = 0, min(len(edge), len(body) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if edge[low:middle] == body[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _batches(found: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded bytes; the first field is the text."""
    rows, held = [], 0
    for row in found:
        rows.append(row)
        held += len(row[0]) + 64
        if held >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)


def _local_terminals(smallest: bool, trie_bytes: int):
    """Task of the map side: the distinct strings of a split with owner and rows; subtrees leave as the trie gets too large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            trie = RadixTrie(smallest)
            for batch in sliced(batches):
                for owner, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    trie.insert(body, owner, 1)
                    while trie.bytes_held() > trie_bytes:
                        yield from trie.take_largest()
            yield from trie.take_all()

        yield from _batches(found(), ["body", "owner", "n"], [pa.binary(), pa.int64(), pa.int64()])

    return run


def _merged_terminals(smallest: bool):
    """Task of the reduce side: rows come sorted by length and hash, so the trie of a key is complete when the key changes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            trie, last = RadixTrie(smallest), None
            for batch in sliced(batches):
                for length, digest, body, owner, n in zip(*(c.to_pylist() for c in batch.columns)):
                    if (length, digest) != last:
                        yield from trie.take_all()
                        last = (length, digest)
                    trie.insert(body, owner, n)
            yield from trie.take_all()

        shared = ((hashlib.sha256(body).hexdigest(), owner, n) for body, owner, n in found() if n > 1)
        yield from _batches(shared, ["text_sha256", "keep_id", "group_size"], [pa.string(), pa.int64(), pa.int64()])

    return run


def trie_owners(docs: DataFrame, smallest: bool = True, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """The texts that two rows or more have, as ``text_sha256``, ``keep_id`` and ``group_size``.

    Each split inserts its lower-cased texts into a trie, which leaves one row per distinct text and so takes a hot group apart before
    the shuffle. Length and content hash deal those rows out; every partition merges them in tries again, which tell texts apart by all
    their bytes. Rows find their group by the SHA-256 of their text. A trie that outgrows ``trie_bytes`` hands its largest subtree to the shuffle.
    """
    bodies = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lowered(F.col("text")).cast("binary").alias("body"))
    local = bodies.mapInArrow(_local_terminals(smallest, trie_bytes), "body binary, owner long, n long")
    keyed = local.select(F.octet_length("body").alias("length"), F.xxhash64("body").alias("digest"), "body", "owner", "n")
    dealt = keyed.repartition("length", "digest").sortWithinPartitions("length", "digest")
    return dealt.mapInArrow(_merged_terminals(smallest), "text_sha256 string, keep_id long, group_size long")


def exact_groups(docs: DataFrame, smallest: bool = True, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. The smallest id of a group stays, or the
    largest with ``smallest=False``. A null id stays only in a group without other ids. Of rows that repeat both id and text one is
    kept. Other columns are ignored; an empty table gives no rows.
    """
    owners = checkpointed(trie_owners(docs, smallest, trie_bytes))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(lowered(F.col("text")), 256).alias("text_sha256"))
    joined = join_hot(rows, owners, ["text_sha256"], "group_size", "doc_id")
    twins = Window.partitionBy("doc_id", "text_sha256").orderBy("doc_id")
    return joined.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "text_sha256",
        F.row_number().over(twins).alias("_twin"),
    ).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_twin") == 1)).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame, smallest: bool = True) -> DataFrame:
    """``docs`` with one row of every group of equal texts, all columns unchanged.

    Rows that share both the id that stays and the text are copies of each other; any one of them stays.
    """
    owners = checkpointed(trie_owners(docs, smallest))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(lowered(docs["text"]), 256).alias("text_sha256"), row_key(docs).alias("_key"))
    found = join_hot(keyed, owners, ["text_sha256"], "group_size", "_key")
    kept = found.filter(F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return one_of_each(docs, checkpointed(kept.groupBy("_key").agg(F.count("*").alias("_n"))))
