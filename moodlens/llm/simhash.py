"""SimHash near-deduplication by tiled exact comparison."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.llm.components import connected
from moodlens.llm.shared import join_hot, lowered, one_of_each, row_key, sliced
from moodlens.session import checkpointed

#: Words of a shingle, seed of its hash, differing bits of linked fingerprints.
SHINGLE, SEED, RADIUS = 4, 42, 4
#: Fingerprints of a tile, about.
TILE = 8192
#: Numbers in a block of the comparison, so that it stays in the processor's cache.
BLOCK = 1 << 16
#: Blocks that a fingerprint is put in at most, if the radius allows.
MOST_MASKS = 64


def fingerprint(body: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a lower-cased text as an unsigned number; 0 without words."""
    words = body.split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    first, last = starts[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            prints = np.array([fingerprint(x, shingle) for x in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints.view(np.int64))], ["doc_id", "key", "print"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """``doc_id``, ``key`` and ``print``, the fingerprint as a signed number, of every row; the key is null unless asked for."""
    key = row_key(docs) if keyed else F.lit(None).cast("string")
    bodies = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lowered(F.col("text")).cast("binary").alias("body"), key.alias("key"))
    return bodies.mapInArrow(_fingerprints(shingle), "doc_id long, key string, print long")


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """Links between the fingerprints of two tiles, as many as it takes to connect all that are within the radius.

    Both tiles are sorted by population count, and a block of one meets only those of the other whose counts are within the radius.
    Of the links found only those are kept that join parts not yet connected.
    """
    a = a[np.argsort(np.bitwise_count(a), kind="stable")]
    b = a if same else b[np.argsort(np.bitwise_count(b), kind="stable")]
    ones_a, ones_b = np.bitwise_count(a).astype(np.int64), np.bitwise_count(b).astype(np.int64)
    part = np.arange(len(a) if same else len(a) + len(b))
    shift = 0 if same else len(a)
    links = []
    step = max(1, BLOCK // max(1, len(b)))
    for at in range(0, len(a), step):
        mine_ones = ones_a[at : at + step]
        low, high = np.searchsorted(ones_b, (mine_ones[0] - radius, mine_ones[-1] + radius + 1))
        low = max(low, at) if same else low
        near = np.bitwise_count(a[at : at + step, None] ^ b[None, low:high]) <= radius
        hit = near.sum(axis=1) > (1 if same else 0)
        for i in np.flatnonzero(hit):
            found = np.flatnonzero(near[i]) + low
            mine = part[at + i]
            others = part[found + shift]
            for other in np.unique(others[others != mine]):
                j = found[np.argmax(others == other)]
                links.append((int(a[at + i]), int(b[j])))
                part[part == other] = mine
    return links


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for k in range(batch.num_rows):
                a, b = (batch.column(c)[k].values for c in (0, 1))
                a, b = (None if x is None else x.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for x in (a, b))
                links += tile_links(a, a if b is None else b, b is None, radius)
            if links:
                u, v = np.array(links, np.uint64).T.copy().view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def block_masks(n: int, radius: int, tile: int = TILE) -> list[int]:
    """Masks of which fingerprints within ``radius`` bits agree under one at least.

    Of ``radius + k`` parts of the 64 bits, ``radius`` differing bits leave ``k`` alike, so there is a mask for every choice of ``k``. With
    a larger ``k`` there are more masks of more bits each; the smallest one is taken for which ``n`` evenly spread fingerprints come to a
    tile a block, as long as there are at most ``MOST_MASKS``.
    """
    masks = [0]
    for k in range(1, 65 - radius):
        if math.comb(radius + k, k) > MOST_MASKS and k > 1:
            break
        ends = [64 * i // (radius + k) for i in range(radius + k + 1)]
        parts = [(1 << high) - (1 << low) for low, high in zip(ends, ends[1:])]
        masks = [sum(chosen) for chosen in combinations(parts, k)]
        if n <= tile << min(m.bit_count() for m in masks):
            break
    return masks


def close_pairs(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints of ``prints`` within ``radius`` bits of each other.

    Fingerprints meet only in blocks, one for each mask of ``block_masks`` and value under it; two within the radius share one. A block
    of up to ``tile`` fingerprints is a tile. A crowded one is cut by population count, and each count in chunks of about ``tile``; its
    tiles meet those whose counts differ by no more than the radius, the other tile pairs are skipped.
    """
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(prints.count(), radius, tile)]
    shared = F.explode(F.array(*[F.struct(F.lit(k).alias("part"), F.col("print").bitwiseAND(F.lit(m).cast("long")).alias("value")) for k, m in enumerate(masks)]))
    blocks = prints.select("print", F.bit_count("print").cast("int").alias("ones"), shared.alias("block")).select("print", "ones", "block.*")
    sizes = blocks.groupBy("part", "value", "ones").agg(F.count("*").alias("n"))
    chunks = F.map_from_entries(F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).cast("int").alias("chunks"))))
    crowded = sizes.groupBy("part", "value").agg(F.sum("n").alias("n"), chunks.alias("chunks")).filter(F.col("n") > tile)
    dealt = join_hot(blocks, checkpointed(crowded), ["part", "value"], "n", "print")
    cut = lambda column, whole: F.when(F.col("n").isNull(), whole).otherwise(column).cast("int")
    chunk = F.pmod(F.xxhash64("print"), F.try_element_at("chunks", F.col("ones")))
    dealt = dealt.select("part", "value", cut(F.col("ones"), -1).alias("ones"), cut(chunk, 0).alias("chunk"), "chunks", "print")
    tiles = checkpointed(dealt.groupBy("part", "value", "ones", "chunk").agg(F.collect_list("print").alias("prints"), F.first("chunks").alias("chunks")).filter("chunks is not null or size(prints) > 1"))
    alone = tiles.filter("size(prints) > 1").select(F.col("prints").alias("a"), F.lit(None).cast("array<bigint>").alias("b"))
    left = tiles.filter("chunks is not null").select("part", "value", "ones", F.col("chunk").alias("own"), F.col("prints").alias("a"), "chunks", F.explode(F.sequence(F.lit(0), F.lit(radius))).alias("step"))
    left = left.withColumn("ones", F.col("ones") + F.col("step")).withColumn("chunks", F.try_element_at("chunks", F.col("ones"))).filter("chunks is not null")
    left = left.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).filter("step > 0 or chunk > own").select("part", "value", "ones", "chunk", "a")
    met = left.join(tiles.select("part", "value", "ones", "chunk", F.col("prints").alias("b")), ["part", "value", "ones", "chunk"])
    return alone.union(met.select("a", "b")).mapInArrow(_compare(radius), "u long, v long")


def near_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links).

    Fingerprints link at ``radius`` or fewer differing bits. A text without words, null ones included, has fingerprint zero and links
    like any other; repeated rows share a component. A null id is never the smallest, unless its component has no other. Other columns
    are ignored; an empty table gives no rows.
    """
    rows = checkpointed(fingerprints(docs, shingle))
    classes = _classes(rows, radius, tile).select("print", "component_id", "n")
    found = join_hot(rows, checkpointed(classes), ["print"], "n", "doc_id")
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def _classes(rows: DataFrame, radius: int, tile: int) -> DataFrame:
    """For every distinct fingerprint of ``rows`` (doc_id, key, print): n, root, component_id and, of the component's smallest id, least_key."""
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    prints = checkpointed(rows.groupBy("print").agg(F.min(first).alias("least"), F.count("*").alias("n")))
    linked = connected(close_pairs(prints.select("print"), radius, tile))
    roots = linked.select(F.col("root").alias("node"), "root").distinct()
    members = checkpointed(prints.join(linked.union(roots).withColumnRenamed("node", "print"), "print", "left").select("print", "n", "least", F.coalesce("root", "print").alias("root")))
    groups = members.groupBy("root").agg(F.min("least").alias("least"), F.count("*").alias("members"))
    groups = groups.select("root", F.col("least.doc_id").alias("component_id"), F.col("least.key").alias("least_key"), "members")
    return join_hot(members.select("print", "n", "root"), checkpointed(groups), ["root"], "members", "print")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of every component, all columns unchanged.

    The row with the smallest id stays; null ids come last, and rows that share the id go by a digest of id and text. Of rows that repeat
    both any one stays.
    """
    rows = checkpointed(fingerprints(docs, shingle, keyed=True))
    kept = _classes(rows, radius, TILE).select(F.col("least_key").alias("key")).distinct()
    copies = rows.join(kept, "key", "left_semi").groupBy("key").agg(F.count("*").alias("_n"))
    return one_of_each(docs, checkpointed(copies.withColumnRenamed("key", "_key")))
