"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
import re
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from conftest import make_docs, odd_rows  # noqa: F401
from moodlens.llm.components import connected
from moodlens.llm.exact import RadixTrie, drop_copies, exact_groups
from moodlens.llm.simhash import block_masks, close_pairs, drop_near_copies, near_groups, tile_links
from moodlens.llm.substrings import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def pairs(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.select(*columns).collect()]


# exact


def expected_exact(rows, largest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    best = {k: (max if largest else min)([i for i in v if i is not None], default=None) for k, v in groups.items()}
    return Counter((i, best[k], len(v), hashlib.sha256(k.encode()).hexdigest()) for k, v in groups.items() for i in v), len(groups)


@pytest.mark.parametrize("smallest", [True, False])
@pytest.mark.parametrize("trie_bytes", [48 << 20, 200])
def test_exact_groups(odd, smallest, trie_bytes):
    want, groups = expected_exact(pairs(odd, "doc_id", "text"), not smallest)
    got = exact_groups(odd, smallest, trie_bytes)
    assert Counter(pairs(got, "doc_id", "keep_id", "group_size", "text_sha256")) == want
    assert got.filter("kept").count() == groups
    assert got.filter("kept and not doc_id <=> keep_id").isEmpty()


def test_exact_groups_of_documents(documents):
    want, groups = expected_exact(pairs(documents, "doc_id", "text"), True)
    got = exact_groups(documents, smallest=False)
    assert Counter(pairs(got, "doc_id", "keep_id", "group_size", "text_sha256")) == want
    assert got.filter("kept").count() == groups


def test_drop_copies_keeps_columns_and_one_row_each(odd, empty):
    left = drop_copies(odd, smallest=False)
    assert left.columns == odd.columns
    texts = [(t or "").translate(LOWER) for (t,) in pairs(left, "text")]
    assert len(texts) == len(set(texts)) == len({(t or "").translate(LOWER) for (t,) in pairs(odd, "text")})
    assert drop_copies(empty).count() == 0 and exact_groups(empty).count() == 0


def test_a_hot_group_is_joined_whole(spark):
    rows = [(i, "the same text", "s") for i in range(3000)] + [(10_000 + i, f"text {i}", "s") for i in range(3000)]
    got = exact_groups(make_docs(spark, rows), smallest=False)
    assert got.filter("keep_id = 2999 and group_size = 3000").count() == 3000
    assert got.filter("kept").count() == 3001


def test_trie_counts_its_nodes():
    """Short texts take more for their nodes than for their bytes."""
    trie = RadixTrie(smallest=True)
    for k in range(1000):
        trie.insert(b"%03d" % k, k, 1)
    assert trie.bytes_held() > 1000 * 200
    list(trie.take_largest())
    assert trie.bytes_held() < 1000 * 450


def test_trie_against_a_dictionary():
    random.seed(2)
    trie, want = RadixTrie(smallest=True), {}
    for k in range(4000):
        body = bytes(random.choices(b"ab", k=random.randrange(12)))
        trie.insert(body, k, 1)
        owner, n = want.get(body, (k, 0))
        want[body] = (owner, n + 1)
    part = list(trie.take_largest())
    rest = list(trie.take_all())
    assert {b: (o, n) for b, o, n in part + rest} == want and len(part) + len(rest) == len(want)


# near


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def expected_near(rows):
    prints = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, f"{prints[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("tile", [3, 8192])
def test_near_groups(odd, tile):
    rows = [(i, t) for i, t in pairs(odd, "doc_id", "text")]
    assert Counter(tuple(r) for r in near_groups(odd, tile=tile).collect()) == expected_near(rows)


def test_near_groups_of_documents(documents):
    assert Counter(tuple(r) for r in near_groups(documents).collect()) == expected_near(pairs(documents, "doc_id", "text"))


def test_drop_near_copies(odd, empty):
    left = drop_near_copies(odd)
    assert left.columns == odd.columns
    ids = {c for (_, _, c) in expected_near(pairs(odd, "doc_id", "text"))}
    assert {i for (i,) in pairs(left, "doc_id")} == ids
    assert drop_near_copies(empty).count() == 0 and near_groups(empty).count() == 0


def test_tiles_link_what_is_close():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    a = np.unique(np.concatenate([a, a ^ np.uint64(5), a ^ np.uint64(1 << 40)]))
    for same, b in ((True, a), (False, np.unique(a ^ np.uint64(3)))):
        links = tile_links(a, b, same, 4)
        nodes = [("a", int(x)) for x in a] + [("a" if same else "b", int(x)) for x in b]
        parent = {n: n for n in nodes}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for x, y in links:
            assert bin(x ^ y).count("1") <= 4
            parent[find(("a", x))] = find(("a" if same else "b", y))
        for x in a:
            for y in b:
                if bin(int(x ^ y)).count("1") <= 4:
                    assert find(("a", int(x))) == find(("a" if same else "b", int(y)))


@pytest.mark.parametrize("n, radius", [(0, 4), (10**5, 4), (10**8, 4), (10**11, 4), (100, 0), (10**9, 14), (5, 63), (5, 64)])
def test_close_fingerprints_share_a_block(n, radius):
    random.seed(8)
    masks = block_masks(n, radius)
    for _ in range(300):
        x = y = random.getrandbits(64)
        for bit in random.sample(range(64), radius):
            y ^= 1 << bit
        assert any((x ^ y) & m == 0 for m in masks)


@pytest.mark.parametrize("radius, tile", [(4, 8192), (4, 24), (0, 24), (14, 100)])
def test_crowded_blocks_lose_no_link(spark, radius, tile):
    random.seed(9)
    prints = {random.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1}
    for _ in range(3):  # groups around one fingerprint, far more than a tile holds
        centre = random.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in random.sample(range(64), random.randrange(9))) for _ in range(150)}
    prints = sorted(prints)
    signed = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def groups():
        found = defaultdict(set)
        for p in prints:
            found[find(p)].add(p)
        return sorted(map(sorted, found.values()))

    for r in close_pairs(signed, radius, tile).collect():
        x, y = r["u"] % (1 << 64), r["v"] % (1 << 64)
        assert (x ^ y).bit_count() <= radius
        parent[find(x)] = find(y)
    got = groups()
    parent = {p: p for p in prints}
    for x in prints:
        for y in prints:
            if (x ^ y).bit_count() <= radius:
                parent[find(x)] = find(y)
    assert got == groups()


def test_connected_finds_long_chains(spark):
    random.seed(6)
    order = random.sample(range(300), 300)
    links = [(order[i], order[i + 1]) for i in range(299) if i % 50 != 49] + [(1000, 1000)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(links, "u long, v long")).collect()}
    for k in range(6):
        part = order[50 * k : 50 * k + 50]
        assert {n: got[n] for n in part if n != min(part)} == {n: min(part) for n in part if n != min(part)}


# substrings


def expected_spans(rows):
    owner = {}
    for d, t in rows:
        words = WORD.findall(t or "")
        for i in range(len(words) - 49):
            key = tuple(words[i : i + 50])
            if d is not None:
                owner[key] = min(d, owner.get(key, d))
    out = Counter()
    for d, t in rows:
        words = WORD.findall(t or "")
        gone = set()
        for i in range(len(words) - 49):
            if d is not None and owner[tuple(words[i : i + 50])] < d:
                gone.update(range(i, i + 50))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[(d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def test_substring_dedup_on_odd_rows(odd, empty):
    rows = [(i, t) for i, t in pairs(odd, "doc_id", "text")]
    assert Counter(tuple(r) for r in substring_dedup(odd).collect()) == expected_spans(rows)
    assert substring_dedup(empty).count() == 0


def test_substring_dedup_on_stitched_passages(spark):
    random.seed(8)
    fresh = lambda n: " ".join(f"v{random.randrange(4000)}" for _ in range(n))
    passages = [fresh(n) for n in (49, 50, 51, 75, 100, 260)]
    rows = []
    for i in range(120):
        parts = [random.choice(passages) if random.random() < 0.5 else fresh(random.randrange(1, 70)) for _ in range(random.randrange(1, 6))]
        piece = random.choice(passages).split()
        at = random.randrange(len(piece))
        parts.insert(random.randrange(len(parts) + 1), " ".join(piece[at : at + random.randrange(20, 90)]))
        rows.append((i, random.choice([" ", "\n", "\t "]).join(parts), "s"))
    docs = make_docs(spark, rows)
    assert Counter(tuple(r) for r in substring_dedup(docs).collect()) == expected_spans([r[:2] for r in rows])
