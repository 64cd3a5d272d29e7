"""Mixing and packing against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import make_docs
from pyspark.sql import functions as F

from moodlens.llm.mixing import mix, mix_documents, source_targets
from moodlens.llm.packing import TextEncoder, pack, plan_packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# mixing


def targets(sizes):
    """Shares of the sources (code point order, null last) by repeated resharing."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = sum(w for s, w in weight.items() if s not in stopped)
        rest = total - sum(3 * sizes[s] for s in stopped)
        out = {s: 3.0 * sizes[s] if s in stopped else rest * weight[s] / free for s in sizes}
        above = {s for s in sizes if s not in stopped and out[s] > 3 * sizes[s]}
        if not above:
            return out
        stopped |= above


def check_mix(docs):
    got = mix(docs).collect()
    words = Counter((r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in docs.select("doc_id", "source", "text").collect())
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == words
    sizes, taken, least = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        if r["size"]:
            least[r["source"]] = min(r["size"], least.get(r["source"], r["size"]))
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
    want = targets(dict(sizes))
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
    return sizes, taken, want, least


def test_mix_of_documents(documents):
    _, taken, want, least = check_mix(documents)
    for s in want:
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], least[s])
    again = {(r["doc_id"], r["taken"]) for r in mix(documents).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in mix(documents).collect()}


def test_mix_with_sources_that_stop(spark):
    random.seed(5)
    rows = [(k, "w " * random.randrange(1, 40), random.choice("aab")) for k in range(200)] + [(1000 + k, "x y z", "c") for k in range(6)] + [(2000, "q " * 9, None)]
    sizes, taken, want, _ = check_mix(make_docs(spark, rows))
    assert want["c"] == 3 * sizes["c"] == taken["c"]
    assert abs(taken["a"] - want["a"]) <= 0.02 * want["a"]


def test_mix_of_odd_rows(odd, empty):
    check_mix(odd)
    assert mix(empty).count() == 0 and mix_documents(empty).count() == 0


def test_mixed_documents_repeat(documents):
    mixed = mix_documents(documents)
    assert mixed.columns == documents.columns
    want = {r["doc_id"]: r["copies"] for r in mix(documents).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == Counter(want)


# packing


def check_pack(docs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = pack(docs, TOKENIZER).collect()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        cuts = sorted({0, *range(len(ids) % 1024, len(ids), 1024)} - {len(ids)})
        for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)])):
            want[(r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values(), default=0) <= 1024
    return len(ends), sum(ends.values())


def test_pack_documents(documents):
    sequences, tokens = check_pack(documents)
    assert sequences <= 1.03 * math.ceil(tokens / 1024) + 1


def test_pack_odd_rows(odd, empty):
    check_pack(odd)
    assert pack(empty, TOKENIZER).count() == 0


def test_ids_come_along(documents):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    few = documents.filter("doc_id < 20")
    found = {}
    for r in sorted(pack(few, TOKENIZER, with_ids=True).collect(), key=lambda r: r["piece"]):
        found.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert found == {r["doc_id"]: tokenizer.encode(r["text"], add_special_tokens=False).ids + [2] for r in few.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_ids_are_those_of_tokenizers(seed):
    random.seed(seed)
    encoder, tokenizer = TextEncoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for _ in range(300):
        text = "".join(random.choices([" ", "  ", "\n", "\t", " ", "　", "a", "don't", "é", "12", "!?", "'s", "word", "\r\n", "<|endoftext|>"], k=random.randrange(25)))
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_every_kind_of_sign():
    encoder, tokenizer = TextEncoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    signs = [chr(c) for c in range(1, 0x3000, 7) if not 0xD800 <= c < 0xE000] + ["\u0085", "\u00a0", "\u2028", "\u3000", "\u180e", "\u200b", "😀", "中", "٣", "Ⅷ"]
    for c in signs:
        text = f"a{c}b 1{c}2 {c}{c} x  {c}'s"
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, hex(ord(c))


def test_other_vocabularies_run_as_they_are():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert np.frombuffer(TextEncoder(path).ids("Hello there"), "<u4").tolist() == Tokenizer.from_file(path).encode("Hello there", add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_plans_use_every_piece_once(seed):
    random.seed(seed)
    counts = Counter(random.choices(range(1, 65), weights=[random.random() for _ in range(64)], k=random.choice([5, 60, 3000])))
    plan = plan_packing(dict(counts), 64)
    used = Counter()
    for pattern, times in plan:
        assert sum(pattern) <= 64 and times > 0
        for size in pattern:
            used[size] += times
    assert used == counts
    tokens = sum(k * n for k, n in counts.items())
    assert sum(n for _, n in plan) <= 1.25 * math.ceil(tokens / 64) + 1


def test_exact_complements_are_used():
    assert sorted(plan_packing({60: 2, 4: 2, 40: 1, 20: 1, 30: 1, 16: 1, 10: 1, 8: 1}, 64)) == sorted([((60, 4), 2), ((40, 16, 8), 1), ((30, 20, 10), 1)])


def test_targets_of_many_sources(spark):
    """Targets by water filling over ranges of the sources equal a plain loop."""
    random.seed(6)
    sizes = [random.choice((0, 1, 5, 40, 1000)) + random.random() for _ in range(3000)]
    weights = [1 + k % 3 for k in range(3000)]
    rows = spark.createDataFrame([(k, float(s)) for k, s in enumerate(sizes)], "place long, source_size double")
    found = source_targets(rows, F.pmod(F.col("place"), F.lit(3)) + 1)
    open_, left, wanted = set(range(3000)), sum(sizes), {}
    while True:
        level = left / sum(weights[k] for k in open_)
        full = {k for k in open_ if level * weights[k] > 3 * sizes[k]}
        if not full:
            break
        for k in full:
            wanted[k] = 3 * sizes[k]
        left -= sum(wanted[k] for k in full)
        open_ -= full
    wanted |= {k: level * weights[k] for k in open_}
    got = {r["place"]: r["target"] for r in found.collect()}
    assert all(abs(got[k] - wanted[k]) <= 1e-6 * max(1, wanted[k]) for k in wanted) and len(got) == 3000
