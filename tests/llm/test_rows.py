"""Rows without ids, and rows that share an id, in the stages and operators; texts that a matcher cannot split."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import make_docs
from moodlens.llm.exact import drop_copies
from moodlens.llm.mixing import mix, mix_documents
from moodlens.llm.packing import TextEncoder, pack
from moodlens.llm.simhash import drop_near_copies
from moodlens.llm.substrings import substring_dedup

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def prose(seed, n=80):
    random.seed(seed)
    return " ".join(f"w{random.randrange(10**6)}" for _ in range(n))


A, B, C = prose(1), prose(2), prose(3)


def brute_substrings(rows, block=50):
    """Removed words by comparing every window of every row with those of all rows of smaller ids."""
    split = [(i, (t or "").split()) for i, t, _ in rows]
    out = []
    for doc_id, words in split:
        gone = set()
        smaller = {tuple(w[k : k + block]) for i, w in split if i is not None and doc_id is not None and i < doc_id for k in range(len(w) - block + 1)}
        for k in range(len(words) - block + 1):
            if tuple(words[k : k + block]) in smaller:
                gone.update(range(k, k + block))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [(1, A, "a"), (5, f"{A} {C}", "a"), (5, B, "a"), (5, B, "b"), (None, A, "a"), (None, B, None), (7, f"{C} {B}", "a"), (7, C, "a"), (7, C, "a"), (8, None, "a")]


def test_substrings_by_row(spark):
    found = sorted(map(tuple, substring_dedup(make_docs(spark, ROWS)).collect()), key=repr)
    assert found == brute_substrings(ROWS)


def test_exact_stage(spark):
    rows = [*ROWS, (None, A.upper(), "z"), (None, None, "z"), (None, "", "z")]
    for smallest in (True, False):
        kept = drop_copies(make_docs(spark, rows), smallest).collect()
        texts = {}
        for doc_id, text, _ in rows:
            texts.setdefault((text or "").lower(), []).append(doc_id)
        pick = min if smallest else max
        wanted = Counter((pick([i for i in ids if i is not None], default=None), text) for text, ids in texts.items())
        assert Counter((r["doc_id"], (r["text"] or "").lower()) for r in kept) == wanted


def test_near_stage(spark):
    rows = [(1, A, "a"), (None, A, "a"), (None, B, "b"), (None, B, "b"), (4, C, "a"), (4, prose(9), "a"), (9, C + " end", "a")]
    docs = make_docs(spark, rows)
    kept = drop_near_copies(docs, radius=12)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.filter("doc_id is not null").collect()) == sorted([(1, A), (4, C), (4, prose(9))])
    assert [r["text"] for r in kept.filter("doc_id is null").collect()] == [B]


@pytest.mark.parametrize("ids", [lambda k: None, lambda k: k % 3, lambda k: k])
def test_mix_stage_takes_what_the_mix_takes(spark, ids):
    rows = [(ids(k), prose(k % 40, 5 + k % 7), None if k % 5 == 0 else "abc"[k % 3]) for k in range(200)]
    docs = make_docs(spark, rows)
    wanted, mixed = Counter(), Counter()
    for r in mix(docs).collect():
        wanted[r["size"]] += r["copies"]
    out = mix_documents(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        mixed[len(r["text"].split())] += 1
    assert mixed == +wanted
    most = Counter((i, t, s) for i, t, s in rows)
    taken = Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    assert all(n <= 3 * most[row] for row, n in taken.items())


@pytest.mark.parametrize("sign", [" ", "\n", "a", "!", "é", "　"])
def test_very_long_runs(sign):
    encoder, library = TextEncoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for text in (sign * 10**6, f"word{sign * 10**6}word"):
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_pack_with_a_page_of_blanks(spark):
    rows = [(1, "word" + " " * 10**6 + "word", "a"), (2, "short", "a"), (3, None, "a")]
    found = pack(make_docs(spark, rows), TOKENIZER).collect()
    ids = len(Tokenizer.from_file(TOKENIZER).encode(rows[0][1], add_special_tokens=False).ids) + 1
    assert sum(r["length"] for r in found if r["doc_id"] == 1) == ids and len({r["doc_id"] for r in found}) == 3
