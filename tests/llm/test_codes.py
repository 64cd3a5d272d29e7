"""Vector codes against a plain Lloyd iteration."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodlens.llm.catalog import op12_vector_codes
from moodlens.llm.codes import nearest, reassign, train_codes, usable_vectors, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int, codes string, _label string, whole int"


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """Codes by a plain Lloyd iteration that compares every part with every entry in every round."""
    kept = [(i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    whole = [[math.floor(256 * x) for x in v] for _, v, _ in kept]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for v in whole[:entries]] for p in range(parts)]

    def assign():
        out = []
        for v in whole:
            found = [min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p])) for p in range(parts)]
            out.append(([k for _, k in found], sum(d for d, _ in found)))
        return out

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [cut(v, p) for v, (c, _) in zip(whole, codes) if c[p] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    codes = assign()
    sums = {}
    for (_, _, label), (_, error) in zip(kept, codes):
        sums[label] = sums.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for k in c), error, sums[label], digest) for (i, _, label), (c, error) in zip(kept, codes)), key=repr)


def coded(df):
    digits = F.transform("codes", lambda k: F.lpad(F.lower(F.hex(k)), 2, "0"))
    return sorted(map(tuple, df.select("vec_id", F.array_join(digits, ""), "error", "label_error", "codebooks_sha256").collect()), key=repr)


def make_vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", "l", 1) for i, v, label in rows], VECTORS)


def test_query_is_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op12_vector_codes(spark, sf_dir).collect()), key=repr) == brute_codes(rows)


def test_odd_rows(spark):
    """Nulls, broken components, repeated rows, ties, null labels and null ids."""
    random.seed(3)
    draw = lambda: [random.choice((-0.5, -0.25, 0.0, 0.25, 0.5)) for _ in range(32)]
    rows = [(k, draw(), k % 3 or None) for k in range(150)]
    rows += [(200, None, 1), (201, [], 1), (202, [*draw()[:31], None], 1), (203, [*draw()[:31], math.nan], 2), (204, [*draw()[:31], -math.inf], 2)]
    rows += [rows[5], rows[5], (None, draw(), 1)]
    assert coded(vector_codes(make_vectors(spark, rows))) == brute_codes(rows)


def test_other_lengths_large_components_and_few_vectors(spark):
    few = [(2, [0.5] * 16, None), (1, [-0.001] * 16, None)]
    assert coded(vector_codes(make_vectors(spark, [*few, (0, [1.0] * 15, 1), (3, [1.0] * 32, 1)]))) == brute_codes(few)
    far = [(k, [3e6 if k % 2 else -3e6] * 16, 1) for k in range(70)]
    found = vector_codes(make_vectors(spark, [*far, (99, [3e38] * 16, 1)])).collect()
    assert len(found) == 71 and {r["error"] for r in found} == {0}


def test_empty(spark):
    assert vector_codes(make_vectors(spark, [])).collect() == []
    assert vector_codes(make_vectors(spark, [(1, None, 1)])).collect() == []


def test_active_entries_find_what_a_full_comparison_finds():
    rng = np.random.default_rng(5)
    for span in (3, 40, 1 << 22):
        points, before = rng.integers(-span, span, (500, 4)), rng.integers(-span, span, (20, 4))
        codes, distances = nearest(points, before)
        moved = rng.random(20) < 0.4
        after = np.where(moved[:, None], rng.integers(-span, span, (20, 4)), before)
        got, wanted = reassign(points, after, moved, codes, distances), nearest(points, after)
        assert (got[0] == wanted[0]).all() and (got[1] == wanted[1]).all()


def test_only_moved_entries_meet_parts_that_stayed(monkeypatch):
    from moodlens.llm import codes as module

    seen = []
    plain = module.nearest
    monkeypatch.setattr(module, "nearest", lambda p, e: seen.append((len(p), len(e))) or plain(p, e))
    points, entries = np.arange(12).reshape(-1, 1), np.array([[0], [4], [8], [12]])
    codes, distances = plain(points, entries)
    moved = np.array([False, False, True, False])
    reassign(points, np.array([[0], [4], [9], [12]]), moved, codes, distances)
    assert seen == [(int((codes == 2).sum()), 4), (int((codes != 2).sum()), 1)]


def test_error_never_grows(spark, sf_dir):
    usable = usable_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    total = lambda rounds: train_codes(usable, rounds=rounds)[0].select(F.sum(F.aggregate("distances", F.lit(0).cast("long"), lambda a, d: a + d))).first()[0]
    assert total(2) <= total(0) * 1.001


@pytest.mark.parametrize("label", [None, 4])
def test_one_label_holds_all_rows(spark, label):
    rows = [(k, [k / 512.0] * 16, label) for k in range(100)]
    assert coded(vector_codes(make_vectors(spark, rows))) == brute_codes(rows)
