"""Importance resampling against a plain computation per document."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa

from conftest import make_docs, odd_rows
from moodlens.llm.catalog import op13_importance_resampling
from moodlens.llm.resampling import feature_buckets, global_rank, resample
from pyspark.sql import functions as F

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute_draw(docs, target):
    source = Counter(b for _, text in docs for b in features(text)[1])
    wanted = Counter(b for text in target for b in features(text)[1])
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for doc_id, text in docs:
        n, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [(*r[:4], k + 1) for k, r in enumerate(able[: 25 * len(able) // 100])]
    left = able[len(drawn) :] + [r for r in rows if r[4] < 20]
    return sorted(drawn + [(*r[:4], None) for r in left], key=repr)


def shown(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_query_is_brute_force(spark, sf_dir, documents):
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert shown(op13_importance_resampling(spark, sf_dir)) == brute_draw([(r["doc_id"], r["text"]) for r in documents.collect()], target)


def test_odd_rows(spark, odd):
    rows = odd_rows() + [(20, "A,b;c\x00d\x7fÄ日本 x1" * 30, "b"), (21, ",;. " * 50, "b")]
    # rows that repeat an id need texts of their own score to be told apart by the brute force
    target = [None, "", "w1 w2 w3 no id here", "x x x"]
    texts = spark.createDataFrame([(t,) for t in target], "text string")
    assert shown(resample(make_docs(spark, rows), texts)) == brute_draw([(i, t) for i, t, _ in rows], target)


def test_ties_go_to_smaller_ids(spark):
    rows = [(k, "same words here " * 10, "a") for k in (5, 3, 3, 9, 3, 3, 7, 1)]
    assert shown(resample(make_docs(spark, rows), spark.createDataFrame([], "text string"))) == brute_draw([(i, t) for i, t, _ in rows], [])


def test_empty(spark, empty):
    assert resample(empty, empty).collect() == []


def test_features_of_a_batch():
    texts = ["Ab ab-AB", None, "", " ", "x"]
    n_words, found, owner = feature_buckets(pa.array(texts))
    assert n_words.tolist() == [3, 0, 0, 0, 1]
    for k, text in enumerate(texts):
        assert sorted(found[owner == k].tolist()) == sorted(features(text)[1])


def test_features_of_a_slice():
    texts = [f"Ä{k} word-{k % 7} " * (k % 5) for k in range(600)]
    whole = pa.array(texts)
    for at in (0, 256, 512):
        n_words, found, owner = feature_buckets(whole.slice(at, 256))
        for k, text in enumerate(texts[at : at + 256]):
            assert n_words[k] == features(text)[0] and sorted(found[owner == k].tolist()) == sorted(features(text)[1])


def test_batches_of_many_rows(spark):
    """No text is null and a task has more rows than it turns into objects at a time."""
    rows = [(k, f"Étage {k % 11} of house-{k % 13} " * (k % 9), "a") for k in range(700)]
    docs = make_docs(spark, rows).coalesce(1)
    target = ["étage of houses", "house 3"]
    assert shown(resample(docs, spark.createDataFrame([(t,) for t in target], "text string"))) == brute_draw([(i, t) for i, t, _ in rows], target)


def test_global_rank_counts_through(spark):
    rows = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 13).alias("x"))
    ranks = global_rank(rows, [F.col("x").desc(), F.col("id").asc()], "rank").collect()
    assert [r["rank"] for r in sorted(ranks, key=lambda r: (-r["x"], r["id"]))] == list(range(1, 5001))
