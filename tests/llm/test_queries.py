"""The registered queries of the operators against their SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from moodlens.llm.catalog import ORACLE_SQL, QUERIES
from moodlens.llm.mixing import mix
from moodlens.llm.quality import quality_report
from moodlens.llm.simhash import near_groups
from oracle import compare, connect


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE_SQL])
def test_query_gives_a_row_for_every_row(spark, sf_dir, name):
    source = "pages" if name.startswith("op1_") else "embeddings" if name.startswith("op12_") else "documents"
    rows = spark.read.parquet(f"{sf_dir}/{source}.parquet").count()
    found = QUERIES[name](spark, sf_dir).count()
    assert found >= rows if name.startswith("op6_") else found == rows


def test_stages_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "near_dedup", "mix_sources", "pack_sequences"]
    good = corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)
    ids = {r["doc_id"] for r in good.collect()}
    assert ids == {r["doc_id"] for r in quality_report(docs).filter("kept").collect()}
    single = corpus_pipeline.STAGES[1][1](spark, good, sf_dir)
    texts = [r["text"].lower() for r in single.collect()]
    assert len(texts) == len(set(texts)) == len({r["text"].lower() for r in good.collect()})
    apart = corpus_pipeline.STAGES[2][1](spark, single, sf_dir)
    assert {r["doc_id"] for r in apart.collect()} == {r["component_id"] for r in near_groups(single).collect()}
    mixed = corpus_pipeline.STAGES[3][1](spark, apart, sf_dir)
    assert mixed.count() == sum(r["copies"] for r in mix(apart).collect())
    assert good.columns == single.columns == apart.columns == mixed.columns == docs.columns
    packed = corpus_pipeline.STAGES[4][1](spark, mixed, sf_dir)
    whole = corpus_pipeline.run(spark, sf_dir)
    key = lambda df: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(packed) == key(whole)
