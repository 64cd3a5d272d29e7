"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.llm.classifier import classify_quality
from moodlens.llm.codes import vector_codes
from moodlens.llm.exact import exact_groups
from moodlens.llm.extraction import extract_main_text
from moodlens.llm.licences import scan_licences
from moodlens.llm.mixing import mix
from moodlens.llm.oracle import ORACLE_SQL
from moodlens.llm.packing import pack
from moodlens.llm.quality import quality_report
from moodlens.llm.resampling import resample
from moodlens.llm.secret_scan import find_secrets
from moodlens.llm.shared import table
from moodlens.llm.simhash import near_groups
from moodlens.llm.substrings import substring_dedup
from moodlens.llm.transducer import round_trip

__all__ = ["ORACLE_SQL", "QUERIES"]

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents have no paths; source, language and the hundreds of the id stand for folders."""
    folder = F.floor(F.col("doc_id") / 100).cast("string")
    return scan_licences(table(spark, sf_dir, "documents"), F.concat_ws("/", "source", "lang", folder, F.col("doc_id").cast("string")))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), smallest=False)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        # the ids are those of a text, so what the machine reads has the bytes that they decode to
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes(table(spark, sf_dir, "embeddings"))
    digits = F.transform("codes", lambda entry: F.lpad(F.lower(F.hex(entry)), 2, "0"))
    return coded.select("vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", "codebooks_sha256")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    f.__name__: f
    for f in (
        op1_main_text,
        op2_simhash_near_dedup,
        op3_substring_dedup,
        op4_licence_scan,
        op5_quality_classifier,
        op6_best_fit_packing,
        op7_exact_dedup,
        op8_source_mixing,
        op9_quality_rules,
        op10_secret_scan,
        op11_bpe_round_trip,
        op12_vector_codes,
        op13_importance_resampling,
    )
}
