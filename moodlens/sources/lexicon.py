"""The polarity lexicon."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.schemas import LEXICON


def load_lexicon(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A table of ``term`` and ``polarity`` in [-1, 1]; terms are matched in lower case."""
    table = spark.read.format(fmt).schema(LEXICON).options(**options).load(path)
    return table.select(F.lower("term").alias("term"), "polarity")
