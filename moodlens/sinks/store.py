"""Result stores with one row per key.

A store is a folder of versions. An upsert writes the next version next to the current one; Spark's ``_SUCCESS`` marker
makes it current, so readers never see half a version and a failed write leaves the old one in place. One writer at a
time is assumed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlens.schemas import RESULT_TARGETS

_VERSION = "v"


def conform(df: DataFrame, target: str | T.StructType) -> DataFrame:
    """The columns of a stored result in its order and its narrower types."""
    schema = RESULT_TARGETS[target] if isinstance(target, str) else target
    return df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema])


def _versions(spark: SparkSession, path: str) -> tuple[int, int]:
    """The current version and the highest number taken, -1 for none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return -1, -1
    current = taken = -1
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if not name.startswith(_VERSION) or not name[1:].isdigit():
            continue
        number = int(name[1:])
        taken = max(taken, number)
        if number > current and files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            current = number
    return current, taken


def _version_path(path: str, version: int) -> str:
    return f"{path}/{_VERSION}{version:08d}"


def read_store(spark: SparkSession, path: str) -> DataFrame | None:
    """The current rows of a store, None before the first write."""
    current, _ = _versions(spark, path)
    return None if current < 0 else spark.read.parquet(_version_path(path, current))


def create_targets(spark: SparkSession, base_path: str) -> None:
    """Empty typed stores for all results; those that exist stay as they are."""
    for name, schema in RESULT_TARGETS.items():
        path = f"{base_path}/{name}"
        if _versions(spark, path)[0] < 0:
            spark.createDataFrame([], schema).write.parquet(_version_path(path, _versions(spark, path)[1] + 1))


def _checked(df: DataFrame, key: str) -> DataFrame:
    """``df`` with one row per key; a missing or a repeated key fails the job that reads it."""
    values = [name for name in df.columns if name != key]
    grouped = df.groupBy(key).agg(F.count("*").alias("_n"), F.max(F.struct("*")).alias("_row"))

    def sound(column: Column) -> Column:
        return (
            F.when(F.col(key).isNull(), F.raise_error(F.lit(f"upsert without {key}")))
            .when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"repeated {key}: "), F.col(key).cast("string"))))
            .otherwise(column)
        )

    return grouped.select(sound(F.col(key)).alias(key), *[F.col(f"_row.{name}").alias(name) for name in values])


def merged(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``new`` laid over ``old`` by key: keys only in ``old`` stay, and a null new value keeps the old one."""
    sides = old.alias("old").join(_checked(new, key).alias("new"), key, "full")
    return sides.select(
        *[
            F.col(name) if name == key else F.coalesce(F.col(f"new.{name}"), F.col(f"old.{name}")).alias(name)
            for name in old.columns
        ]
    )


def upsert_parquet(df: DataFrame, path: str, key: str) -> None:
    """Insert the rows of ``df`` into the store at ``path``, or update those whose key is there."""
    spark = df.sparkSession
    current, taken = _versions(spark, path)
    if current < 0:
        rows = _checked(df, key).select(*df.columns)
    else:
        rows = merged(spark.read.parquet(_version_path(path, current)), df, key)
    rows.write.parquet(_version_path(path, taken + 1))


def upsert_connector(df: DataFrame, fmt: str, key: str, key_option: str = "es.mapping.id", **options: str) -> None:
    """The same through a connector whose store knows row ids, such as a document store's.

    ``options`` name the store and its resource, and the operation where the connector wants it spelt out.
    """
    df.write.format(fmt).mode("append").option(key_option, key).options(**options).save()
