"""Region polygons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodlens.schemas import REGION

# The attributes that hold a region's name and code.
NAME_ATTRIBUTE = "State_Name"
CODE_ATTRIBUTE = "State_Code"


def load_regions(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Regions as one row per ring vertex, from a table of that form or from GeoJSON features (``fmt="geojson"``)."""
    if fmt == "geojson":
        return regions_from_geojson(_numbered_lines(spark.read.text(path)), ordinal=F.col("ordinal"))
    return spark.read.format(fmt).schema(REGION).options(**options).load(path)


def _numbered_lines(lines: DataFrame) -> DataFrame:
    """Lines with an ordinal that rises by file name, then by place in the file, however Spark packs files into tasks.

    A file part is known by its file and offset. Parts are ranked; within one, the row number in the task rises. Only the list of
    parts is sorted in one task.
    """
    part = {"_file": F.col("_metadata.file_path"), "_from": F.col("_metadata.file_block_start")}
    placed = lines.select("value", *[c.alias(n) for n, c in part.items()]).withColumn("_row", F.monotonically_increasing_id())
    parts = placed.select(*part).distinct().withColumn("_part", F.row_number().over(Window.orderBy("_file", "_from")).cast("long"))
    # the lower 33 bits of the id number the rows of a task
    ordinal = F.shiftleft("_part", 33) + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(parts), [*part]).select("value", ordinal.alias("ordinal"))


def regions_from_geojson(
    lines: DataFrame, name: str = NAME_ATTRIBUTE, code: str = CODE_ATTRIBUTE, ordinal: Column | None = None
) -> DataFrame:
    """Polygon and multipolygon features, one per line in ``value``.

    ``ordinal`` tells their order; without it they are numbered as they come.
    """
    feature = F.from_json(
        "value",
        f"properties struct<`{name}`: string, `{code}`: string>, geometry struct<type: string, coordinates: string>",
    )
    features = (
        lines.select((F.monotonically_increasing_id() if ordinal is None else ordinal).alias("ordinal"), feature.alias("feature"))
        .select(
            "ordinal",
            F.col(f"feature.properties.{name}").alias("region_name"),
            F.col(f"feature.properties.{code}").alias("region_code"),
            F.col("feature.geometry.type").alias("kind"),
            F.col("feature.geometry.coordinates").alias("coordinates"),
        )
    )
    rings = F.when(F.col("kind") == "Polygon", F.from_json("coordinates", "array<array<array<double>>>")).when(
        F.col("kind") == "MultiPolygon", F.flatten(F.from_json("coordinates", "array<array<array<array<double>>>>"))
    )
    return (
        features.select("ordinal", "region_name", "region_code", F.posexplode(rings).alias("ring_id", "ring"))
        .select("ordinal", "region_name", "region_code", "ring_id", F.posexplode("ring").alias("seq", "point"))
        .select(
            "ordinal",
            "region_name",
            "region_code",
            "ring_id",
            "seq",
            F.get("point", F.lit(0)).alias("lon"),
            F.get("point", F.lit(1)).alias("lat"),
        )
    )


def across_antimeridian(regions: DataFrame) -> DataFrame:
    """Regions whose rings cross the 180th meridian, made fit for a test in plain degrees.

    Between two vertices more than 180 degrees apart a ring is taken to go the short way round the globe. Such a ring is drawn on beyond
    180 or -180, and a copy of it is moved by 360 degrees, so each side of the meridian has its part. A ring around a pole, which does
    not come back to where it began, is left as it is, and so is every other ring.
    """
    ring = Window.partitionBy("ordinal", "ring_id")
    along = ring.orderBy("seq")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lon = F.col("lon")

    def jump(before: Column) -> Column:
        return F.when(lon - before > 180, F.lit(-360.0)).when(lon - before < -180, F.lit(360.0)).otherwise(F.lit(0.0))

    # the first vertex follows the last one
    stepped = regions.withColumn("_jump", jump(F.lag("lon").over(along)))
    stepped = stepped.withColumns({"_turn": F.sum("_jump").over(along), "_back": F.first(jump(F.last("lon").over(whole))).over(whole)})
    closed = F.last("_turn").over(whole) + F.col("_back") == 0
    crossing = closed & (F.max(F.abs("_jump")).over(ring) > 0)
    drawn = stepped.withColumn("_crosses", crossing).withColumn("lon", F.when(F.col("_crosses"), lon + F.col("_turn")).otherwise(lon))
    drawn = drawn.withColumns({"_west": F.min("lon").over(ring), "_east": F.max("lon").over(ring)})
    moves = F.filter(
        F.array(F.lit(0.0), F.when(F.col("_crosses") & (F.col("_east") > 180), F.lit(-360.0)), F.when(F.col("_crosses") & (F.col("_west") < -180), F.lit(360.0))),
        lambda move: move.isNotNull(),
    )
    copies = drawn.select("*", F.explode(moves).alias("_move"))
    # copies take numbers beyond those of all rings of their region
    beyond = F.max("ring_id").over(Window.partitionBy("ordinal")) + 1
    copies = copies.withColumn("_beyond", beyond).withColumn("ring_id", F.when(F.col("_move") == 0, F.col("ring_id")).otherwise(F.col("ring_id") + F.col("_beyond")))
    return copies.withColumn("lon", F.col("lon") + F.col("_move")).select(*regions.columns)
