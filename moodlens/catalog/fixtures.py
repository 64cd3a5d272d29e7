"""Tweets, users, regions and a lexicon derived from the given tables.

Every event is a tweet. Its text is a whole document, so texts repeat as retweets do; documents are dealt out by a
fixed rule on the event number. Some tweets lack a time, and those of one event type have no readable location.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.functions.text import sentiment_tokens
from moodlens.schemas import LEXICON
from moodlens.sinks.files import to_json_values
from moodlens.sources.regions import CODE_ATTRIBUTE, NAME_ATTRIBUTE

# Terms that are frequent in the documents. The polarities are eighths, so sums of them are exact.
LEXICON_ROWS = (
    ("the", 0.125), ("of", -0.125), ("and", 0.25), ("that", -0.25), ("for", 0.5), ("was", -0.5), ("with", 0.375),
    ("this", -0.375), ("are", 0.625), ("from", -0.625), ("rewh", 1.0), ("orre", -1.0), ("thatin", 0.75),
    ("ononst", -0.75), ("worthless", -0.875), ("best", 0.875), ("der", 0.125), ("die", -0.25), ("und", 0.25),
    ("que", -0.125), ("les", 0.375), ("des", -0.5), ("los", 0.5), ("ment", -0.375),
)

# A region's vertices around its middle, as (ring, vertex, degrees east, degrees north). Ring 0 is a star,
# ring 1 a hole, ring 2 a second part.
RING_VERTICES = (
    (0, 0, 5.5, 0.0), (0, 1, 2.5, 1.25), (0, 2, 0.0, 3.0), (0, 3, -2.5, 1.25),
    (0, 4, -5.5, 0.0), (0, 5, -2.5, -1.25), (0, 6, 0.0, -3.0), (0, 7, 2.5, -1.25),
    (1, 0, 1.0, 0.0), (1, 1, 0.0, 0.5), (1, 2, -1.0, 0.0), (1, 3, 0.0, -0.5),
    (2, 0, -9.0, 0.5), (2, 1, -6.0, 0.5), (2, 2, -6.0, 2.0), (2, 3, -9.0, 2.0),
)

#: Beyond as many tasks as there are cores, a task makes about this many tweets.
TWEETS_PER_TASK = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEXICON_ROWS), LEXICON)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A star per nation on a grid over the box the tweets come from; neighbours overlap."""
    vertices = F.array(
        *[
            F.struct(F.lit(ring).alias("ring_id"), F.lit(seq).alias("seq"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
            for ring, seq, dx, dy in RING_VERTICES
        ]
    )
    nations = table(spark, sf_dir, "nation")
    placed = nations.select("n_nationkey", "n_name", "n_regionkey", F.explode(vertices).alias("v"))
    column, row = F.col("n_nationkey") % 5, F.floor(F.col("n_nationkey") / 5)
    return placed.where(
        "v.ring_id = 0 or (v.ring_id = 1 and n_regionkey in (1, 3)) or (v.ring_id = 2 and n_regionkey = 4)"
    ).select(
        F.col("n_nationkey").cast("bigint").alias("ordinal"),
        F.col("n_name").alias("region_name"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("region_code"),
        F.col("v.ring_id").alias("ring_id"),
        F.col("v.seq").alias("seq"),
        (F.lit(-119.0) + column * 12 + F.col("v.dx")).alias("lon"),
        (F.lit(27.0) + row * 5 + F.col("v.dy")).alias("lat"),
    )


def ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region before all others with a vertex per customer along its upper border, all within two degrees."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("key"))
    ends = customers.agg((F.max("key") + 1).alias("n"))
    upper = customers.select(
        (F.col("key") + 1).alias("seq"),
        (F.lit(-100.0) + F.col("key").cast("double") * 2 / ends.scalar()).alias("lon"),
        (F.lit(37.5) + (F.col("key") * 7919 % 97).cast("double") / 97).alias("lat"),
    )
    corners = F.inline(
        F.array(
            F.struct(F.lit(0).cast("bigint").alias("seq"), F.lit(-100.5).alias("lon"), F.lit(36.875).alias("lat")),
            F.struct((F.col("n") + 2).alias("seq"), F.lit(-97.5).alias("lon"), F.lit(36.875).alias("lat")),
        )
    )
    border = upper.unionByName(ends.where("n is not null").select(corners))
    return border.select(
        F.lit(-1).cast("bigint").alias("ordinal"),
        F.lit("Ridge").alias("region_name"),
        F.lit("R").alias("region_code"),
        F.lit(0).alias("ring_id"),
        F.col("seq").cast("int").alias("seq"),
        "lon",
        "lat",
    )


def moved_regions(spark: SparkSession, sf_dir: str, degrees: int) -> DataFrame:
    """The regions moved towards the east, with longitudes beyond 180 written as negative ones."""
    lon = F.col("lon") + degrees
    return regions(spark, sf_dir).withColumn("lon", F.when(lon > 180, lon - 360).otherwise(lon))


def moved_locations(spark: SparkSession, sf_dir: str, degrees: int) -> DataFrame:
    """The tweets' different locations moved in the same way; the texts of their numbers are made from whole hundredths."""
    places = tweets(spark, sf_dir).select("location").distinct()
    parts = F.split("location", ",")
    east = F.round(F.get(parts, F.lit(1)).try_cast("decimal(10,2)") * 100).cast("bigint") + 100 * degrees
    east = F.when(east > 18000, east - 36000).otherwise(east)
    moved = F.concat(F.get(parts, F.lit(0)), F.lit(","), F.when(east < 0, F.lit("-")).otherwise(F.lit("")), _hundredths(F.abs(east)))
    return places.select(F.coalesce(moved, F.col("location")).alias("location"))


def _hundredths(number: Column) -> Column:
    """A non-negative count of hundredths as a decimal text."""
    whole = F.floor(number / 100).cast("string")
    return F.concat(whole, F.lit("."), F.lpad((number % 100).cast("string"), 2, "0"))


def _latitude(key: Column) -> Column:
    return _hundredths(F.lit(2400) + key * 7919 % 2600)


def _longitude(key: Column) -> Column:
    return F.concat(F.lit("-"), _hundredths(F.lit(12500) - key * 104729 % 5900))


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tweet per event."""
    documents = table(spark, sf_dir, "documents")
    events = table(spark, sf_dir, "events").withColumn(
        "doc_id", F.col("event_id") * 7919 % documents.select(F.count("*")).scalar()
    )
    # the documents are dealt out before they are copied, so that the work on texts takes all cores even where they are one file.
    # Tweets are far larger than the rows that are exchanged for them, so their number and not those bytes says how many tasks they take
    tasks = events.count() // TWEETS_PER_TASK
    texts = documents.select("doc_id", "text")
    texts = texts.repartition(tasks, "doc_id") if tasks > spark.sparkContext.defaultParallelism else texts.repartition("doc_id")
    event = F.col("event_id")
    location = F.concat_ws(",", _latitude(event), _longitude(event))
    return events.join(texts, "doc_id").select(
        F.col("user_id").cast("string").alias("user_id"),
        event.cast("string").alias("tweet_id"),
        F.col("text").alias("tweet"),
        F.when(F.col("value") >= 1, F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(location).alias("location"),
    )


def user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of the users file for each user of the events."""
    user = F.col("user_id")
    line = F.concat(user.cast("string"), F.lit("\tUT: "), _latitude(user), F.lit(","), _longitude(user))
    return table(spark, sf_dir, "events").select("user_id").distinct().select(line.alias("value"))


def tweet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of the headerless tweets file for each tweet; those without a readable location have a field too many."""
    stray = F.when(F.col("location") == "n/a", F.lit("stray field"))
    line = F.concat_ws(
        "\t",
        "user_id",
        "tweet_id",
        F.regexp_replace("tweet", r"[\t\r\n]+", " "),
        F.coalesce(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit("")),
        stray,
    )
    return tweets(spark, sf_dir).select(line.alias("value"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream message of each tweet, with the tweet's time as its ingest time."""
    return to_json_values(tweets(spark, sf_dir), F.col("timestamp"))


def document_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents as a term. The polarities are eighths made from length and first letter."""
    words = table(spark, sf_dir, "documents").select(F.explode(sentiment_tokens("text")).alias("term")).distinct()
    return words.select("term", (((F.length("term") * 7 + F.ascii("term")) % 17 - 8) / 8).alias("polarity"))


def write_region_files(spark: SparkSession, sf_dir: str, path: str, files: int = 3) -> None:
    """The regions as GeoJSON features, dealt to several files in the order of their ordinals."""
    rings = regions(spark, sf_dir).groupBy("ordinal", "region_name", "region_code", "ring_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "lon", "lat"))), lambda v: F.array(v["lon"], v["lat"])).alias("ring")
    )
    features = rings.groupBy("ordinal", "region_name", "region_code").agg(
        F.array_sort(F.collect_list(F.struct("ring_id", "ring"))).alias("rings")
    )
    parts = F.transform("rings", lambda r: r["ring"])

    def feature(kind: str, coordinates: Column) -> Column:
        properties = F.struct(F.col("region_name").alias(NAME_ATTRIBUTE), F.col("region_code").alias(CODE_ATTRIBUTE))
        geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
        return F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry")))

    separate = F.exists("rings", lambda r: r["ring_id"] == 2)
    value = F.when(separate, feature("MultiPolygon", F.transform(parts, lambda p: F.array(p)))).otherwise(feature("Polygon", parts))
    lines = features.select("ordinal", value.alias("value")).repartitionByRange(files, "ordinal").sortWithinPartitions("ordinal")
    lines.select("value").write.text(path)
