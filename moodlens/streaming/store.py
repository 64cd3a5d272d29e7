"""The windows of the live stream as a keyed table, and the rows that came too late for them.

Every micro-batch is one version of the table, known by its number. A batch is merged into the open windows of the version
before it; windows that the watermark has passed are written once more and stay where they are. A batch that runs again writes
the same version again from the same one before, so a restart in the middle of a batch changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.session import discard

_KEYS = "state string, start_ms bigint"
_STATES = "n bigint, total double, absolute double, largest double, smallest double"
_MERGE = {"n": F.sum, "total": F.sum, "absolute": F.sum, "largest": F.max, "smallest": F.min}


@dataclass(frozen=True)
class WindowStore:
    """Sliding windows below ``path``, each ``window`` seconds long and ``slide`` after the one before it.

    A window is closed once the latest event time of earlier batches, less ``delay`` seconds, has reached its end. ``slide`` divides
    ``window``. One writer at a time is assumed.
    """

    path: str
    window: int = 20
    slide: int = 5
    delay: int = 5

    def _batches(self, spark: SparkSession) -> list[int]:
        """The numbers of the batches that are written as a whole, in order."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/windows")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        found = []
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("batch=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found.append(int(name.removeprefix("batch=")))
        return sorted(found)

    def _part(self, kind: str, batch: int) -> str:
        return f"{self.path}/{kind}/batch={batch}"

    def apply(self, rows: DataFrame, batch: int) -> None:
        """Merge the rows of a micro-batch (state, sentiment, date_time and others); what is written as a whole is not done again."""
        spark = rows.sparkSession
        written = self._batches(spark)
        if batch in written:
            return
        before = max((b for b in written if b < batch), default=None)
        last_ms = None if before is None else spark.read.parquet(self._part("progress", before)).first()["last_ms"]
        slide, panes = self.slide * 1000, self.window // self.slide
        watermark = F.lit(None if last_ms is None else last_ms - self.delay * 1000).cast("bigint")
        millis = F.unix_millis("date_time")
        pane = millis - F.pmod(millis, F.lit(slide))
        # windows end one slide after the pane, two slides after it, and so on
        closed = F.greatest(F.lit(0), F.least(F.lit(panes), F.floor((watermark - pane) / slide)))
        missed = F.when(millis.isNull(), F.lit(panes)).when(watermark.isNull(), F.lit(0)).otherwise(closed).cast("int")
        placed = rows.withColumns({"_pane": pane, "missed": missed}).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            placed.where("missed > 0").drop("_pane").write.mode("overwrite").parquet(self._part("late", batch))
            latest = placed.agg(F.max(millis)).first()[0]
            now_ms = max((ms for ms in (last_ms, latest) if ms is not None), default=None)
            merged = self._merged(spark, placed.where(F.col("missed") < panes), watermark, before)
            reached = F.lit(None if now_ms is None else now_ms - self.delay * 1000).cast("bigint")
            is_open = F.coalesce(F.col("start_ms") + self.window * 1000 > reached, F.lit(True))
            progress = spark.range(1).select(F.lit(now_ms).cast("bigint").alias("last_ms"))
            progress.write.mode("overwrite").parquet(self._part("progress", batch))
            # this is written last and makes the batch count
            merged.withColumn("is_open", is_open.cast("string")).write.mode("overwrite").partitionBy("is_open").parquet(self._part("windows", batch))
        finally:
            placed.unpersist()
        if before is not None:
            discard(spark, f"{self._part('windows', before)}/is_open=true", self._part("progress", before))

    def _merged(self, spark: SparkSession, rows: DataFrame, watermark, before: int | None) -> DataFrame:
        """States of the windows that the rows fall into, from states by pane, laid together with those still open before."""
        panes = rows.groupBy("state", "_pane").agg(
            F.count("sentiment").alias("n"),
            F.sum("sentiment").alias("total"),
            F.sum(F.abs("sentiment")).alias("absolute"),
            F.max("sentiment").alias("largest"),
            F.min("sentiment").alias("smallest"),
        )
        backs = F.sequence(F.lit(0), F.lit(self.window // self.slide - 1))
        start = F.col("_pane") - F.col("_back") * self.slide * 1000
        new = panes.withColumn("_back", F.explode(backs)).select("state", start.alias("start_ms"), *_MERGE)
        new = new.where(F.coalesce(F.col("start_ms") + self.window * 1000 > watermark, F.lit(True)))
        if before is not None:
            new = new.unionByName(self._read(spark).where((F.col("batch") == before) & (F.col("is_open") == "true")).select("state", "start_ms", *_MERGE))
        return new.groupBy("state", "start_ms").agg(*[merge(name).alias(name) for name, merge in _MERGE.items()])

    def _read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{_KEYS}, {_STATES}, batch int, is_open string").parquet(f"{self.path}/windows")

    def windows(self, spark: SparkSession) -> DataFrame:
        """Every window so far, once per state: its bounds, number of rows, mean, largest, smallest, total and absolute sentiment."""
        written = self._batches(spark)
        if not written:
            rows = spark.createDataFrame([], f"{_KEYS}, {_STATES}, batch int, is_open string")
        else:
            last = written[-1]
            current = (F.col("batch") <= last) & ((F.col("is_open") == "false") | (F.col("batch") == last))
            rows = self._read(spark).where(current)
        return rows.select(
            "state",
            F.timestamp_millis("start_ms").alias("window_start"),
            F.timestamp_millis(F.col("start_ms") + self.window * 1000).alias("window_end"),
            F.col("n").alias("count"),
            F.try_divide("total", "n").alias("mean_sentiment"),
            F.col("largest").alias("max_sentiment"),
            F.col("smallest").alias("min_sentiment"),
            F.col("total").alias("total_sentiment"),
            F.col("absolute").alias("absolute_sentiment"),
            (F.col("is_open") == "true").alias("is_open"),
        )

    def late(self, spark: SparkSession) -> DataFrame | None:
        """Rows that missed windows, with the number of windows ``missed``; those without a time miss all. None before any batch."""
        written = self._batches(spark)
        return spark.read.parquet(f"{self.path}/late").where(F.col("batch") <= written[-1]) if written else None
