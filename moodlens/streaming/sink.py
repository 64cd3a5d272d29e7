"""Stream sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_stream(
    df: DataFrame,
    fmt: str,
    checkpoint: str | None = None,
    path: str | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Start an append-mode query into ``console``, ``memory``, ``parquet``, ``kafka`` or another sink.

    ``checkpoint`` belongs in the cluster's shared folder; only console and memory do without. ``trigger`` holds the
    arguments of Spark's trigger, such as ``{"availableNow": True}``.
    """
    if checkpoint is None and fmt not in ("console", "memory"):
        raise ValueError(f"the {fmt} sink needs a checkpoint location")
    writer = df.writeStream.outputMode("append").format(fmt).options(**options)
    if fmt == "console":
        writer = writer.option("truncate", "false")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start(path) if path else writer.start()
