"""Writers: keyed result stores, delimited and JSON exports, bulk load."""

from moodlens.sinks.clustered import ClusteredStore, buckets_for, join_users_clustered, open_clustered, write_clustered
from moodlens.sinks.files import bulk_load, publish_json, read_loaded, to_json_values, write_tsv
from moodlens.sinks.store import conform, create_targets, read_store, upsert_connector, upsert_parquet

__all__ = [
    "ClusteredStore",
    "buckets_for",
    "bulk_load",
    "conform",
    "create_targets",
    "join_users_clustered",
    "open_clustered",
    "publish_json",
    "read_loaded",
    "read_store",
    "to_json_values",
    "upsert_connector",
    "upsert_parquet",
    "write_clustered",
    "write_tsv",
]
