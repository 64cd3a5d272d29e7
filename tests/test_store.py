"""Typed stores and upserts."""

import pytest

from moodlens.schemas import RESULT_TARGETS
from moodlens.sinks import conform, create_targets, read_store, upsert_connector, upsert_parquet

SCHEMA = "hour int, count bigint, mean_sentiment float"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def stored(spark, path):
    return sorted(tuple(row) for row in read_store(spark, path).collect())


def test_upsert_inserts_updates_and_keeps(spark, tmp_path):
    path = str(tmp_path / "store")
    assert read_store(spark, path) is None
    upsert_parquet(frame(spark, (1, 1, 0.5), (2, 2, 0.5)), path, "hour")
    upsert_parquet(frame(spark, (2, 3, None), (3, 9, 0.25)), path, "hour")
    assert stored(spark, path) == [(1, 1, 0.5), (2, 3, 0.5), (3, 9, 0.25)]


@pytest.mark.parametrize("rows", [[(None, 1, 0.5)], [(1, 1, 0.5), (1, 2, 0.5)]])
@pytest.mark.parametrize("existing", [False, True])
def test_bad_keys_leave_the_store_alone(spark, tmp_path, rows, existing):
    path = str(tmp_path / "store")
    if existing:
        upsert_parquet(frame(spark, (1, 1, 0.5)), path, "hour")
    with pytest.raises(Exception, match="upsert without hour|repeated hour"):
        upsert_parquet(frame(spark, *rows), path, "hour")
    if existing:
        assert stored(spark, path) == [(1, 1, 0.5)]
    else:
        assert read_store(spark, path) is None
    upsert_parquet(frame(spark, (2, 2, 0.5)), path, "hour")
    assert (2, 2, 0.5) in stored(spark, path)


def test_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "store")
    upsert_parquet(frame(spark, (1, 1, 0.5)), path, "hour")
    (tmp_path / "store" / "v00000007").mkdir()
    assert stored(spark, path) == [(1, 1, 0.5)]
    upsert_parquet(frame(spark, (1, 2, 0.5)), path, "hour")
    assert stored(spark, path) == [(1, 2, 0.5)]


def test_targets_are_typed_and_kept(spark, tmp_path):
    create_targets(spark, str(tmp_path))
    for name, schema in RESULT_TARGETS.items():
        assert read_store(spark, f"{tmp_path}/{name}").schema == schema
    upsert_parquet(frame(spark, (1, 1, 0.5)).selectExpr("hour", "count", "mean_sentiment"), f"{tmp_path}/x", "hour")
    wide = spark.createDataFrame(
        [(0, 5, 1.0, 2.0, 0.2)],
        "hour bigint, count bigint, total_sentiment double, absolute_sentiment double, mean_sentiment double",
    )
    upsert_parquet(conform(wide, "hour_reduced"), f"{tmp_path}/hour_reduced", "hour")
    create_targets(spark, str(tmp_path))
    row = read_store(spark, f"{tmp_path}/hour_reduced").first()
    assert row["count"] == 5 and row["mean_sentiment"] == pytest.approx(0.2) and row["mean_sentiment"] != 0.2


def test_connector_gets_its_options(spark, tmp_path):
    rows = frame(spark, (1, 1, 0.5))
    with pytest.raises(Exception, match="(?i)no_such_store"):
        upsert_connector(rows, "no_such_store", "hour", **{"es.resource": "hour_reduced"})
    upsert_connector(rows, "parquet", "hour", path=str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
