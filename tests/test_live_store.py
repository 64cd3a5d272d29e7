"""Windows kept batch by batch: replays, late rows, panes and the replay stream."""

import json
import random

import pytest
from pyspark.sql import functions as F

from moodlens.catalog import fixtures
from moodlens.plans import replay_stream
from moodlens.session import discard
from moodlens.streaming import WindowStore, decode_payload, pane_window_sentiment, window_sentiment

ROWS = "state string, sentiment double, date_time timestamp, tweet string"


def rows_at(spark, values):
    """Rows of (second or None, state, sentiment)."""
    df = spark.createDataFrame([(s, x, None if t is None else float(t), "t") for t, s, x in values], "state string, sentiment double, second double, tweet string")
    return df.select("state", "sentiment", F.timestamp_millis((F.col("second") * 1000).cast("bigint")).alias("date_time"), "tweet")


def shown(df):
    return sorted(map(tuple, df.select(F.unix_timestamp("window_start"), "state", "count", "max_sentiment", "min_sentiment", "total_sentiment", "is_open").collect()))


def expected(batches, window=20, slide=5, delay=5):
    """Windows and missed windows by a plain loop over the rows."""
    windows, late, latest = {}, [], None
    for batch in batches:
        watermark = None if latest is None else latest - delay
        for second, state, value in batch:
            missed = 0
            for k in range(window // slide):
                start = None if second is None else second // slide * slide - k * slide
                if start is None or (watermark is not None and start + window <= watermark):
                    missed += 1
                else:
                    windows.setdefault((start, state), []).append(value)
            if missed:
                late.append((second, state, value, missed))
        latest = max([s for s, _, _ in batch if s is not None] + ([] if latest is None else [latest]), default=None)
    out = [(int(w), s, len(v), max(v), min(v), sum(v), latest is None or w + window > latest - delay) for (w, s), v in windows.items()]
    return sorted(out), late


def draw(seed, batches=5):
    random.seed(seed)
    out, now = [], 0
    for _ in range(batches):
        out.append([(None if random.random() < 0.1 else now + random.choice((0, 1, 3, -8, -40, 12)), random.choice("ab"), random.randint(-8, 8) / 8) for _ in range(12)])
        now += random.choice((0, 9, 30))
    return [*out[:2], [], *out[2:]]


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_and_late_rows_equal_a_plain_loop(spark, tmp_path, seed):
    store, batches = WindowStore(str(tmp_path / "store")), draw(seed)
    assert store.windows(spark).collect() == [] and store.late(spark) is None
    for number, batch in enumerate(batches):
        store.apply(rows_at(spark, batch), number)
    windows, late = expected(batches)
    assert shown(store.windows(spark)) == windows
    found = store.late(spark).select((F.unix_millis("date_time") / 1000).alias("second"), "state", "sentiment", "missed")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(late, key=repr)
    # every row counts once for each of its windows, here or there
    counted = store.windows(spark).agg(F.sum("count")).first()[0] + sum(missed for *_, missed in late)
    assert counted == 4 * sum(map(len, batches))


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    store, batches = WindowStore(str(tmp_path / "store")), draw(3)
    for number, batch in enumerate(batches):
        rows = rows_at(spark, batch)
        store.apply(rows, number)
        before = shown(store.windows(spark)), store.late(spark).count()
        store.apply(rows, number)
        assert (shown(store.windows(spark)), store.late(spark).count()) == before
    assert before[0] == expected(batches)[0]


@pytest.mark.parametrize("stage", ["late", "progress", "windows"])
def test_restart_in_the_middle_of_a_batch(spark, tmp_path, monkeypatch, stage):
    """The job ends after one of the writes of the second batch; its windows count only when that batch has run again."""
    store, batches = WindowStore(str(tmp_path / "store")), draw(4)[:3]
    store.apply(rows_at(spark, batches[0]), 0)
    first = shown(store.windows(spark)), store.late(spark).count()
    store.apply(rows_at(spark, batches[1]), 1)
    whole = shown(store.windows(spark)), store.late(spark).count()

    again = WindowStore(str(tmp_path / "again"))
    again.apply(rows_at(spark, batches[0]), 0)
    part = again._part
    broken = []

    def failing(self, kind, batch):
        # the parts before the failing one are written
        if kind == stage and batch == 1 and not broken:
            broken.append(stage)
            raise RuntimeError("executor lost")
        return part(kind, batch)

    monkeypatch.setattr(WindowStore, "_part", failing)
    with pytest.raises(RuntimeError):
        again.apply(rows_at(spark, batches[1]), 1)
    assert (shown(again.windows(spark)), again.late(spark).count()) == first
    again.apply(rows_at(spark, batches[1]), 1)
    assert (shown(again.windows(spark)), again.late(spark).count()) == whole


def test_half_written_windows_do_not_count(spark, tmp_path):
    """A batch whose marker is missing leaves the closed windows of those before it, and runs again."""
    store, batches = WindowStore(str(tmp_path / "store")), draw(5)[:2]
    for number, batch in enumerate(batches):
        store.apply(rows_at(spark, batch), number)
    store.apply(rows_at(spark, [(500, "z", 1.0)]), 2)
    with_z = shown(store.windows(spark))
    discard(spark, f"{store.path}/windows/batch=2/_SUCCESS")
    assert {w[1] for w in shown(store.windows(spark))} <= {"a", "b"} and "z" in {w[1] for w in with_z}


def test_panes_give_the_same_windows(spark):
    random.seed(9)
    rows = rows_at(spark, [(random.uniform(0, 200), random.choice("abc"), random.randint(-8, 8) / 8) for _ in range(400)])
    names = ("mean_sentiment", "max_sentiment", "min_sentiment", "total_sentiment", "absolute_sentiment")
    key = lambda df: sorted(map(tuple, df.select("state", F.unix_timestamp("window.start"), *names).collect()))
    assert key(pane_window_sentiment(rows, names)) == key(window_sentiment(rows, names))


def test_rows_enter_the_state_of_panes_once(spark, tmp_path, sf_dir):
    """The first of the two chained operators takes a row per state and pane; only panes reach the second."""
    rows_at(spark, [(t / 4, "a", 0.5) for t in range(400)]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ROWS).parquet(str(tmp_path / "in"))
    taken = {}
    for name, windows in (("panes", pane_window_sentiment), ("windows", window_sentiment)):
        query = windows(stream).writeStream.outputMode("append").format("memory").queryName(f"state_of_{name}")
        run = query.option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        run.awaitTermination()
        progress = [p for p in run.recentProgress if p["numInputRows"]][0]
        taken[name] = [op["numRowsUpdated"] for op in progress["stateOperators"]]
    assert taken["windows"] == [23] and taken["panes"][-1] == 20 and len(taken["panes"]) == 2


def test_replay_goes_on_after_a_restart(spark, tmp_path, sf_dir):
    tweets, topic = fixtures.tweets(spark, sf_dir), str(tmp_path / "topic")
    for sends in (1, 2):
        replay_stream(tweets, "text", str(tmp_path / "c"), n=7, start_ms=5000, pause_ms=10, path=topic, trigger={"availableNow": True}).awaitTermination()
        stamps = [json.loads(r["value"])["timestamp_logger"] for r in spark.read.text(topic).collect()]
        assert sorted(stamps) == sorted([5000 + 10 * k for k in range(sends)] * 7)
    ids = decode_payload(spark.read.text(topic)).groupBy("tweet_id").count().collect()
    assert len(ids) == 7 and {r["count"] for r in ids} == {2}
