import os
import tempfile

import pytest

from tests.conftest import WINDOW
from playlake.sources import fixtures as fx
from playlake.sources.seed import event_sources
from playlake.streaming import start_event_ingest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="fixture tables not present")
def test_stream_ingest_equals_batch(spark):
    from pyspark.sql import functions as F
    root = tempfile.mkdtemp(prefix="playlake-stream-")
    raw = fx.raw_event_log(fx.read_events(spark, SF))
    # deliver the log in two files: originals first, re-delivered copies later
    raw.filter(F.col("message_id") % 50 != 0).write.parquet(f"{root}/src/part1")
    raw.filter(F.col("message_id") % 50 == 0).write.mode("append").parquet(f"{root}/src/part2")
    seed = event_sources(spark)
    q = start_event_ingest(spark, f"{root}/src/*", f"{root}/table", seed, f"{root}/ckpt", WINDOW)
    q.awaitTermination(300)
    streamed = spark.read.parquet(f"{root}/table").drop("event_day", "payload_md5")
    from playlake.plans.events import stg_events
    batch = stg_events(raw, seed, WINDOW)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_copies_across_midnight_and_without_time(spark, tmp_path):
    import datetime as dt
    import json

    from playlake.config import RunWindow
    from playlake.plans.events import stg_events
    from playlake.streaming.ingest import RAW_EVENT_SCHEMA

    def log(*events):
        rows = []
        for event_id, when, value in events:
            data = {"_event_id": event_id, "event_name": "App Opened", "properties": {"device_id": "d", "city": value}}
            data |= {"event_id": event_id}
            if when is not None:
                data["timestamp"] = int(when.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
            rows.append((dt.datetime(2024, 1, 11), "s", None, "{}", json.dumps(data)))
        return spark.createDataFrame(rows, RAW_EVENT_SCHEMA)

    midnight = dt.datetime(2024, 1, 11)
    half = dt.timedelta(milliseconds=500)
    batches = [log(("e1", midnight - half, "before"), ("e2", None, "no time"), ("e3", midnight, "x")),
               log(("e1", midnight + half, "after"), ("e4", None, "later")),
               log(("e2", midnight, "timed"), ("e1", midnight - half, "late copy"))]
    seed, window = event_sources(spark), RunWindow(dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.datetime(2024, 1, 31))
    path = str(tmp_path / "events")
    for k, b in enumerate(batches):      # a file each, oldest first: three micro-batches
        b.coalesce(1).write.parquet(str(tmp_path / "src" / f"part{k}"))
        for f in (tmp_path / "src" / f"part{k}").glob("*.parquet"):
            os.utime(f, (1_700_000_000 + 100 * k,) * 2)
    query = start_event_ingest(spark, str(tmp_path / "src" / "*"), path, seed, str(tmp_path / "ckpt"), window, files_per_batch=1)
    query.awaitTermination(300)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    got = spark.read.parquet(path).select("event_id", "event_timestamp", "city").collect()
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2])
    want = stg_events(whole, seed, window).select("event_id", "event_timestamp", "city").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)
    assert len(got) == 4


def test_state_of_an_event_expires():
    """A timer removes the state ``keep`` after the last copy; a later copy passes as a new event."""
    import pandas as pd

    from playlake.streaming.latest import NO_DAY, _newest

    class State:
        value, hasTimedOut, timeout = None, False, None
        exists = property(lambda self: self.value is not None)
        get = property(lambda self: self.value)

        def update(self, v):
            self.value = v

        def remove(self):
            self.value = None

        def setTimeoutTimestamp(self, ms):
            self.timeout = ms

    def rows(*found):
        return iter([pd.DataFrame([(*f, 1000) for f in found], columns=["event_id", "_us", "_tie", "_day", "_ms"])])

    s, step = State(), _newest(5000)
    first = list(step(("e",), rows(("e", 5, "b", 3), ("e", 5, "c", 3), ("e", 4, "z", 2)), s))
    assert [tuple(r) for r in first[0].values.tolist()] == [("e", 5, "c", 3, 1000, False, NO_DAY)] and s.timeout == 6000
    assert list(step(("e",), rows(("e", 5, "c", 3), ("e", 5, "a", 3)), s)) == []
    newer = list(step(("e",), rows(("e", 6, "a", 4)), s))
    assert [tuple(r) for r in newer[0].values.tolist()] == [("e", 6, "a", 4, 1000, True, 3)] and s.value == (6, "a", 4)
    s.hasTimedOut = True
    assert list(step(("e",), iter([]), s)) == [] and s.value is None


@pytest.mark.skipif(not os.path.exists(SF), reason="fixture tables not present")
def test_session_stream_equals_session_windows(spark, tmp_path):
    """Files out of order within the watermark; what is open at the end is closed by one far event."""
    from pyspark.sql import functions as F

    from playlake.plans import sessions as J2
    from playlake.plans.catalog import QUERIES, Inputs
    from playlake.streaming import start_session_stream

    events = Inputs(spark, SF).stg_events()
    imap = J2.identity_map(events)
    day = F.dayofyear("event_timestamp")
    # the first file holds most of days 1-3, later files bring their late events with newer days
    late = F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0
    piece = F.least(F.floor((day - 1) / 3) + F.when(late, 1).otherwise(0), F.lit(10))
    last = events.agg(F.max("event_timestamp")).first()[0]
    for k in range(11):
        part = events.filter(piece == k)
        if k == 10:
            far = events.filter((F.col("event_source") == "frontend") & F.col("device_id").isNotNull()).limit(1)
            far = far.withColumn("event_timestamp", F.lit(last).cast("timestamp_ntz") + F.expr("INTERVAL 60 DAY")).withColumn("device_id", F.lit("far"))
            part = part.unionByName(far)
        part.coalesce(1).write.parquet(str(tmp_path / "src" / f"part{k:02d}"))
        for f in (tmp_path / "src" / f"part{k:02d}").glob("*.parquet"):
            os.utime(f, (1_700_000_000 + 100 * k,) * 2)
    query = start_session_stream(spark, str(tmp_path / "src" / "*"), imap, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                                 timeout_minutes=720, late="7 days", files_per_batch=1)
    query.awaitTermination(600)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = QUERIES["sessions_by_window"](spark, SF)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert all(int(o.get("numRowsDroppedByWatermark", 0)) == 0 for p in query.recentProgress for o in p["stateOperators"])
