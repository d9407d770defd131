"""Physical-plan properties: pushdown, pruning, and the partial top-1 aggregate."""

import contextlib
import io
import os
import tempfile

import pytest

from tests.conftest import WINDOW
from playlake.plans.events import stg_events
from playlake.sources import fixtures as fx
from playlake.sources.seed import event_sources

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="fixture tables not present")
def test_event_window_reaches_the_scan(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="playlake-raw-"), "log")
    fx.raw_event_log(fx.read_events(spark, SF)).write.parquet(path)
    raw = spark.read.parquet(path)
    df = stg_events(raw, event_sources(spark), WINDOW)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert "PushedFilters: [IsNotNull(publish_time), GreaterThanOrEqual(publish_time" in plan
    # only the payload and the time are read
    assert "ReadSchema: struct<publish_time:timestamp_ntz,data:string>" in plan
    # de-duplication aggregates partially before the exchange
    assert "partial_max_by" in plan


def test_sessionizer_windows_are_per_bucket(spark):
    import datetime as dt
    from playlake.operators.sessionize import number_sessions
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", "d", "hot", t0 + dt.timedelta(minutes=7 * i), f"e{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "k string, d string, u string, ts timestamp_ntz, id string")
    out = number_sessions(df, ["k", "d"], "ts", "id", "u", 10, bucket_hours=6)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue()
    # the row-level window is partitioned by the time bucket as well as the key
    assert "Window [lag(ts" in plan and "[k#" in plan and "_bucket#" in plan
    # one continuous session (gaps of 7 minutes) across 6-hour buckets
    assert {r.session_no for r in out.collect()} == {1}


def _hot_events(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [("frontend", "hot" if i % 3 else f"d{i}", f"u{i % 5}" if i % 4 == 0 else None, t0 + dt.timedelta(minutes=7 * i), f"e{i}")
            for i in range(3000)]
    df = spark.createDataFrame(rows, "event_source string, device_id string, user_id string, event_timestamp timestamp_ntz, event_id string")
    from pyspark.sql import functions as F

    from playlake.plans import sessions as J2
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in (*J2.ATTRIBUTES, "event_name", "event_properties")])


def test_stitch_spreads_a_hot_device_without_broadcast(spark):
    from pyspark.sql import functions as F

    from playlake.operators.sessionize import number_sessions
    from playlake.plans import sessions as J2
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
                                             "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        se = _hot_events(spark)
        ev = J2.stitch(J2.frontend_events(se), J2.identity_map(se))
        # the anonymous rows of the hot device leave the stitch in many tasks
        anonymous = ev.filter(F.col("user_id").isNull() & (F.col("device_id") == "hot"))
        assert anonymous.select(F.spark_partition_id().alias("p")).distinct().count() > 6
        assert ev.filter(F.col("stitched_user_id").isNull() & (F.col("device_id") == "hot")).count() == 0
        ev = ev.withColumn("_key", F.coalesce("stitched_user_id", "device_id"))
        numbered = number_sessions(ev, ["_key", "device_id"], "event_timestamp", "event_id", "stitched_user_id", 10, 6)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            numbered.explain()
        assert "Exchange hashpartitioning(_key#" in buf.getvalue() and "_bucket#" in buf.getvalue()
        # so do the windows: no task holds the device's whole timeline
        per_task = numbered.filter(F.col("device_id") == "hot").groupBy(F.spark_partition_id()).count().collect()
        assert len(per_task) > 6 and max(r["count"] for r in per_task) < 0.4 * 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
