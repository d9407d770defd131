"""A device holding a third of all events: the skew-safe forms give the exact results."""

import os

import pytest
from pyspark.sql import functions as F

from playlake.config import Settings
from playlake.plans import users
from playlake.plans import sessions as J2
from tests.conftest import WINDOW
from playlake.plans.events import stg_events
from playlake.sources import fixtures as fx
from playlake.sources.seed import event_sources

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="fixture tables not present")
def test_hot_device_sessions_and_user_periods(spark):
    ev = fx.read_events(spark, SF)
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    se = stg_events(fx.raw_event_log(hot), event_sources(spark), WINDOW).cache()
    assert se.filter(F.col("device_id") == "d0").count() * 3 >= se.count() * 0.9
    settings = Settings(session_timeout_minutes=720, timeline_bucket_hours=6)
    a = J2.stg_sessions(se, settings)
    b = J2.stg_sessions(se, settings, single_window=True)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    t = a.select("device_id", "user_id", F.col("session_start_ts").alias("event_ts"))
    x = users.scd2_from_timeline(t, "device_id", "user_id", "event_ts", "P")
    y = users.scd2_from_timeline_bucketed(t, "device_id", "user_id", "event_ts", "P", 6)
    assert x.count() == y.count() and x.exceptAll(y.select(*x.columns)).count() == 0
