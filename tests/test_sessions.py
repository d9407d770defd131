import datetime as dt
import random

from pyspark.sql import functions as F

from playlake.operators.sessionize import number_sessions, number_sessions_single_window
from playlake.plans.sessions import stitch, identity_map

T0 = dt.datetime(2024, 1, 1, 23, 50)
SCHEMA = "k string, d string, u string, ts timestamp_ntz, id string"


def _numbers(df, **kw):
    return {r.id: r.session_no for r in number_sessions(df, ["k", "d"], "ts", "id", "u", 10, **kw).collect()}


def test_whole_minute_gap_rule(spark):
    # gaps: 600 s (same), 659.999999 s (same), 660 s (new)
    gaps = [0, 600, 659.999999, 660]
    t, rows = T0, []
    for i, g in enumerate(gaps):
        t = t + dt.timedelta(seconds=g)
        rows.append(("u", "d", "u", t, f"e{i}"))
    n = _numbers(spark.createDataFrame(rows, SCHEMA), bucket_hours=1)
    assert [n[f"e{i}"] for i in range(4)] == [1, 1, 1, 2]


def test_two_users_on_one_device_are_independent(spark):
    rows = [("u1", "d", "u1", T0, "a1"), ("u2", "d", "u2", T0 + dt.timedelta(minutes=1), "b1"),
            ("u1", "d", "u1", T0 + dt.timedelta(minutes=5), "a2"), ("u2", "d", "u2", T0 + dt.timedelta(minutes=30), "b2")]
    n = _numbers(spark.createDataFrame(rows, SCHEMA))
    assert n["a1"] == n["a2"] == 1 and n["b1"] == 1 and n["b2"] == 2


def test_bucketed_numbering_equals_single_window(spark):
    rnd = random.Random(7)
    rows = []
    for dev in range(6):
        t = T0
        for i in range(120):
            t += dt.timedelta(seconds=rnd.choice([30, 300, 659, 660, 661, 3600, 7200]))
            user = None if dev == 0 else f"u{dev}"
            rows.append((user or f"d{dev}", f"d{dev}", user, t, f"{dev}-{i}"))
    df = spark.createDataFrame(rows, SCHEMA)
    a = {r.id: r.session_no for r in number_sessions(df, ["k", "d"], "ts", "id", "u", 10, bucket_hours=1).collect()}
    b = {r.id: r.session_no for r in number_sessions_single_window(df, ["k", "d"], "ts", "id", "u", 10).collect()}
    assert a == b and max(a.values()) > 5


def test_stitch_uses_first_user_of_device(spark):
    ev = spark.createDataFrame([
        (T0, "e1", None, "d1", "frontend"), (T0 + dt.timedelta(minutes=1), "e2", "u1", "d1", "frontend"),
        (T0 + dt.timedelta(minutes=2), "e3", None, "d1", "frontend"),
        (T0 + dt.timedelta(minutes=3), "e4", "u2", "d1", "frontend")],
        "event_timestamp timestamp_ntz, event_id string, user_id string, device_id string, event_source string")
    got = {r.event_id: r.stitched_user_id for r in stitch(ev, identity_map(ev)).collect()}
    assert got == {"e1": "u1", "e2": "u1", "e3": "u1", "e4": "u2"}


def test_session_attributes_are_ordered_by_one_number(spark):
    """Each attribute's state in the exchange holds a place in the timeline, not a time and an id."""
    import contextlib
    import io

    from pyspark.sql import functions as F

    from playlake.plans import sessions as J2
    t0 = dt.datetime(1969, 12, 31, 23, 50)      # across days and the epoch
    rows = [("frontend", "d", None if i < 3 else "u", t0 + dt.timedelta(minutes=5 * (i // 2)), f"e{i % 2}{9 - i}", f"v{i}" if i > 3 else None)
            for i in range(8)]
    se = spark.createDataFrame(rows, "event_source string, device_id string, user_id string, event_timestamp timestamp_ntz, "
                                     "event_id string, country string")
    se = se.select("*", *[F.lit(None).cast("string").alias(c) for c in (*J2.ATTRIBUTES, "event_name", "event_properties") if c != "country"])
    found = J2.stg_sessions(se)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        found.explain("extended")
    assert "min_by(country" in buf.getvalue() and "_place" in buf.getvalue()
    (got,) = found.collect()
    assert (got.country, got.event_ids_in_session) == ("v4", [f"e{i % 2}{9 - i}" for i in range(8)])
    (single,) = J2.stg_sessions(se, single_window=True).collect()
    assert got == single
