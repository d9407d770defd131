import datetime as dt

import pytest
from pyspark.sql import functions as F

from playlake.operators.upsert import DuplicateMatchError, evolve_schema, upsert
from playlake.plans import devices, installs, users

T = dt.datetime(2024, 1, 10)
SESS = "device_id string, user_id string, session_start_ts timestamp_ntz"


def _h(h):
    return T + dt.timedelta(hours=h)


def test_anonymous_device_gets_one_period_per_session(spark):
    s = spark.createDataFrame([("d", None, _h(0)), ("d", None, _h(5)), ("d", None, _h(9))], SESS)
    out = users.dim_device_users_scd(s).orderBy("valid_from").collect()
    assert len(out) == 3 and all(r.user_id is None for r in out)
    assert out[0].valid_to == _h(5) - dt.timedelta(microseconds=1)
    assert out[-1].valid_to == dt.datetime(9999, 12, 31, 23, 59, 59, 999999)


def test_null_users_backfilled_from_next_user(spark):
    s = spark.createDataFrame([("d", None, _h(0)), ("d", None, _h(1)), ("d", "u1", _h(2))], SESS)
    out = users.dim_device_users_scd(s).collect()
    assert [(r.user_id, r.valid_from) for r in out] == [("u1", _h(0))]


def test_incremental_keeps_stale_starts(spark):
    first = users.dim_device_users_scd(spark.createDataFrame([("d", None, _h(0)), ("d", None, _h(1))], SESS))
    merged = users.dim_device_users_scd_merged(spark.createDataFrame([("d", "u1", _h(3))], SESS), first)
    rows = sorted((r.valid_from, r.user_id) for r in merged.collect())
    assert (_h(0), "u1") in rows and (_h(1), None) in rows  # stale row t1 left as it was (overlap)


COMBO = ("device_id string, platform string, app_version string, os_version string, device_brand string, "
         "device_manufacturer string, device_model string, adid string, idfa string, idfv string, af_id string, "
         "first_touch_timestamp timestamp_ntz")


def _combo(dev, platform, app, ts, brand=None):
    return (dev, platform, app, "14", brand, None, None, None, None, None, None, ts)


def test_null_platform_rows_collapse_to_one_version(spark):
    d = spark.createDataFrame([_combo("d1", None, "1.0", _h(0)), _combo("d2", None, "1.0", _h(1)),
                               _combo("d3", "ios", "1.0", _h(2))], COMBO)
    out = devices.dim_devices_scd(d).collect()
    assert len(out) == 2 and sum(r.id is None for r in out) == 1


def test_version_flip_back_is_lost(spark):
    d = spark.createDataFrame([_combo("d", "ios", "A", _h(0)), _combo("d", "ios", "B", _h(1)),
                               _combo("d", "ios", "A", _h(2))], COMBO)
    out = devices.dim_devices_scd(d).orderBy("valid_from").collect()
    assert [(r.app_version, r.valid_from) for r in out] == [("A", _h(0)), ("B", _h(1))]
    assert out[0].valid_to == _h(1) - dt.timedelta(microseconds=1)


def test_scd1_earliest_wins(spark):
    hist = devices.dim_devices(spark.createDataFrame([_combo("a", "ios", None, _h(5), "b1"),
                                                      _combo("b", None, "1", _h(1), "b2")], COMBO))
    daily = spark.createDataFrame([_combo("a", "android", "2", _h(1), None), _combo("b", "ios", "9", _h(1), "x"),
                                   _combo("c", "ios", "3", _h(0), None)], COMBO)
    got = {r.device_id: r for r in devices.dim_devices_merged(daily, hist).collect()}
    assert (got["a"].platform, got["a"].first_app_version, got["a"].device_brand) == ("android", "2", "b1")
    assert got["a"].first_touch_timestamp == _h(1)
    # equal first touch: historical wins, daily fills its NULLs
    assert (got["b"].platform, got["b"].first_app_version, got["b"].device_brand) == ("ios", "1", "b2")
    assert "c" in got


def test_user_match_priorities(spark):
    dev_users = spark.createDataFrame([
        (1, "d1", "u_in", _h(-10), _h(10)),
        (2, "d2", "u_soon", _h(24 * 3 + 23), None),
        (3, "d3", "u_edge", _h(24 * 4), None),
        (4, "d4", "u_late", _h(24 * 4) + dt.timedelta(microseconds=1), None)],
        "dim_device_user_sk long, device_id string, user_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    inst = spark.createDataFrame([(T, i, f"d{i}", "m", "c", "a", "ios", "j") for i in range(1, 6)],
                                 "install_time_mmp timestamp_ntz, attribution_unique_id long, device_id string, "
                                 "mediasource string, campaign string, adset string, platform string, join_method string")
    got = {r.attribution_unique_id: r.user_id for r in installs.user_attributed_installs(inst, dev_users).collect()}
    assert got == {1: "u_in", 2: "u_soon", 3: "u_edge"}


def test_upsert_semantics(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "c"), (None, "n2")], "k int, v string")
    got = sorted((r.k or -1, r.v) for r in upsert(t, s, ["k"]).collect())
    assert got == [(-1, "n"), (-1, "n2"), (1, "a"), (2, "B"), (3, "c")]
    dup = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(DuplicateMatchError):
        upsert(t, dup, ["k"], check_duplicates=True)


def test_schema_policies(spark):
    t = spark.createDataFrame([(1, "a", True)], "k int, v string, old boolean")
    s = spark.createDataFrame([(2, "b", 9)], "k int, v string, new int")
    assert evolve_schema(t, s, "ignore")[1].columns == ["k", "v", "old"]
    assert evolve_schema(t, s, "append_new_columns")[0].columns == ["k", "v", "old", "new"]
    assert upsert(t, s, ["k"], policy="sync_all_columns").columns == ["k", "v", "new"]
    with pytest.raises(ValueError):
        evolve_schema(t, s, "fail")


def test_bucketed_scd2_equals_single_window(spark):
    import random
    rnd = random.Random(3)
    rows = []
    for dev in range(5):
        t = T
        for i in range(80):
            t += dt.timedelta(minutes=rnd.choice([5, 50, 200, 700, 1500]))
            u = rnd.choice([None, None, "a", "b"]) if dev else None
            rows.append((f"d{dev}", u, t))
    df = spark.createDataFrame(rows, "device_id string, user_id string, event_ts timestamp_ntz")
    a = users.scd2_from_timeline(df, "device_id", "user_id", "event_ts", "P")
    b = users.scd2_from_timeline_bucketed(df, "device_id", "user_id", "event_ts", "P", 6)
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(*a.columns).collect()), key=repr)
    assert a.count() > 20


def test_collapsed_null_runs_and_replaced_devices(spark):
    import datetime as dt

    from playlake.config import Settings
    from playlake.plans import users
    t = dt.datetime(2024, 1, 1)
    at = [t + dt.timedelta(days=i) for i in range(6)]
    rows = [("d", None, at[0]), ("d", None, at[1]), ("e", "u", at[0]), ("e", None, at[1]), ("e", "u", at[2]), ("e", "v", at[3])]
    ses = spark.createDataFrame(rows, "device_id string, user_id string, session_start_ts timestamp_ntz")

    def starts(df):
        return sorted(((r["device_id"], r["user_id"], r["valid_from"]) for r in df.collect()), key=repr)
    kept = [("e", "u", at[0]), ("e", "v", at[3])]
    assert starts(users.dim_device_users_scd(ses)) == [("d", None, at[0]), ("d", None, at[1]), *kept]
    collapse = Settings(collapse_null_runs=True)
    assert starts(users.dim_device_users_scd(ses, None, collapse)) == [("d", None, at[0]), *kept]
    # the next run learns d's user: a start stops being one
    first = users.dim_device_users_scd(ses)
    later = spark.createDataFrame([("d", "w", at[2])], ses.schema)
    plain = users.dim_device_users_scd_merged(later, first, collapse)
    assert ("d", None, at[1]) in starts(plain)
    replaced = users.dim_device_users_scd_merged(later, first, Settings(collapse_null_runs=True, replace_keys=True))
    assert starts(replaced) == [("d", "w", at[0]), *kept]


def test_distinct_events_of_a_user(spark):
    import datetime as dt

    from playlake.plans import facts
    t = dt.datetime(2024, 1, 1)
    rows = [("u", "a", t), ("u", "a", t + dt.timedelta(days=1)), ("u", "b", t), ("u", None, t), ("w", None, t), (None, "c", t)]
    ev = spark.createDataFrame(rows, "user_id string, event_id string, event_timestamp timestamp_ntz")
    us = spark.createDataFrame([("u", "p", "1", "c", "l")], "user_id string, platform string, app_version string, country string, language string")
    got = {r["user_id"]: (r["total_events"], r["days_active"]) for r in facts.user_activity(ev, us, t).collect()}
    assert got == {"u": (2, 2), "w": (0, 1)}


def test_default_run_window():
    import datetime as dt

    from playlake.config import RunWindow
    w = RunWindow.resolve(today=dt.date(2024, 3, 10))
    assert (w.start, w.end, w.as_of) == (dt.date(2024, 3, 3), dt.date(2024, 3, 10), dt.datetime(2024, 3, 10))
    assert RunWindow.resolve("2024-01-01", "2024-01-05").start == dt.date(2024, 1, 1)


def test_seed_from_a_file(spark, tmp_path):
    from playlake.sources.seed import event_sources
    (tmp_path / "s.csv").write_text("event_name,event_source\nApp Opened,frontend\nPrize Won,backend\n")
    assert sorted(map(tuple, event_sources(spark, str(tmp_path / "s.csv")).collect())) == [("App Opened", "frontend"), ("Prize Won", "backend")]
    assert event_sources(spark).count() == 35
