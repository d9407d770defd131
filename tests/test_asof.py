import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from playlake.functions import ntz
from playlake.operators.asof import as_of_join, has_overlaps, prioritized_match
from playlake.operators.cascade import Rule, cascade_join, heavy_pairs
from playlake.operators.scd import scd2_by_version_hash

T = dt.datetime(2024, 1, 10, 12)
H = dt.timedelta(hours=1)
POINTS, PERIODS = "id int, dev string, at timestamp_ntz", "n int, k string, vf timestamp_ntz, vt timestamp_ntz"


def periods_of(rng, keys, closed, overlapping):
    """Periods of each key: one after another with gaps, or at random."""
    out, n = [], 0
    for k in keys:
        at = T - dt.timedelta(days=40)
        for _ in range(rng.randint(0, 25)):
            start = at + rng.choice([0, 1, 5, 40, 200]) * H
            end = start + rng.choice([1, 3, 30, 300]) * H
            if overlapping and rng.random() < .3:
                end = start + rng.choice([-1, 0, 2000]) * H
            out.append((n, k, start, end))
            n += 1
            at = start + H if overlapping else end + (dt.timedelta(microseconds=1) if closed else dt.timedelta(0))
    return out


def points_of(rng, keys, periods, n=250):
    ends = [t for p in periods for t in p[2:] if t] or [T]
    return [(i, rng.choice([*keys, "nobody", None]),
             rng.choice([None, rng.choice(ends), rng.choice(ends) - dt.timedelta(microseconds=1),
                         T + rng.randint(-1500, 1500) * H])) for i in range(n)]


def inside(p, t, closed):
    return p[2] is not None and p[3] is not None and p[2] <= t and (t <= p[3] if closed else t < p[3])


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("overlapping", [True, False])
def test_as_of_join_matches_brute_force(spark, closed, overlapping):
    rng = random.Random(closed + 2 * overlapping)
    per = periods_of(rng, "abcde", closed, overlapping) + [(900, None, T, T + H), (901, "a", None, T), (902, "b", T, None)]
    pts = points_of(rng, "abcde", per)
    pts += pts[:5]
    p, q = spark.createDataFrame(pts, POINTS), spark.createDataFrame(per, PERIODS)
    want = sorted((i, m[0]) for i, k, t in pts for m in per if k is not None and t is not None and m[1] == k and inside(m, t, closed))
    assert has_overlaps(q, "k", "vf", "vt", closed) == overlapping
    for flag in (None, overlapping):
        got = as_of_join(p, q, "dev", "at", "k", "vf", "vt", closed, "inner", flag, bucket_hours=rng.choice([5, 24, 500])).collect()
        assert sorted((r.id, r.n) for r in got) == want
        left = as_of_join(p, q, "dev", "at", "k", "vf", "vt", closed, overlapping=flag).collect()
        assert sorted((r.id, r.n) for r in left if r.n is not None) == want
        lone = [i for i, k, t in pts if not any(w[0] == i for w in want)]
        assert sorted(r.id for r in left if r.n is None) == sorted(lone)


def test_a_wrong_claim_of_no_overlap_raises(spark):
    q = spark.createDataFrame([(1, "a", T, T + 50 * H), (2, "a", T + 49 * H, T + 60 * H)], PERIODS)
    p = spark.createDataFrame([(1, "a", T)], POINTS)
    with pytest.raises(Exception, match="overlap"):
        as_of_join(p, q, "dev", "at", "k", "vf", "vt", overlapping=False).collect()
    touching = spark.createDataFrame([(1, "a", T, T + H), (2, "a", T + H, T + 2 * H)], PERIODS)
    assert not has_overlaps(touching, "k", "vf", "vt", False) and has_overlaps(touching, "k", "vf", "vt", True)


def test_as_of_join_is_lazy_and_copies_no_point(spark):
    def never(_):
        raise AssertionError("a job ran while the plan was built")
    p = spark.createDataFrame([(1, "a", T)], POINTS).mapInPandas(never, POINTS)
    q = spark.createDataFrame([(1, "a", T, T)], PERIODS)
    plan = as_of_join(p, q, "dev", "at", "k", "vf", "vt", overlapping=False)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


def brute_match(pts, per, ahead):
    """Of each point: the periods that hold it, else the nearest start ahead."""
    out = []
    for i, k, t in pts:
        if k is None or t is None:
            continue
        mine = [m for m in per if m[1] == k and m[2] is not None and m[3] is not None]
        now = [m for m in mine if inside(m, t, False)]
        soon = [m for m in mine if t < m[2] <= t + ahead and m[3] > t]
        if now:
            out += [(i, m[0], 1) for m in now]
        elif soon:
            out.append((i, min(soon, key=lambda m: (m[2], m[0]))[0], 2))
    return sorted(out)


@pytest.mark.parametrize("overlapping", [True, False])
def test_prioritized_match_matches_brute_force(spark, overlapping):
    rng = random.Random(7 + overlapping)
    per = periods_of(rng, "abcd", False, overlapping)
    # two users from one moment: the first has a period that ends before it starts
    per += [(700, "z", T, T - dt.timedelta(microseconds=1)), (701, "z", T, T + H), (702, "z", T + 2 * H, T + H)]
    pts = points_of(rng, "abcdz", per, 300) + [(950, "z", T - dt.timedelta(microseconds=1)), (951, "z", T - 2 * H), (952, "z", T + H / 2)]
    p, q = spark.createDataFrame(pts, POINTS), spark.createDataFrame(per, PERIODS)
    ahead = dt.timedelta(days=4)
    want = brute_match(pts, per, ahead)
    for hours in (6, 24):
        got = prioritized_match(p, q, "dev", "at", "k", "vf", "vt", ahead, bucket_hours=hours).collect()
        assert sorted((r.id, r.n, r.match_type) for r in got) == want
    left = prioritized_match(p, q, "dev", "at", "k", "vf", "vt", ahead, how="left").collect()
    assert {r.id for r in left} == {x[0] for x in pts}


# ---------------------------------------------------------------- cascading lookups

LEFT, RIGHT = "id int, p string, a string, b string, c string", "dev string, ka string, kb string, kc string, ft int"


def brute_cascade(left, right):
    out = []
    for row in left:
        i, p, a, b, c = row
        for name, value, col, ok in (("ra", a, 1, True), ("rb", b, 2, p == "x"), ("rc", c, 3, p == "y")):
            hits = [r for r in right if ok and value is not None and r[col] == value]
            if hits:
                best = min(hits, key=lambda r: (r[4] is not None, r[4] or 0, r[0]))
                out.append((*row, best[0], best[4], name))
                break
        else:
            out.append((*row, None, None, "none"))
    return sorted(out, key=repr)


def cascaded(left, right, **options):
    rules = [Rule("ra", "a", "ka"), Rule("rb", "b", "kb", F.col("p") == "x"), Rule("rc", "c", "kc", F.col("p") == "y")]
    return cascade_join(left, right, rules, ["dev", "ft"], ["ft", "dev"], no_match="none", **options)


@pytest.mark.parametrize("deal_by", [None, ["id"]])
def test_cascade_join_matches_brute_force(spark, deal_by):
    rng = random.Random(3)
    some = lambda n, k: rng.choice([None, "", *(f"{k}|{i}" for i in range(n))])
    left = [(i, rng.choice(["x", "y", None]), some(30, "a"), some(8, "b"), some(8, "b")) for i in range(300)]
    right = [(f"d{i}", some(60, "a"), some(20, "b"), some(20, "b"), rng.choice([None, *range(9)])) for i in range(60)]
    got = cascaded(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), deal_by=deal_by)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_cascade(left, right)


def test_cascade_join_of_nothing(spark):
    none, one = spark.createDataFrame([], LEFT), spark.createDataFrame([(1, "x", "v", None, None)], LEFT)
    assert cascaded(none, spark.createDataFrame([], RIGHT)).collect() == []
    assert [tuple(r) for r in cascaded(one, spark.createDataFrame([], RIGHT)).collect()] == [(1, "x", "v", None, None, None, None, "none")]


def test_a_hot_value_is_salted_and_the_left_side_meets_the_lookup_once(spark):
    zero = "00000000-0000-0000-0000-000000000000"
    left = [(i, "x", None, zero if i % 3 == 0 else f"v{i}", None) for i in range(3000)]
    right = [("d0", None, zero, None, 5), ("d1", None, "v1", None, 4)]
    df = spark.createDataFrame(left, LEFT)
    pairs = df.select(F.lit(1).alias("_rule"), F.col("b").alias("_value"))
    assert [tuple(r) for r in heavy_pairs(pairs).collect()] == [(1, zero)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = cascaded(df, spark.createDataFrame(right, RIGHT))
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(k, str(32 * 1024 * 1024))
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.join_method == "rb" for r in rows) == 1001 and len(rows) == 3000
    assert final.count("SortMergeJoin") + final.count("ShuffledHashJoin") == 1


# ---------------------------------------------------------------- versions by hash

SOURCE = "bk string, v string, vh string"


def runs(spark, deliveries):
    """Tables after each delivery; the surrogate is the key and the run."""
    from playlake.operators.upsert import upsert
    target, inf = None, ntz(dt.datetime(9999, 12, 31))
    for k, rows in enumerate(deliveries):
        ts = ntz(T + k * H)
        out = scd2_by_version_hash(target, spark.createDataFrame(rows, SOURCE), "bk", "vh", ts, inf, "sk",
                                   F.concat_ws("|", F.col("bk"), ts.cast("string")))
        target = out if target is None else upsert(target, out, ["sk"])
    return sorted(((r.bk, r.v, (r.valid_from - T) / H, None if r.valid_to.year == 9999 else (r.valid_to - T) / H)
                   for r in target.collect()), key=repr)


def test_versions_open_and_close(spark):
    one = [("a", "1", "h1"), ("b", "1", "h1"), ("c", "1", "h1"), (None, "n", "h")]
    two = [("a", "1", "h1"), ("b", "2", "h2"), ("d", "1", "h1"), (None, "n", "h")]
    three = [("b", "2", "h2"), ("c", "3", "h3"), ("a", "1", "h1")]
    assert runs(spark, [one, two, three]) == sorted([
        ("a", "1", 0, None), ("b", "1", 0, 1), ("b", "2", 1, None), ("c", "1", 0, 2), ("c", "3", 2, None), ("d", "1", 1, None),
        (None, "n", 0, None), (None, "n", 1, None)], key=repr)


def test_versions_need_one_exchange_and_no_join(spark):
    target = spark.createDataFrame([("s", "a", "1", "h1", T, dt.datetime(9999, 12, 31))],
                                   "sk string, bk string, v string, vh string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    out = scd2_by_version_hash(target, spark.createDataFrame([("a", "2", "h2"), ("a", "3", "h3")], SOURCE), "bk", "vh",
                               ntz(T + H), ntz(dt.datetime(9999, 12, 31)), "sk", F.col("bk"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert sorted((r.sk, r.v, r.valid_to.year) for r in out.collect()) == [("a", "2", 9999), ("a", "3", 9999), ("s", "1", 2024)]


def test_versions_of_nothing(spark):
    assert runs(spark, [[]]) == [] and runs(spark, [[("a", "1", "h")], []]) == [("a", "1", 0, None)]
