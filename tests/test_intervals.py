import datetime as dt
import random

from playlake.operators.intervals import explode_cells, point_in_interval_join

T = dt.datetime(2024, 1, 10, 12)


def test_half_open_vs_closed_end(spark):
    iv = spark.createDataFrame([("d", T - dt.timedelta(days=3), T), ("d", T + dt.timedelta(microseconds=1), None)],
                               "k string, vf timestamp_ntz, vt timestamp_ntz")
    from pyspark.sql import functions as F
    iv = iv.withColumn("vt", F.coalesce("vt", F.lit("9999-12-31 23:59:59").cast("timestamp_ntz")))
    pts = spark.createDataFrame([("d", T, 1), ("d", T - dt.timedelta(days=2), 2), ("x", T, 3)],
                                "dev string, ts timestamp_ntz, id int")
    half = point_in_interval_join(pts, iv, "dev", "k", "ts", "vf", "vt", closed_end=False)
    closed = point_in_interval_join(pts, iv, "dev", "k", "ts", "vf", "vt", closed_end=True)
    h = sorted((r.id, r.vf is not None) for r in half.collect())
    c = sorted((r.id, r.vf is not None) for r in closed.collect())
    assert h == [(1, False), (2, True), (3, False)]   # start exactly at valid_to: no match
    assert c == [(1, True), (2, True), (3, False)]    # BETWEEN matches it


def test_overlapping_intervals_all_returned(spark):
    iv = spark.createDataFrame([("d", T - dt.timedelta(days=40), T + dt.timedelta(days=1)),
                                ("d", T - dt.timedelta(hours=1), T + dt.timedelta(hours=1))],
                               "k string, vf timestamp_ntz, vt timestamp_ntz")
    pts = spark.createDataFrame([("d", T)], "dev string, ts timestamp_ntz")
    assert point_in_interval_join(pts, iv, "dev", "k", "ts", "vf", "vt", closed_end=False, how="inner").count() == 2


def test_open_long_and_backwards_intervals(spark):
    rng = random.Random(4)
    far = dt.datetime(9999, 12, 31, 23, 59, 59)
    iv = [(rng.choice("ab"), a, a + dt.timedelta(seconds=rng.choice([0, 5, 90_000, 10**7, 10**9, -50])))
          for a in (T + dt.timedelta(hours=rng.randint(-40_000, 40_000)) for _ in range(60))]
    iv += [("a", dt.datetime(1, 1, 1), far), ("b", T, far), (None, T, far)]
    pts = [(rng.choice(["a", "b", "c", None]), T + dt.timedelta(hours=rng.randint(-50_000, 50_000)), i) for i in range(150)]
    pts += [("a", dt.datetime(2099, 1, 1), 900), ("a", None, 901), ("b", far, 902), ("a", T, 903), ("a", T, 904)]
    p = spark.createDataFrame(pts, "dev string, ts timestamp_ntz, id int")
    i = spark.createDataFrame([(k, *x) for k, x in enumerate(iv)], "n int, k string, vf timestamp_ntz, vt timestamp_ntz")
    for closed in (True, False):
        want = {(q[2], n) for q in pts for n, (k, a, z) in enumerate(iv)
                if q[0] is not None and q[0] == k and q[1] is not None and a <= q[1] and (q[1] <= z if closed else q[1] < z)}
        got = point_in_interval_join(p, i, "dev", "k", "ts", "vf", "vt", closed_end=closed, how="inner").collect()
        assert sorted((r.id, r.n) for r in got) == sorted(want)
        left = point_in_interval_join(p, i, "dev", "k", "ts", "vf", "vt", closed_end=closed).collect()
        assert {r.id for r in left} == {q[2] for q in pts} and {(r.id, r.n) for r in left if r.n is not None} == want
        assert sum(r.n is None for r in left) == len(pts) - len({w[0] for w in want})


def test_cells_of_an_interval_are_few_and_disjoint(spark):
    rng = random.Random(5)
    days = dt.date(9999, 12, 31).toordinal()
    iv = [(n, dt.datetime.fromordinal(a), dt.datetime.fromordinal(z)) for n, (a, z) in enumerate(
        sorted(rng.sample(range(1, days + 1), 2)) for _ in range(200))]
    iv += [(500, T, dt.datetime(9999, 12, 31)), (501, T, T)]
    cells = explode_cells(spark.createDataFrame(iv, "n int, s timestamp_ntz, e timestamp_ntz"), "s", "e").collect()
    by = {}
    for c in cells:
        by.setdefault(c.n, []).append((c["_cell"] * c["_width"], c["_cell"] * c["_width"] + c["_width"]))
    for n, s, e in iv:
        spans = sorted(by[n])
        assert len(spans) < 100
        assert spans[0][0] == s.toordinal() - 1 and spans[-1][1] == e.toordinal()
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_the_join_is_lazy(spark):
    def never(_):
        raise AssertionError("a job ran while the plan was built")
    pts = spark.createDataFrame([("d", T)], "dev string, ts timestamp_ntz").mapInPandas(never, "dev string, ts timestamp_ntz")
    iv = spark.createDataFrame([("d", T, T)], "k string, vf timestamp_ntz, vt timestamp_ntz")
    assert point_in_interval_join(pts, iv, "dev", "k", "ts", "vf", "vt", closed_end=False).columns == ["dev", "ts", "k", "vf", "vt"]
