import datetime as dt
import os
import tempfile

import pytest

from playlake.operators.upsert import DuplicateMatchError
from playlake.sources.sinks import materialize, merge_into_table, read_table, scratch_scope

T = dt.datetime(2024, 1, 10, 8)


def test_partition_scoped_merge_moves_rows_between_days(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="playlake-sink-"), "t")
    schema = "k int, ts timestamp_ntz, v string"
    first = spark.createDataFrame([(1, T, "a"), (2, T, "b"), (3, T + dt.timedelta(days=1), "c")], schema)
    merge_into_table(first, path, ["k"], partition_day_of="ts")
    # key 1 moves to a new day, key 2 is updated in place, key 4 is new; day of key 3 untouched
    src = spark.createDataFrame([(1, T + dt.timedelta(days=5), "a2"), (2, T, "b2"), (4, T, "d")], schema)
    merge_into_table(src, path, ["k"], partition_day_of="ts")
    got = sorted((r.k, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a2"), (2, "b2"), (3, "c"), (4, "d")]
    # a day emptied by the merge is dropped, not left with stale rows
    third = spark.createDataFrame([(2, T + dt.timedelta(days=5), "b3"), (4, T + dt.timedelta(days=5), "d3")], schema)
    merge_into_table(third, path, ["k"], partition_day_of="ts")
    days = sorted(d for d in os.listdir(path) if d.startswith("ts_day="))
    assert days == ["ts_day=2024-01-11", "ts_day=2024-01-15"]
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a2"), (2, "b3"), (3, "c"), (4, "d3")]


def _rows(spark, path):
    return sorted((tuple(r) for r in read_table(spark, path, "ts_day").drop("ts_day").collect()), key=repr)


def test_rows_without_a_day_survive_a_merge(spark, tmp_path):
    schema = "k int, ts timestamp_ntz, v string"
    path = str(tmp_path / "t")
    merge_into_table(spark.createDataFrame([(1, None, "a"), (2, T, "b")], schema), path, ["k"], "ts")
    merge_into_table(spark.createDataFrame([(9, None, "c"), (8, T, "d")], schema), path, ["k"], "ts")
    assert _rows(spark, path) == [(1, None, "a"), (2, T, "b"), (8, T, "d"), (9, None, "c")]
    # only NULL days touched; then the last NULL-day rows move to a day
    merge_into_table(spark.createDataFrame([(1, None, "a2")], schema), path, ["k"], "ts")
    merge_into_table(spark.createDataFrame([(1, T, "a3"), (9, T, "c3")], schema), path, ["k"], "ts")
    assert _rows(spark, path) == [(1, T, "a3"), (2, T, "b"), (8, T, "d"), (9, T, "c3")]


def test_all_days_null(spark, tmp_path):
    schema = "k int, ts timestamp_ntz, v string"
    path = str(tmp_path / "t")
    for v in ("a", "b"):
        merge_into_table(spark.createDataFrame([(1, None, v), (2, None, v)], schema), path, ["k"], "ts")
    assert _rows(spark, path) == [(1, None, "b"), (2, None, "b")]


@pytest.mark.parametrize("policy,want", [
    ("append_new_columns", [(1, T, "a", None), (2, T + dt.timedelta(days=3), None, 5)]),
    ("sync_all_columns", [(1, T, None), (2, T + dt.timedelta(days=3), 5)])])
def test_schema_changes_reach_untouched_days(spark, tmp_path, policy, want):
    path = str(tmp_path / "t")
    later = T + dt.timedelta(days=3)
    merge_into_table(spark.createDataFrame([(1, T, "a"), (2, later, "b")], "k int, ts timestamp_ntz, v string"), path, ["k"], "ts")
    merge_into_table(spark.createDataFrame([(2, later, 5)], "k int, ts timestamp_ntz, w int"), path, ["k"], "ts", policy=policy)
    assert _rows(spark, path) == want


def test_two_source_rows_for_one_target_row_raise(spark, tmp_path):
    schema = "k int, ts timestamp_ntz, v string"
    for i, day in enumerate(("ts", None)):
        path = str(tmp_path / f"t{i}")
        merge_into_table(spark.createDataFrame([(1, T, "a")], schema), path, ["k"], day)
        with pytest.raises(DuplicateMatchError):
            merge_into_table(spark.createDataFrame([(1, T, "b"), (1, T, "c")], schema), path, ["k"], day)


def test_replaced_entities_leave_no_stale_rows(spark, tmp_path):
    schema = "k int, e string, ts timestamp_ntz"
    path = str(tmp_path / "t")
    merge_into_table(spark.createDataFrame([(1, "x", T), (2, "x", T), (3, "y", T)], schema), path, ["k"], "ts")
    merge_into_table(spark.createDataFrame([(4, "x", T)], schema), path, ["k"], "ts", replace_on=["e"])
    assert _rows(spark, path) == [(3, "y", T), (4, "x", T)]


def test_temporary_tables_go_with_their_scope(spark):
    from playlake.session import checkpoint_dir
    with scratch_scope(spark):
        kept = materialize(spark.range(3), "scoped")
        (path,) = {os.path.dirname(f) for f in kept.inputFiles()}
        assert os.path.exists(path.removeprefix("file:").replace("//", "/"))
    assert not os.path.exists(path.removeprefix("file:").replace("//", "/"))
    assert checkpoint_dir(spark)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from playlake import session

    class Conf(dict):
        pass

    class Fake:
        conf = Conf({"spark.master": "spark://host:7077"})
        sparkContext = type("C", (), {"getCheckpointDir": staticmethod(lambda: None)})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Fake())
