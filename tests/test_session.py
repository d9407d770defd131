import os
import subprocess
import sys
import tempfile
import threading

from playlake.sources.sinks import materialize, scratch_scope

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_a_session_without_a_checkpoint_folder_makes_one_and_keeps_it():
    code = ("from playlake.session import build_session, checkpoint_dir\n"
            "from playlake.sources.sinks import materialize\n"
            "s = build_session('local[1]', 1)\n"
            "assert not s.conf.get('spark.checkpoint.dir', None)\n"
            "a = materialize(s.range(3), 'a'); b = materialize(s.range(4), 'b')\n"
            "print(a.count(), b.count(), checkpoint_dir(s) == checkpoint_dir(s))\n")
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="playlake-conf-"), PYTHONPATH=ROOT)
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.stdout.split() == ["3", "4", "True"], done.stderr[-2000:]


def test_a_scope_leaves_tables_of_other_threads_alone(spark):
    made = {}

    def other():
        made["other"] = materialize(spark.range(5), "other")

    with scratch_scope(spark):
        made["mine"] = materialize(spark.range(3), "mine")
        with scratch_scope(spark):
            materialize(spark.range(1), "inner")
        assert made["mine"].count() == 3
        t = threading.Thread(target=other)
        t.start()
        t.join()
    assert made["other"].count() == 5


def test_a_missing_library_leaves_the_core_queries(monkeypatch):
    import __spark_entry__ as entry
    for name in [m for m in sys.modules if m.startswith("playlake.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "playlake.llm.catalog", None)
    found = entry.queries()
    assert "fct_sessions" in found and "pipeline" not in found and not any(k.startswith("op") for k in found)


def test_the_window_of_the_queries_comes_from_the_table(spark, tmp_path):
    import datetime as dt

    from playlake.config import RunWindow
    from playlake.plans import catalog

    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(*cols)
    late = ev.selectExpr("event_id", "ts + INTERVAL 1 YEAR AS ts", "user_id", "event_type", "value", "props")
    late.write.parquet(str(tmp_path / "events.parquet"))
    i = catalog.Inputs(spark, str(tmp_path))
    first, last = late.selectExpr("min(to_date(ts))", "max(to_date(ts))").first()
    assert i.window == RunWindow(first, last + dt.timedelta(days=1), dt.datetime.combine(last, dt.time()) + dt.timedelta(days=1))
    assert i.stg_events().select("event_id").distinct().count() == i.stg_events().count() > 0.9 * late.count()
    merged = {q: catalog.QUERIES[q](spark, str(tmp_path)) for q in ("merge_null_day", "merge_schema_evolution")}
    assert merged["merge_null_day"].select("k").distinct().count() == late.select("event_id").distinct().count()
    assert merged["merge_schema_evolution"].count() == 2 * late.count()
    assert {r.v for r in merged["merge_null_day"].select("v").distinct().collect()} == {"first", "second"}
    narrow = RunWindow(first, first + dt.timedelta(days=2), dt.datetime.combine(first, dt.time()))
    assert catalog.Inputs(spark, str(tmp_path), "narrow", narrow).stg_events().selectExpr("max(to_date(event_timestamp))").first()[0] < narrow.end
