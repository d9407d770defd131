"""Benchmark: the daily pipeline at $BENCH_SF_DIR on local[$BENCH_CPUS].

Runs the jobs in dependency order the way a scheduled run would: the staging
tables (stg_events, stg_sessions, the device-attributed installs) are written
once, every other job is executed in full into Spark's no-op sink (no driver
collect).  One untimed warm-up pass (JVM, JIT, codegen), then $BENCH_RUNS timed
passes (default 3); each job reports its median.  Prints one JSON line with
per-job wall seconds and their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from playlake.plans import ads, facts, installs  # noqa: E402
from playlake.plans.catalog import Inputs, q_merge_null_day, q_merge_schema_evolution  # noqa: E402
from playlake.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="playlake-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    def steps(i: Inputs):
        return [
            ("stg_events", lambda: i.stg_events()),
            ("stg_sessions", lambda: i.stg_sessions()),
            ("stg_devices", lambda: run(i.stg_devices())),
            ("dim_devices", lambda: run(i.dim_devices())),
            ("dim_devices_scd", lambda: run(i.dim_devices_scd())),
            ("dim_device_users_scd", lambda: run(i.dim_device_users_scd())),
            ("stg_attribution", lambda: run(i.stg_attribution())),
            ("int_device_attributed_installs", lambda: run(i.dai())),
            ("user_attributed_installs", lambda: run(installs.user_attributed_installs(i.fct_dai(),
                                                                                       i.dim_device_users_scd()))),
            ("attribution_mapping_full", lambda: run(installs.attribution_mapping(i.dai(), i.dim_device_users_scd(),
                                                                                  i.run_ts))),
            ("dim_users", lambda: run(i.dim_users())),
            ("fct_sessions", lambda: run(i.fct_sessions())),
            ("fct_events", lambda: run(i.fct_events())),
            ("fct_user_acquisition_daily", lambda: run(ads.fct_user_acquisition_daily(i.ad_platform(),
                                                                                      i.daily_installs()))),
            ("user_activity", lambda: run(facts.user_activity(i.stg_events(), i.dim_users(), i.window.as_of))),
            ("merge_null_day", lambda: run(q_merge_null_day(spark, sf_dir))),
            ("merge_schema_evolution", lambda: run(q_merge_schema_evolution(spark, sf_dir))),
        ]

    def one_pass() -> dict[str, float]:
        out = {}
        for name, fn in steps(Inputs(spark, sf_dir)):
            t0 = time.perf_counter()
            fn()
            out[name] = time.perf_counter() - t0
        return out

    one_pass()  # warm-up
    runs = [one_pass() for _ in range(int(os.environ.get("BENCH_RUNS", "3")))]
    times = {k: round(statistics.median(r[k] for r in runs), 3) for k in runs[0]}
    print(json.dumps({"metric": "pipeline_wall_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
