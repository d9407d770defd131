"""SparkSession construction and shared-storage locations."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "playlake") -> SparkSession:
    """A session configured for these jobs: AQE (coalescing, skew join), UTC, no UI."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a broadcast happens only when runtime statistics prove the side small
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # call sites are not looked up for each Column: the plans here have hundreds of them
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = os.environ.get("PLAYLAKE_DRIVER_MEMORY", "8g")
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: the scratch folder of a local session that names none (tests)
_scratch: str | None = None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (spark.checkpoint.dir).

    Only when the setting is absent in a local session (tests) is a scratch folder created,
    once a process.  On a cluster, or over Spark Connect, a machine-local folder would lose rows, so
    there the setting must be given.
    """
    global _scratch
    try:
        sc = spark.sparkContext  # absent on Spark Connect sessions
    except Exception:  # noqa: BLE001
        sc = None
    known = sc.getCheckpointDir() if sc is not None else None
    master = spark.conf.get("spark.master", "local") if sc is not None else "a remote session"
    local = re.fullmatch(r"local(\[[^\]]*\])?", master) is not None
    d = spark.conf.get("spark.checkpoint.dir", None) or (_scratch if local else None) or known
    if not d:
        if not local:
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        d = _scratch = tempfile.mkdtemp(prefix="playlake-ckpt-", dir=os.environ.get("PLAYLAKE_SCRATCH", "/tmp"))
    if sc is not None and known is None:
        sc.setCheckpointDir(d)
    return d
