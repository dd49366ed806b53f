"""Spark session settings used by the library, tests and the benchmark.

The library never creates a session behind the caller's back; these helpers
exist for scripts and tests. On a cluster the caller's own session is used
as is, and only ``spark.checkpoint.dir`` is read from it.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session should carry. Timestamps in the feeds are
# ``timestamp_ntz``; date formatting and minute differences are defined in
# UTC, so the session zone must be UTC for results to be stable.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # No broadcast from a planner size *estimate* (file sizes can understate
    # a table many times). Broadcasts happen only behind an explicit measurement
    # of bytes (``bounded_broadcast``) or when adaptive execution has *measured*
    # a shuffle side below the adaptive threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot site of the Silver join also where Gold's aggregates sit on it and the split
    # costs them an exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "faultline",
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or return) a session with the library's settings.

    ``master`` defaults to ``local[$BENCH_CPUS]`` or ``local[*]``; on a
    cluster pass ``None`` and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None:
        cpus = os.environ.get("BENCH_CPUS")
        master = f"local[{cpus}]" if cpus else "local[*]"
    builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local session (a laptop, a test run) without one gets a scratch folder; on a cluster
    a folder on the driver's disk would be out of the executors' reach, so this raises.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="faultline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current
