"""The batch job publishes Silver and Gold from Parquet feeds, zoned timestamps included."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from faultline.jobs import build_medallion, main
from faultline.sources.sinks import write_feed


def test_job_publishes_both_layers(spark, layers_small):
    base = tempfile.mkdtemp(prefix="job-")
    # feeds as the reference's generator writes them: zoned timestamps
    alarms = layers_small.alarms()
    for c in ("raised_ts", "cleared_ts"):
        alarms = alarms.withColumn(c, F.col(c).cast("timestamp"))
    sites = layers_small.sites().withColumn("install_date", F.col("install_date").cast("timestamp"))
    a = write_feed(alarms, os.path.join(base, "alarms"))
    s = write_feed(sites, os.path.join(base, "sites"))
    silver, gold = build_medallion(spark, a, s, "job_silver", "job_gold")
    assert silver.count() == 950 and gold.count() == 15
    assert dict(silver.dtypes)["raised_ts"] == "timestamp_ntz"
    assert silver.exceptAll(layers_small.silver()).count() == 0
    main(["--alarms", a, "--sites", s, "--silver", "job_silver", "--gold", "job_gold", "--report"])
    assert spark.table("job_gold").count() == 15
