"""Batch job: raw feeds -> published Silver and Gold (+ the headline report).

    spark-submit faultline/jobs.py --alarms <dir> --sites <dir> \
        --silver net.silver_alarms --gold net.gold_site_health [--report]

Reads the two Parquet feeds (schemas checked), publishes Silver bucketed by
``alarm_id`` and Gold as catalog tables whose files sit in the shared
checkpoint folder, and optionally prints the ten worst sites. Re-running
replaces both tables (drop and recreate).
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from faultline.operators.medallion import build_gold, build_silver  # noqa: E402
from faultline.operators.metrics import worst_sites  # noqa: E402
from faultline.plans.pipeline import publish_layer  # noqa: E402
from faultline.schemas import ALARMS, SITES  # noqa: E402
from faultline.session import ensure_checkpoint_dir  # noqa: E402
from faultline.sources.tables import read_feed  # noqa: E402


def build_medallion(
    spark: SparkSession,
    alarms_path: str,
    sites_path: str,
    silver_table: str,
    gold_table: str,
    buckets: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Publish Silver and Gold from the raw feeds; return the published tables."""
    ensure_checkpoint_dir(spark)
    alarms = read_feed(spark, alarms_path, ALARMS)
    sites = read_feed(spark, sites_path, SITES)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    silver = publish_layer(build_silver(alarms, sites), silver_table, bucket_by=(n, "alarm_id"))
    gold = publish_layer(build_gold(silver), gold_table)
    return silver, gold


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--alarms", required=True)
    ap.add_argument("--sites", required=True)
    ap.add_argument("--silver", default="silver_alarms")
    ap.add_argument("--gold", default="gold_site_health")
    ap.add_argument("--buckets", type=int, default=None)
    ap.add_argument("--report", action="store_true", help="print the ten worst sites")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("faultline-medallion").getOrCreate()
    _, gold = build_medallion(spark, args.alarms, args.sites, args.silver, args.gold, args.buckets)
    if args.report:
        worst_sites(gold, 10).show(truncate=False)


if __name__ == "__main__":
    main()
