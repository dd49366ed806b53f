"""Scans, sinks, catalog helpers, fixture feeds and generators."""

from __future__ import annotations

import os
import tempfile

import pytest
from helpers import SF_SMALL
from pyspark.sql import functions as F

from faultline.operators.joins import bounded_broadcast, measured_bytes
from faultline.operators.profile import duplicate_profile, null_profile
from faultline.schemas import ALARMS, SITES, SchemaMismatch, check_schema
from faultline.sources import generate as GEN
from faultline.sources import sinks
from faultline.sources.tables import preview, read_feed, read_files_sql, scan_named


def test_fixture_feeds_have_declared_schemas(layers_small):
    check_schema(layers_small.alarms(), ALARMS, "alarms")
    check_schema(layers_small.sites(), SITES, "sites")
    assert layers_small.sites().count() == 150
    assert layers_small.alarms().count() == 1025


def test_write_read_and_sql_path_scan(spark, layers_small):
    out = tempfile.mkdtemp(prefix="feed-")
    path = sinks.write_feed(layers_small.sites(), os.path.join(out, "sites"))
    back = read_feed(spark, path, SITES)
    assert back.count() == 150
    assert read_files_sql(spark, path).count() == 150
    with pytest.raises(SchemaMismatch):
        read_feed(spark, path, ALARMS)


def test_publish_replace_and_list(spark, layers_small):
    assert sinks.ensure_schema(spark, "faultline_test")
    t = sinks.publish(layers_small.sites(), "faultline_test.sites_raw")
    assert t.count() == 150
    # Re-publishing with another schema replaces the table.
    t2 = sinks.publish(layers_small.sites().select("site_id"), "faultline_test.sites_raw")
    assert t2.columns == ["site_id"]
    assert "sites_raw" in sinks.list_tables(spark, "faultline_test")
    assert scan_named(spark, "faultline_test.sites_raw").count() == 150
    assert not sinks.try_sql(spark, "SELECT * FROM no_such_table_here", "probe")
    spark.catalog.setCurrentDatabase("default")


def test_preview_is_ordered(layers_small):
    rows = preview(layers_small.alarms(), 5, ["alarm_id"]).collect()
    assert [r.alarm_id for r in rows] == sorted(r.alarm_id for r in rows)
    assert len(rows) == 5


def test_bounded_broadcast(spark):
    small = spark.range(10)
    assert measured_bytes(small) == 160 and measured_bytes(small.where("false")) == 0
    plan_small = spark.range(1000).join(bounded_broadcast(small, 160), "id")._jdf.queryExecution().toString()
    assert "broadcast" in plan_small.lower()
    big = spark.range(1000)
    assert bounded_broadcast(big, 160) is big
    # few rows of long texts are not small
    long = spark.range(3).select("id", F.repeat(F.lit("x"), 100_000).alias("t"))
    assert bounded_broadcast(long, 200_000) is long


def test_a_replaced_file_is_measured_again(spark):
    import tempfile

    path = tempfile.mkdtemp(prefix="grown-") + "/t"
    spark.range(5).write.parquet(path)
    first = measured_bytes(spark.read.parquet(path))
    spark.range(5000).write.mode("overwrite").parquet(path)
    assert measured_bytes(spark.read.parquet(path)) == 1000 * first


def test_generated_sites(spark):
    sites = GEN.generate_sites(spark.range(12000))
    check_schema(sites, SITES, "generated sites")
    rows = {r.site_id: r for r in sites.where(F.col("site_id").isin("SITE-00003", "SITE-11003")).collect()}
    assert rows["SITE-00003"].region == "NewYork" and rows["SITE-00003"].site_name == "NY-NEW-0003"
    # Labels never truncate past 9,999 sites.
    assert rows["SITE-11003"].site_name == "NY-NEW-11003"
    r = sites.agg(F.min("latitude"), F.max("latitude"), F.countDistinct("vendor"), F.countDistinct("equipment_type")).collect()[0]
    assert 25.4 < r[0] and r[1] < 47.95 and r[2] == 3 and r[3] == 5


def test_generated_alarm_rates(spark):
    n = 200_000
    feed = GEN.generate_alarm_feed(spark.range(n), n_sites=1000)
    check_schema(feed, ALARMS, "generated alarms")
    nulls = null_profile(feed, ["site_id", "severity"]).collect()[0]
    assert nulls.total_rows == n + 5000
    assert 0.017 < nulls.null_site_id / nulls.total_rows < 0.023
    assert 0.026 < nulls.null_severity / nulls.total_rows < 0.034
    dup = duplicate_profile(feed, "alarm_id").collect()[0]
    assert dup.duplicate_rows == 5000
    s = feed.agg(
        F.countDistinct("site_id").alias("sites"),
        F.avg(F.col("cleared_ts").isNull().cast("double")).alias("open_rate"),
        F.min(F.expr("timestampdiff(MINUTE, raised_ts, cleared_ts)")).alias("min_clear"),
        F.max(F.expr("timestampdiff(MINUTE, raised_ts, cleared_ts)")).alias("max_clear"),
        F.countDistinct("event_date").alias("days"),
    ).collect()[0]
    assert s.sites == 1000 and 0.13 < s.open_rate < 0.17
    assert s.min_clear >= 5 and s.max_clear <= 599 and s.days in (60, 61)
    statuses = {r.status for r in feed.where(F.col("cleared_ts").isNull()).select("status").distinct().collect()}
    assert statuses == {"ACTIVE", "ACKNOWLEDGED"}


def test_generators_are_reproducible(spark):
    a = GEN.generate_alarms(spark.range(500), 10).collect()
    b = GEN.generate_alarms(spark.range(500).repartition(7), 10).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_events_drive_generator(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert GEN.generate_alarms(events, 1000, "event_id").count() == events.count()


def test_checkpoint_dir_is_read_from_the_session(spark, layers_small):
    from faultline.plans.pipeline import materialize
    from faultline.session import ensure_checkpoint_dir

    configured = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == configured  # never replaced once set
    from urllib.parse import urlparse

    out = materialize(layers_small.sites(), "sites_probe")
    prefix = urlparse(configured).path.rstrip("/") + "/faultline/sites_probe-"
    assert out.inputFiles() and all(urlparse(f).path.startswith(prefix) for f in out.inputFiles())
    assert out.count() == 150
