"""Daily loads against a full rebuild; counts from the writing job."""

from __future__ import annotations

import os
import tempfile
import uuid

import pytest
from helpers import alarm, frame, site
from pyspark.sql import functions as F

from faultline.operators import incremental as INC
from faultline.operators.medallion import build_silver
from faultline.operators.quality import validate_silver, written_silver
from faultline.schemas import ALARMS, SITES
from faultline.sources.sinks import write_counted


@pytest.fixture
def tables(spark):
    names = [f"inc_{k}_{uuid.uuid4().hex[:8]}" for k in ("firsts", "silver")]
    yield names
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_three_loads_equal_a_full_rebuild(spark, tables):
    """Late alarms, repeats in another day's load, an earlier copy that moves an alarm to another day, incomplete first copies, an empty day."""
    sites = frame(spark, [site("SITE-00001"), site("SITE-00002", region="R2")], SITES)
    loads = [
        [alarm("A1", raised="2024-01-01 10:00:00"), alarm("A2", raised="2024-01-01 11:00:00"), alarm("A1", raised="2024-01-01 10:00:00"),
         alarm("A3", site_id=None, raised="2024-01-01 12:00:00"), alarm("A9", raised="2024-01-05 09:00:00")],
        [alarm("A4", raised="2024-01-02 10:00:00"), alarm("A1", raised="2024-01-02 08:00:00"), alarm("A3", raised="2024-01-02 12:00:00"),
         alarm("A5", raised="2024-01-01 23:00:00", severity=None), alarm("A9", raised="2024-01-02 07:00:00")],
        [alarm("A4", raised="2024-01-02 10:00:00"), alarm("A6", raised="2024-01-01 01:00:00", site_id="SITE-00002"),
         alarm("A2", raised="2023-12-31 11:00:00", severity=None), alarm("A7", raised="2024-01-03 10:00:00", site_id="SITE-77777")],
    ]
    INC.create_tables(spark, sites, *tables)
    written_days = [INC.load(frame(spark, rows, ALARMS), sites, *tables) for rows in loads]
    whole = build_silver(frame(spark, [r for rows in loads for r in rows], ALARMS), sites)
    assert rows_of(spark.table(tables[1])) == rows_of(whole) != []
    assert written_days == [["2024-01-01", "2024-01-05"], ["2024-01-01", "2024-01-02", "2024-01-05"], ["2023-12-31", "2024-01-01", "2024-01-03"]]
    # A9 left its day, which no longer has a partition.
    days = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {tables[1]}").collect()}
    assert days == {"event_date=2024-01-01", "event_date=2024-01-02"}


def test_repeated_and_empty_loads_write_nothing(spark, tables):
    sites = frame(spark, [site("SITE-00001")], SITES)
    rows = frame(spark, [alarm("A1"), alarm("A2", raised="2024-01-03 10:00:00")], ALARMS)
    INC.create_tables(spark, sites, *tables)
    INC.create_tables(spark, sites, *tables)
    assert INC.load(rows, sites, *tables) == ["2024-01-01", "2024-01-03"]
    assert INC.load(rows, sites, *tables) == [] == INC.load(rows.limit(0), sites, *tables)
    assert spark.table(tables[1]).count() == 2


def test_a_load_that_failed_after_silver_can_be_run_again(spark, tables, monkeypatch):
    sites = frame(spark, [site("SITE-00001")], SITES)
    first = frame(spark, [alarm("A1"), alarm("A2", raised="2024-01-03 10:00:00")], ALARMS)
    second = frame(spark, [alarm("A2", raised="2024-01-02 10:00:00"), alarm("A3", raised="2024-01-03 11:00:00")], ALARMS)
    INC.create_tables(spark, sites, *tables)
    INC.load(first, sites, *tables)
    switch = INC._switch

    def stop_at_firsts(df, table, days):
        if table == tables[0]:
            raise RuntimeError("lost")
        switch(df, table, days)

    monkeypatch.setattr(INC, "_switch", stop_at_firsts)
    with pytest.raises(RuntimeError):
        INC.load(second, sites, *tables)
    monkeypatch.setattr(INC, "_switch", switch)
    assert INC.load(second, sites, *tables) == ["2024-01-02", "2024-01-03"]
    assert rows_of(spark.table(tables[1])) == rows_of(build_silver(first.unionByName(second), sites))


def test_days_of_the_fixture_feed_one_by_one(spark, layers_small, tables):
    """The feed in three loads by hash, so that every load touches all days."""
    alarms, sites = layers_small.alarms(), layers_small.sites()
    INC.create_tables(spark, sites, *tables)
    for i in range(3):
        INC.load(alarms.where(F.pmod(F.xxhash64("alarm_id", "site_id"), F.lit(3)) == i), sites, *tables)
    assert rows_of(spark.table(tables[1])) == rows_of(layers_small.silver())


def jobs_of(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_counts_come_from_the_write(spark, layers_small):
    folder, found = tempfile.mkdtemp(prefix="counted-"), {}
    counts = {"rows": F.count(F.lit(1)), "null_site_id": F.count_if(F.col("site_id").isNull()), "last": F.max("raised_ts")}
    jobs = jobs_of(spark, lambda: found.update(write_counted(layers_small.alarms(), os.path.join(folder, "a"), counts)))
    back = spark.read.parquet(os.path.join(folder, "a"))
    assert jobs == 1 and (found["rows"], found["null_site_id"]) == (1025, 25) == (back.count(), back.where("site_id is null").count())
    assert write_counted(layers_small.alarms().limit(0), os.path.join(folder, "b"), {"rows": F.count(F.lit(1))}) == {"rows": 0}


def test_silver_is_validated_by_its_own_write(spark, layers_small):
    folder = tempfile.mkdtemp(prefix="silver-counted-")
    got = written_silver(layers_small.alarms(), layers_small.sites(), folder + "/silver")
    assert got == validate_silver(layers_small.alarms(), layers_small.silver()).first().asDict()
    assert rows_of(spark.read.parquet(folder + "/silver")) == rows_of(layers_small.silver())
