"""Layer invariants, expectations with reasons, profiling twins."""

from __future__ import annotations

from helpers import alarm, frame, site
from pyspark.sql import functions as F

from faultline.operators import profile as P
from faultline.operators import quality as Q
from faultline.schemas import ALARMS, SITES


def test_silver_invariants_on_fixture(layers_small):
    v = Q.validate_silver(layers_small.alarms(), layers_small.silver()).collect()[0]
    assert v.raw_alarm_rows == 1025
    assert v.silver_rows == 950
    assert (v.null_site_id, v.null_severity, v.duplicate_alarm_ids) == (0, 0, 0)
    assert v.silver_rows < v.raw_alarm_rows


def test_sites_dimension_has_unique_ids(layers_small, spark):
    v = Q.validate_sites(layers_small.sites()).collect()[0]
    assert (v.site_rows, v.distinct_sites, v.duplicate_site_ids, v.null_coords) == (150, 150, 0, 0)
    dup = frame(spark, [site("S1"), site("S1", lat=None)], SITES)
    d = Q.validate_sites(dup).collect()[0]
    assert (d.duplicate_site_ids, d.null_coords) == (1, 1)


def test_gold_invariants_on_fixture(layers_small):
    g = Q.validate_gold(layers_small.gold()).collect()[0]
    assert g.site_rows == g.distinct_sites == 15
    assert g.null_coords == 0


def test_rejects_and_silver_partition_the_raw_feed(layers_small):
    raw = layers_small.alarms().count()
    rejected = Q.silver_rejects(layers_small.alarms(), layers_small.sites())
    assert rejected.count() + layers_small.silver().count() == raw
    assert rejected.where(F.size("reasons") == 0).count() == 0


def test_reasons_list_every_broken_rule(spark):
    rows = [
        alarm("A1", site_id=None, severity=None, raised="2024-01-01 10:00:00"),
        alarm("A1", raised="2024-01-01 11:00:00"),
        alarm("A2", site_id="SITE-77777"),
        alarm("A3"),
    ]
    alarms, sites = frame(spark, rows, ALARMS), frame(spark, [site("SITE-00001")], SITES)
    got = sorted(
        (r.alarm_id, tuple(r.reasons)) for r in Q.silver_rejects(alarms, sites).collect()
    )
    assert got == [
        ("A1", ("first_copy_of_alarm",)),
        ("A1", ("site_id_not_null", "severity_not_null")),
        ("A2", ("site_known",)),
    ]
    same = Q.silver_rejects(alarms, sites, max_broadcast_bytes=0)
    assert sorted((r.alarm_id, tuple(r.reasons)) for r in same.collect()) == got
    counts = {r.rule: r.failed_rows for r in Q.silver_expectation_counts(alarms, sites).collect()}
    assert counts == {"first_copy_of_alarm": 1, "site_id_not_null": 1, "severity_not_null": 1, "site_known": 1}


def test_expect_modes(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    rules = {"x_set": F.col("x").isNotNull(), "x_small": F.col("x") < 3}
    kept, rejected = Q.expect(df, rules, "drop")
    assert [r.x for r in kept.collect()] == [1]
    assert rejected.count() == 2
    kept, _ = Q.expect(df, rules, "warn")
    assert kept.count() == 3
    try:
        Q.expect(df, rules, "fail")
        raise AssertionError("expected failure")
    except ValueError:
        pass


def test_profile_dataframe_and_sql_twins(spark, layers_small):
    alarms = layers_small.alarms()
    alarms.createOrReplaceTempView("alarms_raw")
    df_nulls = P.null_profile(alarms, ["site_id", "severity"]).collect()[0]
    sql_nulls = spark.sql(
        """SELECT SUM(CASE WHEN site_id IS NULL THEN 1 ELSE 0 END) AS null_site_id,
                  SUM(CASE WHEN severity IS NULL THEN 1 ELSE 0 END) AS null_severity,
                  COUNT(*) AS total_rows FROM alarms_raw"""
    ).collect()[0]
    assert tuple(df_nulls) == tuple(sql_nulls) == (25, 32, 1025)

    df_dup = P.duplicate_profile(alarms, "alarm_id").collect()[0]
    sql_dup = spark.sql(
        """SELECT COUNT(*) AS rows_total, COUNT(DISTINCT alarm_id) AS distinct_alarm_ids,
                  COUNT(*) - COUNT(DISTINCT alarm_id) AS duplicate_rows FROM alarms_raw"""
    ).collect()[0]
    assert tuple(df_dup) == tuple(sql_dup) == (1025, 1000, 25)

    df_dist = {r.severity: r.alarms for r in P.distribution(alarms, "severity").collect()}
    sql_dist = {
        r.severity: r.alarms
        for r in spark.sql("SELECT severity, COUNT(*) AS alarms FROM alarms_raw GROUP BY severity").collect()
    }
    assert df_dist == sql_dist and None in df_dist


def test_approximate_duplicate_profile_is_close(layers_small):
    exact = P.duplicate_profile(layers_small.alarms(), "alarm_id").collect()[0]
    approx = P.duplicate_profile(layers_small.alarms(), "alarm_id", exact=False).collect()[0]
    assert abs(approx.distinct_alarm_ids - exact.distinct_alarm_ids) <= 0.05 * exact.distinct_alarm_ids


def test_range_profile(spark):
    sites = frame(spark, [site("S1", "R", lat=30.123, lon=-90.5), site("S2", "R", lat=31.456, lon=-91.25)], SITES)
    r = P.range_profile(sites, "region", {"latitude": "lat", "longitude": "lon"}, "sites").collect()[0]
    assert (r.sites, r.min_lat, r.max_lat, r.min_lon, r.max_lon) == (2, 30.12, 31.46, -91.25, -90.5)


def test_clear_time_summary_against_brute_force(layers_small):
    """Quartiles are the nearest ranks."""
    import math

    from faultline.operators import metrics as M

    got = {r.region: r for r in M.clear_time_summary(layers_small.silver(), "region").collect()}
    values: dict[str, list[int]] = {}
    for r in layers_small.silver().where("time_to_clear_min IS NOT NULL").select("region", "time_to_clear_min").collect():
        values.setdefault(r.region, []).append(r.time_to_clear_min)
    assert set(got) == set(values)
    for region, v in values.items():
        v.sort()
        g = got[region]
        assert (g.cleared_alarms, g.min_min, g.max_min) == (len(v), v[0], v[-1])
        for q, name in ((0.25, "p25_min"), (0.5, "p50_min"), (0.75, "p75_min"), (0.95, "p95_min")):
            assert g[name] == v[max(0, math.ceil(q * len(v)) - 1)], (region, name)
