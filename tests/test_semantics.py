"""Hand-made frames for the traps of the Silver / Gold / metric semantics."""

from __future__ import annotations

from helpers import alarm, frame, site
from pyspark.sql import functions as F

from faultline.operators import metrics as M
from faultline.operators.medallion import build_gold, build_silver
from faultline.schemas import ALARMS, GOLD, SILVER, SITES


def _silver(spark, alarms, sites):
    return build_silver(frame(spark, alarms, ALARMS), frame(spark, sites, SITES))


def test_dedupe_before_null_filter(spark):
    # Earliest copy has a null site_id; the later copy is complete: the alarm is lost.
    rows = [
        alarm("A1", site_id=None, raised="2024-01-01 10:00:00"),
        alarm("A1", site_id="SITE-00001", raised="2024-01-01 11:00:00"),
        alarm("A2", raised="2024-01-01 10:00:00"),
    ]
    out = _silver(spark, rows, [site("SITE-00001")])
    assert sorted(r.alarm_id for r in out.collect()) == ["A2"]


def test_tie_on_raised_ts_is_stable(spark):
    rows = [
        alarm("A1", severity="Minor", raised="2024-01-01 10:00:00"),
        alarm("A1", severity="Critical", raised="2024-01-01 10:00:00"),
    ]
    picks = {_silver(spark, rows, [site("SITE-00001")]).collect()[0].severity for _ in range(3)}
    # Tie-break on the remaining columns: "Critical" < "Minor".
    assert picks == {"Critical"}


def test_silver_schema_and_derived_columns(spark):
    rows = [
        alarm("A1", raised="2024-01-01 10:00:59", cleared="2024-01-01 10:01:01"),
        alarm("A2", raised="2024-01-01 10:00:00", cleared="2024-01-01 10:45:30"),
        alarm("A3", raised="2024-01-01 10:00:00"),
        alarm("A4", site_id="SITE-99999"),
    ]
    out = _silver(spark, rows, [site("SITE-00001")])
    assert [f.name for f in out.schema.fields] == [f.name for f in SILVER.fields]
    got = {r.alarm_id: (r.time_to_clear_min, r.is_active) for r in out.collect()}
    # 10:00:59 -> 10:01:01 is 0 whole minutes; unknown site dropped by the inner join.
    assert got == {"A1": (0, False), "A2": (45, False), "A3": (None, True)}


def test_fault_score_weights_and_exact_case(spark):
    rows = [
        alarm("A1", severity="Critical"),
        alarm("A2", severity="Major"),
        alarm("A3", severity="Minor"),
        alarm("A4", severity="Warning"),
        alarm("A5", severity="Info"),
        alarm("A6", severity="critical"),
    ]
    gold = build_gold(_silver(spark, rows, [site("SITE-00001")])).collect()
    assert len(gold) == 1
    g = gold[0]
    assert g.fault_score == 10 + 5 + 2 + 1 + 1 + 1
    assert g.critical_alarms == 1  # "critical" is not "Critical"
    assert g.total_alarms == 6


def test_all_active_site_has_null_mttr_and_drops_out_of_mean(spark):
    rows = [
        alarm("A1", site_id="SITE-00001"),
        alarm("A2", site_id="SITE-00002", cleared="2024-01-01 10:30:00"),
    ]
    sites = [site("SITE-00001"), site("SITE-00002")]
    gold = build_gold(_silver(spark, rows, sites))
    got = {r.site_id: r.avg_mttr_min for r in gold.collect()}
    assert got == {"SITE-00001": None, "SITE-00002": 30.0}
    kpi = M.network_kpis(gold).collect()[0]
    assert kpi.network_mttr == 30.0 and kpi.sites == 2 and kpi.total_active == 1


def test_gold_schema(spark):
    gold = build_gold(_silver(spark, [alarm("A1")], [site("SITE-00001")]))
    assert [(f.name, f.dataType) for f in gold.schema.fields] == [(f.name, f.dataType) for f in GOLD.fields]


def test_gold_is_one_row_per_site_with_max_attributes(spark):
    doubled = [site("SITE-00001", region="R1"), site("SITE-00001", region="R2"), site("SITE-00002")]
    silver = _silver(spark, [alarm("A1"), alarm("A2", site_id="SITE-00002")], doubled)
    gold = {r.site_id: r for r in build_gold(silver).collect()}
    assert len(gold) == 2 and gold["SITE-00001"].region == "R2" and gold["SITE-00001"].total_alarms == 2


def test_gold_keeps_sites_that_left_the_dimension(spark):
    published = _silver(spark, [alarm("A1")], [site("SITE-00001", region="old")])
    assert [(r.site_id, r.region) for r in build_gold(published).collect()] == [("SITE-00001", "old")]


def test_sites_without_alarms_have_no_gold_row(spark):
    gold = build_gold(_silver(spark, [alarm("A1")], [site("SITE-00001"), site("SITE-00002")]))
    assert [r.site_id for r in gold.collect()] == ["SITE-00001"]


def test_worst_sites_tie_break(spark):
    rows = [alarm(f"A{i}", site_id=f"SITE-0000{i % 3}", severity="Major") for i in range(6)]
    sites = [site(f"SITE-0000{i}") for i in range(3)]
    gold = build_gold(_silver(spark, rows, sites))
    top = [r.site_id for r in M.worst_sites(gold, 2).collect()]
    assert top == ["SITE-00000", "SITE-00001"]


def test_mean_of_means_vs_alarm_level(spark):
    # One site with one slow alarm, one with three fast ones: region means differ.
    rows = [alarm("A0", site_id="SITE-00001", cleared="2024-01-01 11:40:00")] + [
        alarm(f"B{i}", site_id="SITE-00002", cleared="2024-01-01 10:10:00") for i in range(3)
    ]
    sites = [site("SITE-00001"), site("SITE-00002")]
    silver = _silver(spark, rows, sites)
    gold = build_gold(silver)
    assert M.region_rollup(gold).collect()[0].avg_mttr == 55.0  # (100 + 10) / 2
    assert M.mttr_by(silver, "region").collect()[0].mttr_min == 32.5  # (100 + 30) / 4


def test_daily_series_keeps_gaps(spark):
    rows = [alarm("A1", raised="2024-01-01 10:00:00"), alarm("A2", raised="2024-01-03 10:00:00")]
    daily = M.daily_alarms(_silver(spark, rows, [site("SITE-00001")]))
    assert sorted(str(r.ds)[:10] for r in daily.collect()) == ["2024-01-01", "2024-01-03"]


def test_fill_gaps_adds_missing_days_at_zero(spark):
    rows = [alarm("A1", raised="2024-01-01 10:00:00"), alarm("A2", raised="2024-01-04 10:00:00")]
    daily = M.daily_alarms(_silver(spark, rows, [site("SITE-00001")]), fill_gaps=True)
    got = sorted((str(r.ds)[:10], r.alarm_count) for r in daily.collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 0), ("2024-01-03", 0), ("2024-01-04", 1)]


def test_distribution_keeps_null_group(spark):
    from faultline.operators.profile import distribution

    df = frame(spark, [alarm("A1", severity=None), alarm("A2", severity=None), alarm("A3")], ALARMS)
    got = {r.severity: r.alarms for r in distribution(df, "severity").collect()}
    assert got == {None: 2, "Major": 1}


def test_worst_site_causes(spark):
    rows = [
        alarm("A1", site_id="SITE-00001", severity="Critical", probable_cause="Heat"),
        alarm("A2", site_id="SITE-00001", severity="Critical", probable_cause="Heat"),
        alarm("A3", site_id="SITE-00001", severity="Minor", probable_cause="Cut"),
        alarm("A4", site_id="SITE-00002", severity="Minor", probable_cause="Cut"),
    ]
    silver = _silver(spark, rows, [site("SITE-00001"), site("SITE-00002")])
    gold = build_gold(silver)
    assert [r.probable_cause for r in M.worst_site_top_cause(silver, gold).collect()] == ["Heat"]
    assert {r.probable_cause: r.alarms for r in M.worst_site_causes(silver, gold).collect()} == {"Heat": 2, "Cut": 1}


def test_hot_site_matches_plain_group_by(spark):
    """One site holds half of the alarms: Gold equals a plain group-by."""
    n = 20000
    ids = spark.range(n)
    alarms = ids.select(
        F.format_string("A%06d", "id").alias("alarm_id"),
        F.when(F.col("id") % 2 == 0, F.lit("SITE-00000"))
        .otherwise(F.format_string("SITE-%05d", (F.col("id") % 97) + 1))
        .alias("site_id"),
        F.lit("ENB-00001").alias("node_id"),
        F.lit("LinkDown").alias("alarm_type"),
        F.element_at(F.array(*[F.lit(s) for s in ["Critical", "Major", "Minor", "Warning"]]), (F.col("id") % 4 + 1).cast("int")).alias("severity"),
        F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("raised_ts"),
        F.when(F.col("id") % 5 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.timestamp_add("MINUTE", (F.col("id") % 300).cast("int"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")))
        .alias("cleared_ts"),
        F.lit("CLEARED").alias("status"),
        F.lit("C0").alias("probable_cause"),
        F.lit("2024-01-01").alias("event_date"),
    )
    sites = frame(spark, [site(f"SITE-{i:05d}") for i in range(0, 98)], SITES)
    silver = build_silver(alarms, sites)
    gold = {r.site_id: r for r in build_gold(silver).collect()}
    plain = silver.groupBy("site_id").agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("severity") == "Critical", 1).otherwise(0)).alias("crit"),
        F.round(F.avg("time_to_clear_min"), 1).alias("mttr"),
    ).collect()
    assert len(gold) == len(plain) == 98
    for r in plain:
        g = gold[r.site_id]
        assert (g.total_alarms, g.critical_alarms, g.avg_mttr_min) == (r.n, r.crit, r.mttr)
    assert gold["SITE-00000"].total_alarms == n // 2


def _skewed_alarms(spark, n: int, hot_share: float = 1 / 3):
    """``n`` alarms; a third of the rows are copies of one alarm_id on one site."""
    hot = int(n * hot_share)
    i = F.col("id")
    return spark.range(n).select(
        F.when(i < hot, F.lit("HOT")).otherwise(F.format_string("A%07d", i)).alias("alarm_id"),
        F.when(i < hot, F.lit("SITE-00000")).otherwise(F.format_string("SITE-%05d", i % 50)).alias("site_id"),
        F.lit("ENB-00001").alias("node_id"),
        F.lit("LinkDown").alias("alarm_type"),
        F.lit("Major").alias("severity"),
        F.timestamp_add("SECOND", (i % 1000).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias(
            "raised_ts"
        ),
        F.lit(None).cast("timestamp_ntz").alias("cleared_ts"),
        F.lit("ACTIVE").alias("status"),
        F.lit("C0").alias("probable_cause"),
        F.lit("2024-01-01").alias("event_date"),
    )


def test_hot_alarm_id_dedupes_to_its_earliest_copy(spark):
    from faultline.operators.dedupe import dedupe_first, flag_first

    n = 30000
    alarms = _skewed_alarms(spark, n).repartition(8)
    first = dedupe_first(alarms, "alarm_id", ["raised_ts"])
    assert first.count() == n - n // 3 + 1
    hot = first.where(F.col("alarm_id") == "HOT").collect()
    assert len(hot) == 1 and hot[0].raised_ts.second == 0 and hot[0].raised_ts.minute == 0
    flagged = flag_first(alarms, "alarm_id", ["raised_ts"])
    assert flagged.where("is_first").count() == n - n // 3 + 1
    assert flagged.count() == n
    # the same rows are first however the input is partitioned
    again = flag_first(alarms.repartition(3, "raised_ts"), "alarm_id", ["raised_ts"])
    assert again.exceptAll(flagged).isEmpty()


def test_hot_site_on_the_sort_merge_path_matches_broadcast(spark):
    """With the site dimension over the broadcast bound, Silver is the same."""
    n = 30000
    hot = n // 3
    alarms = _skewed_alarms(spark, n)
    sites = frame(spark, [site(f"SITE-{i:05d}") for i in range(50)], SITES)
    broadcast = build_silver(alarms, sites)
    shuffled = build_silver(alarms, sites, max_broadcast_bytes=10)
    assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
    assert shuffled.count() == broadcast.count() == n - hot + 1
    assert shuffled.exceptAll(broadcast).count() == 0
    gold = {r.site_id: r.total_alarms for r in build_gold(shuffled).collect()}
    # the HOT alarm (one row after dedupe) plus every 50th of the other ids
    assert gold["SITE-00000"] == 1 + sum(1 for i in range(hot, n) if i % 50 == 0)


def test_dedupe_tiebreak_skips_unorderable_columns(spark):
    from faultline.operators.dedupe import dedupe_first

    df = spark.createDataFrame(
        [("a", 1, {"k": "x"}), ("a", 1, {"k": "y"}), ("b", 2, {"k": "z"})], "id string, t int, m map<string,string>"
    )
    assert dedupe_first(df, "id", ["t"]).count() == 2
