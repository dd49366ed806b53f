"""Usage, grants, lineage, notices; answer grading; forecast."""

from __future__ import annotations

import datetime as dt

from helpers import SF_SMALL, alarm, frame, site
from pyspark.sql import functions as F

from faultline.operators import forecast as FC
from faultline.operators import governance as G
from faultline.operators import grading as GR
from faultline.operators import metrics as M
from faultline.operators.medallion import build_gold, build_silver
from faultline.schemas import ALARMS, ANSWERS, AUDIT, GRANTS, LINEAGE, SITES, TRUTHS

AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)


def _audit(spark, rows):
    data = [
        ({"email": e}, svc, act, {"full_name_arg": t}, dt.datetime.fromisoformat(when))
        for e, svc, act, t, when in rows
    ]
    return spark.createDataFrame(data, AUDIT)


def test_table_usage_filters_and_counts(spark):
    audit = _audit(
        spark,
        [
            ("a@x", "unityCatalog", "getTable", "main.net.gold", "2024-01-20 10:00:00"),
            ("a@x", "unityCatalog", "generateTemporaryTableCredential", "main.net.gold", "2024-01-25 10:00:00"),
            ("b@x", "unityCatalog", "getTable", "main.net.gold", "2024-01-26 10:00:00"),
            ("c@x", "jobs", "getTable", "main.net.gold", "2024-01-26 10:00:00"),  # other service
            ("d@x", "unityCatalog", "deleteTable", "main.net.gold", "2024-01-26 10:00:00"),  # other action
            ("e@x", "unityCatalog", "getTable", "main.net.other", "2024-01-26 10:00:00"),  # other table
            ("f@x", "unityCatalog", "getTable", "main.net.gold", "2023-12-01 10:00:00"),  # too old
        ],
    )
    usage = G.table_usage(audit, "main.net.gold", AS_OF, 30).collect()
    assert [(r.user_email, r.access_count) for r in usage] == [("a@x", 2), ("b@x", 1)]
    assert usage[0].first_access == dt.datetime(2024, 1, 20, 10) and usage[0].last_access == dt.datetime(2024, 1, 25, 10)

    grants = spark.createDataFrame(
        [
            ("a@x", "SELECT", "NO", "main", "net", "gold"),
            ("z@x", "SELECT", "YES", "main", "net", "gold"),
            ("a@x", "MODIFY", "NO", "main", "net", "other"),
        ],
        GRANTS,
    )
    assert {r.grantee for r in G.table_grants(grants, "main.net.gold").collect()} == {"a@x", "z@x"}
    assert [r.grantee for r in G.stale_grants(grants, audit, "main.net.gold", AS_OF).collect()] == ["z@x"]

    notices = G.usage_notices(G.table_usage(audit, "main.net.gold", AS_OF, 30), "main.net.gold").collect()
    first = [n for n in notices if n.to == "a@x"][0]
    assert first.subject == "You use gold: is that still needed?"
    assert "main.net.gold was read 2 time(s) under your name within 30 days, last at 2024-01-25 10:00:00 UTC" in first.body


def test_lineage_both_directions(spark):
    edges = spark.createDataFrame(
        [
            ("main.net.silver", "main.net.gold", dt.datetime(2024, 1, 1)),
            ("main.net.silver", "main.net.gold", dt.datetime(2024, 1, 5)),
            (None, "main.net.gold", dt.datetime(2024, 1, 6)),
            ("main.net.raw", "main.net.silver", dt.datetime(2024, 1, 2)),
        ],
        LINEAGE,
    )
    up = G.lineage(edges, "main.net.gold", "upstream").collect()
    assert [(r.source_table_full_name, r.last_seen) for r in up] == [("main.net.silver", dt.datetime(2024, 1, 5))]
    down = G.lineage(edges, "main.net.silver", "downstream").collect()
    assert [r.target_table_full_name for r in down] == ["main.net.gold"]


def test_grading_on_nation_cases(spark):
    """Nation names as truths: round 1 misses every 3rd case, round 2 every 6th."""
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    truths = nation.select(F.col("n_nationkey").cast("bigint").alias("case_id"), F.col("n_name").alias("truth"))

    def rnd(r, every):
        return nation.select(
            F.col("n_nationkey").cast("bigint").alias("case_id"),
            F.lit(r).cast("bigint").alias("round"),
            F.when(F.col("n_nationkey") % every == 0, F.lit("unknown"))
            .otherwise(F.concat(F.lit("The answer is "), F.lower("n_name")))
            .alias("answer_text"),
            F.lit(None).cast("string").alias("first_row_text"),
        )

    scored = GR.score_answers(truths, rnd(1, 3).unionByName(rnd(2, 6)))
    scores = {r["round"]: (r.correct, r.total) for r in GR.round_score(scored).collect()}
    assert scores == {1: (16, 25), 2: (20, 25)}
    s = GR.lift_summary(scored).collect()[0]
    assert (s.score_before, s.score_after, s.cases, s.lift) == (16, 20, 25, 4)
    improved = {r.case_id for r in GR.answer_lift(scored).collect() if r.improved}
    assert improved == {3, 9, 15, 21}


def test_grading_rules(spark):
    truths = spark.createDataFrame([(1, "NATION_1"), (2, "Atlanta"), (3, "42")], TRUTHS)
    answers = spark.createDataFrame(
        [
            (1, 1, "the answer is nation_11", None),  # containment accident passes
            (2, 1, "I could not run it", "Atlanta 17 0.3"),  # first result row counts
            (3, 1, "SELECT x FROM t;  ", None),
        ],
        ANSWERS,
    )
    answers = answers.unionByName(spark.createDataFrame([(4, 1, "anything", None)], ANSWERS))
    got = {r.case_id: (r.passed, r.answer_excerpt, r.truth) for r in GR.score_answers(truths, answers).collect()}
    assert got[1][0] is True and got[2][0] is True and got[3][0] is False
    assert got[3][1] == "SELECT x FROM t"
    assert got[4] == (False, "anything", None)  # no truth: kept, not passed


def _daily(spark, counts):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=i), c) for i, c in counts]
    return spark.createDataFrame(rows, "ds timestamp_ntz, alarm_count long")


def test_forecast_trend_floor_and_horizon(spark):
    daily = _daily(spark, [(0, 100), (1, 80), (2, 60), (3, 40)])  # falls 20 a day
    fc = FC.forecast(daily, "ds", "alarm_count", horizon="2024-01-10", floor=0.0).orderBy("ds").collect()
    assert [r.ds.day for r in fc] == [5, 6, 7, 8, 9]  # exclusive at the right end
    assert [r.alarm_count_forecast for r in fc] == [20.0, 0.0, 0.0, 0.0, 0.0]  # never below the floor
    assert all(r.alarm_count_lower <= r.alarm_count_forecast <= r.alarm_count_upper for r in fc)


def test_actual_vs_forecast_bridge(spark):
    daily = _daily(spark, [(0, 10), (1, 12), (3, 16)])  # day 2 missing stays missing
    out = FC.actual_vs_forecast(daily, horizon_days=2).collect()
    assert len(out) == 3 + 1 + 2
    bridge = [r for r in out if r.actual is None and r.ds == dt.datetime(2024, 1, 4)]
    assert len(bridge) == 1 and bridge[0].forecast == 16.0
    assert [f.dataType.simpleString() for f in FC.actual_vs_forecast(daily, horizon_days=2).schema.fields] == [
        "timestamp_ntz",
        "bigint",
        "double",
    ]


def test_forecast_by_group(spark):
    rows = [alarm(f"A{i}", site_id=f"SITE-0000{i % 2}", raised=f"2024-01-0{1 + i % 5} 10:00:00") for i in range(20)]
    sites = frame(spark, [site("SITE-00000", "East"), site("SITE-00001", "West")], SITES)
    silver = build_silver(frame(spark, rows, ALARMS), sites)
    daily = M.daily_alarms(silver, "region")
    out = FC.actual_vs_forecast(daily, horizon_days=3, group_col="region")
    per_region = {r.region: r["count"] for r in out.groupBy("region").count().collect()}
    actual_days = {r.region: r["count"] for r in daily.groupBy("region").count().collect()}
    assert per_region == {k: v + 1 + 3 for k, v in actual_days.items()}
    assert build_gold(silver).count() == 2


def test_weekly_effect_recovers_a_weekly_pattern(spark):
    # trend 100 + 2/day plus +30 on Mondays, -10 on Sundays, over 8 weeks
    rows = []
    for i in range(56):
        day = dt.datetime(2024, 1, 1) + dt.timedelta(days=i)  # 2024-01-01 is a Monday
        bump = 30 if day.weekday() == 0 else (-10 if day.weekday() == 6 else 0)
        rows.append((day, 100 + 2 * i + bump))
    daily = spark.createDataFrame(rows, "ds timestamp_ntz, alarm_count long")
    fc = {r.ds.date(): r.alarm_count_forecast for r in FC.forecast(daily, "ds", "alarm_count", horizon_days=7, weekly=True).collect()}
    plain = {r.ds.date(): r.alarm_count_forecast for r in FC.forecast(daily, "ds", "alarm_count", horizon_days=7).collect()}
    monday, sunday, wednesday = dt.date(2024, 2, 26), dt.date(2024, 3, 3), dt.date(2024, 2, 28)
    assert fc[monday] - fc[wednesday] > 20  # Monday stays high (effect 30, trend -4)
    assert fc[sunday] < plain[sunday]  # Sunday stays low
    assert abs(fc[monday] - (100 + 2 * 56 + 30)) < 3
    assert abs(fc[wednesday] - (100 + 2 * 58)) < 3
    assert abs(fc[sunday] - (100 + 2 * 62 - 10)) < 3
