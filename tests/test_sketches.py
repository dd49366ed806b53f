"""Daily sketches, rolling usage, causes of all sites, several metrics in one pass."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import random
from collections import Counter

import pytest
from helpers import SF_MID
from pyspark.sql import functions as F

from faultline.operators import governance as G
from faultline.operators import metrics as M
from faultline.operators import sketches as SK
from faultline.plans.catalog import compile_metrics
from faultline.plans.pipeline import Layers
from faultline.plans.queries import DASHBOARD
from faultline.schemas import AUDIT


def test_merged_quantile_sketches_equal_a_direct_one(layers_small):
    silver = layers_small.silver()
    merged = SK.merge_quantiles(SK.quantile_sketch(silver, ["event_date", "region"], "time_to_clear_min"), ["region"])
    direct = SK.quantile_sketch(silver, ["region"], "time_to_clear_min")
    rows = lambda df: sorted(map(tuple, df.select("region", "bucket", "n").collect()), key=str)
    assert rows(merged) == rows(direct) != []


@pytest.mark.parametrize("accuracy", [0.01, 0.1])
def test_quantiles_lie_within_the_accuracy_of_exact_ones(spark, accuracy):
    exact = {r.region: r for r in M.clear_time_summary(Layers(spark, SF_MID).silver(), "region").collect()}
    sketch = SK.quantile_sketch(Layers(spark, SF_MID).silver(), ["region"], "time_to_clear_min", accuracy)
    got = SK.sketched_quantiles(sketch, ["region"], [25, 50, 75, 95], accuracy).collect()
    assert {r.region for r in got} == set(exact)
    for r in got:
        assert r.n == exact[r.region].cleared_alarms
        for p in (25, 50, 75, 95):
            true = exact[r.region][f"p{p}_min"]
            assert abs(r[f"p{p}"] - true) <= accuracy * true + 0.005


def test_sketch_edges(spark):
    df = spark.createDataFrame([("a", 0), ("a", None), ("a", 0), ("a", 10**12), ("b", None)], "g string, v bigint")
    got = {r.g: r for r in SK.sketched_quantiles(SK.quantile_sketch(df, ["g"], "v"), ["g"], [50, 99]).collect()}
    assert set(got) == {"a"} and got["a"].n == 3 and got["a"].p50 == 0 and abs(got["a"].p99 / 10**12 - 1) <= 0.01
    with pytest.raises(Exception, match="must not be negative"):
        SK.quantile_sketch(spark.createDataFrame([("a", -1)], "g string, v bigint"), ["g"], "v").collect()
    with pytest.raises(ValueError):
        SK.quantile_sketch(df, ["g"], "v", 0)


def test_distinct_sketches_merge_to_near_the_truth(spark):
    """40,000 users a day, half of them new each day: within three standard errors (1.6 % each)."""
    df = spark.range(0, 200_000).select((F.col("id") % 5).alias("day"), (F.floor(F.col("id") / 5) + 20_000 * (F.col("id") % 5)).alias("user"))
    daily = SK.distinct_sketch(df, ["day"], "user")
    got = SK.merge_distinct(daily, []).select("n", SK.distinct_count().alias("d")).first()
    true = df.select("user").distinct().count()
    assert got.n == 200_000 and true == 120_000 and abs(got.d - true) <= 0.05 * true


def audit_rows(seed, n, days):
    r = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for _ in range(n):
        at = start + dt.timedelta(days=r.randrange(days), minutes=r.randrange(1440))
        user = r.choice([None, "a", "b", "c", "d"])
        rows.append({
            "user_identity": (user,), "service_name": r.choice(["unityCatalog", "unityCatalog", "jobs"]),
            "action_name": r.choice(["getTable", "generateTemporaryTableCredential", "other"]),
            "request_params": r.choice([{"full_name_arg": "t1"}, {"full_name_arg": "t2"}, {}]),
            "event_time": r.choice([at, at, at, None]),
        })
    return rows


@pytest.mark.parametrize("days", [1, 3, 30])
def test_rolling_usage_against_counting_anew(spark, days):
    rows = audit_rows(days, 150, 25)
    df = spark.createDataFrame([tuple(x[f.name] for f in AUDIT.fields) for x in rows], AUDIT)
    reads = [
        (x["request_params"]["full_name_arg"], x["user_identity"][0], x["event_time"].date())
        for x in rows
        if x["service_name"] == "unityCatalog" and x["action_name"] != "other" and x["request_params"] and x["event_time"]
    ]
    last, want = max(d for *_, d in reads), []
    for t in {t for t, *_ in reads}:
        day = min(d for x, _, d in reads if x == t)
        while day <= last:
            inside = [u for x, u, d in reads if x == t and day - dt.timedelta(days=days) < d <= day]
            want.append((t, day.isoformat(), len(inside), len({u for u in inside if u})))
            day += dt.timedelta(days=1)
    assert sorted(map(tuple, G.usage_rolling(df, days).collect())) == sorted(want)


def test_rolling_usage_of_an_empty_log(spark):
    assert G.usage_rolling(spark.createDataFrame([], AUDIT)).count() == 0


def test_top_cause_counts_a_hot_site_in_the_map_tasks(spark, layers_small):
    rows = [("s1", "x")] * 5 + [("s1", "y")] * 5 + [("s2", None)] * 2 + [("s2", "z")] + [("s3", "b"), ("s3", None)]
    got = {r.site_id: tuple(r)[1:] for r in M.top_cause_by_site(spark.createDataFrame(rows, "site_id string, probable_cause string")).collect()}
    assert got == {"s1": ("x", 5, 0.5), "s2": (None, 2, 0.6667), "s3": ("b", 1, 0.5)}
    hot = spark.range(90_000).select(F.lit("hot").alias("site_id"), F.concat(F.lit("C"), F.col("id") % 6).alias("probable_cause"))
    hot = hot.repartition(8).selectExpr("*")
    assert M.top_cause_by_site(hot).first().alarms == 15_000
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        M.top_cause_by_site(layers_small.silver()).explain("simple")
    assert "partial_count(1)" in buf.getvalue() and "Window" not in buf.getvalue().split("partial_count")[0]


def test_all_reports_come_from_one_scan(spark, layers_small):
    gold = spark.createDataFrame(layers_small.gold().collect(), layers_small.gold().schema)
    gold.write.mode("overwrite").parquet("/tmp/faultline-metrics-gold")
    gold = spark.read.parquet("/tmp/faultline-metrics-gold")
    df = compile_metrics(gold, DASHBOARD)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    assert buf.getvalue().count("FileScan") == 1
    got = df.collect()
    assert Counter(r.report for r in got).keys() == DASHBOARD.keys()
    assert [r for r in got if r.report == "network"][0].sites == gold.count()
    regions = {r.region: r for r in got if r.report == "regions"}
    for r in M.region_rollup(gold).collect():
        assert regions[r.region].sites == r.sites and regions[r.region].vendor is None and regions[r.region].active_share is None


def test_requests_share_sets_and_unknown_names_are_refused(layers_small):
    gold = layers_small.gold()
    got = compile_metrics(gold, {"a": (("region",), ("sites",)), "b": (("region",), ("fault_score",)), "c": ((), ("sites",))}).collect()
    assert Counter(r.report for r in got)["a"] == Counter(r.report for r in got)["b"] > 1
    assert all((r.sites is None) == (r.report == "b") for r in got)
    assert compile_metrics(gold, {"c": ((), ("sites",))}).first().sites == 15
    with pytest.raises(KeyError, match="nonsense"):
        compile_metrics(gold, {"x": (("region",), ("nonsense",))})
