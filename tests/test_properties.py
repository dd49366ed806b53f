"""Property test: Silver and Gold equal a plain-Python computation of the same rules."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from helpers import frame, site
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from faultline.operators.medallion import build_gold, build_silver
from faultline.schemas import ALARMS, SITES

SITE_IDS = [f"SITE-{i:05d}" for i in range(4)]
BASE = dt.datetime(2024, 1, 1)
ORDER_AFTER_TS = ["site_id", "node_id", "alarm_type", "severity", "cleared_ts", "status", "probable_cause", "event_date"]


@st.composite
def feeds(draw):
    rows = []
    for n in range(draw(st.integers(1, 25))):
        alarm_id = f"A{draw(st.integers(0, 8))}"  # few ids: many duplicates
        raised = BASE + dt.timedelta(minutes=draw(st.integers(0, 5)))  # many ties
        cleared = None if draw(st.booleans()) else raised + dt.timedelta(seconds=draw(st.integers(0, 4000)))
        rows.append(
            {
                "alarm_id": alarm_id,
                "site_id": draw(st.sampled_from(SITE_IDS + ["SITE-99999", None])),
                "node_id": "ENB-00001",
                "alarm_type": draw(st.sampled_from(["LinkDown", "PowerFault"])),
                "severity": draw(st.sampled_from(["Critical", "Major", "Minor", "Warning", "Info", "critical", None])),
                "raised_ts": raised,
                "cleared_ts": cleared,
                "status": "CLEARED" if cleared else "ACTIVE",
                "probable_cause": draw(st.sampled_from(["C0", "C1"])),
                "event_date": raised.strftime("%Y-%m-%d"),
            }
        )
    return rows


def _sort_key(row):
    # ascending, nulls first, in the column order the tie-break uses
    key = [(0, row["raised_ts"])]
    for c in ORDER_AFTER_TS:
        v = row[c]
        key.append((0, "") if v is None else (1, v))
    return key


def _half_up(x: float, digits: int) -> float:
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def brute_force(rows):
    first = {}
    for r in sorted(rows, key=_sort_key):
        first.setdefault(r["alarm_id"], r)
    silver = [r for r in first.values() if r["site_id"] in SITE_IDS and r["severity"] is not None]
    weights = {"Critical": 10, "Major": 5, "Minor": 2}
    gold = {}
    for r in silver:
        g = gold.setdefault(r["site_id"], {"n": 0, "crit": 0, "active": 0, "ttc": [], "score": 0})
        g["n"] += 1
        g["crit"] += r["severity"] == "Critical"
        g["active"] += r["cleared_ts"] is None
        if r["cleared_ts"] is not None:
            g["ttc"].append(int((r["cleared_ts"] - r["raised_ts"]).total_seconds() // 60))
        g["score"] += weights.get(r["severity"], 1)
    return (
        {(r["alarm_id"], r["severity"], r["site_id"]) for r in silver},
        {
            k: (v["n"], v["crit"], v["active"], _half_up(sum(v["ttc"]) / len(v["ttc"]), 1) if v["ttc"] else None, v["score"])
            for k, v in gold.items()
        },
    )


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=feeds())
def test_silver_and_gold_match_brute_force(spark, rows):
    alarms = frame(spark, rows, ALARMS)
    sites = frame(spark, [site(s) for s in SITE_IDS], SITES)
    silver = build_silver(alarms, sites)
    gold = build_gold(silver)
    want_silver, want_gold = brute_force(rows)
    assert {(r.alarm_id, r.severity, r.site_id) for r in silver.collect()} == want_silver
    got_gold = {
        r.site_id: (r.total_alarms, r.critical_alarms, r.active_alarms, r.avg_mttr_min, r.fault_score)
        for r in gold.collect()
    }
    assert got_gold == want_gold


def brute_force_rejects(rows):
    out = []
    by_id = {}
    for r in sorted(rows, key=_sort_key):
        by_id.setdefault(r["alarm_id"], []).append(r)
    for group in by_id.values():
        for i, r in enumerate(group):
            reasons = []
            if i > 0:
                reasons.append("first_copy_of_alarm")
            if r["site_id"] is None:
                reasons.append("site_id_not_null")
            if r["severity"] is None:
                reasons.append("severity_not_null")
            if r["site_id"] is not None and r["site_id"] not in SITE_IDS:
                reasons.append("site_known")
            if reasons:
                out.append((r["alarm_id"], r["site_id"], r["severity"], r["raised_ts"], ",".join(reasons)))
    return sorted(out, key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=feeds())
def test_rejects_match_brute_force(spark, rows):
    from faultline.operators.quality import silver_rejects

    alarms = frame(spark, rows, ALARMS)
    sites = frame(spark, [site(s) for s in SITE_IDS], SITES)
    got = sorted(
        (
            (r.alarm_id, r.site_id, r.severity, r.raised_ts, ",".join(r.reasons))
            for r in silver_rejects(alarms, sites).collect()
        ),
        key=repr,
    )
    assert got == brute_force_rejects(rows)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    counts=st.lists(st.integers(0, 500), min_size=3, max_size=40),
    gaps=st.sets(st.integers(1, 38), max_size=6),
    horizon=st.integers(1, 10),
)
def test_forecast_matches_numpy_least_squares(spark, counts, gaps, horizon):
    import numpy as np

    from faultline.operators.forecast import forecast

    days = [i for i in range(len(counts)) if i not in gaps] or [0]
    rows = [(BASE + dt.timedelta(days=i), counts[i]) for i in days]
    daily = spark.createDataFrame(rows, "ds timestamp_ntz, alarm_count long")
    got = {r.ds: r.alarm_count_forecast for r in forecast(daily, "ds", "alarm_count", horizon_days=horizon).collect()}

    epoch = dt.datetime(1970, 1, 1)
    x = np.array([(BASE + dt.timedelta(days=i) - epoch).days for i in days], dtype=float)
    y = np.array([counts[i] for i in days], dtype=float)
    slope, intercept = np.polyfit(x, y, 1) if len(set(x)) > 1 else (0.0, float(y.mean()))
    last = BASE + dt.timedelta(days=days[-1])
    want = {}
    for k in range(1, horizon + 1):
        d = last + dt.timedelta(days=k)
        want[d] = max(0.0, intercept + slope * (d - epoch).days)
    assert set(got) == set(want)
    for d, v in want.items():
        assert abs(got[d] - v) < 1e-3, (d, got[d], v)


REGIONS = {"SITE-00000": "East", "SITE-00001": "East", "SITE-00002": "West", "SITE-00003": "North"}
VENDORS = {"SITE-00000": "V1", "SITE-00001": "V2", "SITE-00002": "V1", "SITE-00003": "V2"}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=feeds())
def test_region_and_vendor_metrics_match_brute_force(spark, rows):
    from faultline.operators import metrics as M

    sites = frame(spark, [site(s, REGIONS[s], VENDORS[s]) for s in SITE_IDS], SITES)
    silver = build_silver(frame(spark, rows, ALARMS), sites)
    gold = build_gold(silver)
    _, want_gold = brute_force(rows)

    # mean of site means, as published (sites without alarms have no Gold row)
    per_region: dict[str, list] = {}
    for s, (n, crit, active, mttr, _score) in want_gold.items():
        per_region.setdefault(REGIONS[s], []).append((n, crit, active, mttr))
    want_roll = {}
    for region, vals in per_region.items():
        means = [m for *_, m in vals if m is not None]
        want_roll[region] = (
            len(vals),
            sum(v[1] for v in vals),
            sum(v[2] for v in vals),
            _half_up(sum(means) / len(means), 1) if means else None,
        )
    got_roll = {r.region: (r.sites, r.critical_alarms, r.active_alarms, r.avg_mttr) for r in M.region_rollup(gold).collect()}
    assert got_roll == want_roll

    # alarm-level MTTR per vendor, from Silver rows
    silver_rows = silver.select("vendor", "time_to_clear_min").collect()
    by_vendor: dict[str, list] = {}
    for r in silver_rows:
        if r.time_to_clear_min is not None:
            by_vendor.setdefault(r.vendor, []).append(r.time_to_clear_min)
    want_mttr = {v: _half_up(sum(t) / len(t), 1) for v, t in by_vendor.items()}
    assert {r.vendor: r.mttr_min for r in M.mttr_by(silver, "vendor").collect()} == want_mttr

    # active share: ratio of sums per region, rounded to 3
    want_share = {}
    for region, vals in per_region.items():
        want_share[region] = _half_up(sum(v[2] for v in vals) / sum(v[0] for v in vals), 3)
    assert {r.region: r.active_share for r in M.active_share(gold).collect()} == want_share


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    events=st.lists(
        st.tuples(
            st.sampled_from(["a@x", "b@x", "c@x"]),
            st.sampled_from(["unityCatalog", "jobs"]),
            st.sampled_from(["getTable", "generateTemporaryTableCredential", "deleteTable"]),
            st.sampled_from(["main.net.gold", "main.net.silver"]),
            st.integers(0, 60),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_table_usage_matches_brute_force(spark, events):
    from faultline.operators.governance import table_usage
    from faultline.schemas import AUDIT

    as_of = dt.datetime(2024, 3, 1)
    data = [({"email": e}, svc, act, {"full_name_arg": t}, as_of - dt.timedelta(days=d, hours=1)) for e, svc, act, t, d in events]
    audit = spark.createDataFrame(data, AUDIT)
    got = {r.user_email: (r.access_count, r.first_access, r.last_access) for r in table_usage(audit, "main.net.gold", as_of, 30).collect()}
    want: dict[str, list] = {}
    for (email,), svc, act, params, ts in [((d[0]["email"],), d[1], d[2], d[3], d[4]) for d in data]:
        if svc == "unityCatalog" and act in ("getTable", "generateTemporaryTableCredential") and params["full_name_arg"] == "main.net.gold" and ts > as_of - dt.timedelta(days=30):
            want.setdefault(email, []).append(ts)
    assert got == {e: (len(t), min(t), max(t)) for e, t in want.items()}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    cases=st.lists(
        st.tuples(st.text("abAB_1 ", min_size=1, max_size=6), st.text("abAB_1 ", max_size=12), st.none() | st.text("aB1 ", max_size=6)),
        min_size=1,
        max_size=15,
    )
)
def test_grading_matches_python_containment(spark, cases):
    from faultline.operators.grading import round_score, score_answers
    from faultline.schemas import ANSWERS, TRUTHS

    truths = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], TRUTHS)
    answers = spark.createDataFrame([(i, 1, a, f) for i, (_, a, f) in enumerate(cases)], ANSWERS)
    got = {r.case_id: r.passed for r in score_answers(truths, answers).collect()}
    want = {
        i: t.lower() in " ".join(x for x in (a, f) if x is not None).lower() for i, (t, a, f) in enumerate(cases)
    }
    assert got == want
    score = round_score(score_answers(truths, answers)).collect()[0]
    assert (score.correct, score.total) == (sum(want.values()), len(cases))
