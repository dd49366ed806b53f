"""Smoothed forecasts: recursion, choice of settings, bands, short and gappy series."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from faultline.operators import forecast as FC
from faultline.operators import smoothing as SM

START = dt.datetime(2024, 1, 1)


def series(y, name="r"):
    return [(name, START + dt.timedelta(days=i), int(v)) for i, v in enumerate(y)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "region string, ds timestamp_ntz, alarm_count bigint")


def weekly(days, seed=0, slope=0.6):
    rng = np.random.default_rng(seed)
    shape = np.array([40, 44, 42, 47, 60, 15, 9])
    return np.maximum(0, 60 + slope * np.arange(days) + shape[np.arange(days) % 7] + rng.normal(0, 2, days)).round()


def plain(y, a, b, g, horizon):
    """One setting, day by day."""
    level, trend, season = float(np.mean(y[:7])), 0.0, [v - float(np.mean(y[:7])) for v in y[:7]]
    for t in range(7, len(y)):
        new = a * (y[t] - season[t % 7]) + (1 - a) * (level + trend)
        trend = b * (new - level) + (1 - b) * trend
        season[t % 7] = g * (y[t] - new) + (1 - g) * season[t % 7]
        level = new
    return [level + h * trend + season[(len(y) - 1 + h) % 7] for h in range(1, horizon + 1)]


def test_the_setting_with_the_least_rolling_error_is_taken():
    y = weekly(42)
    errors = {}
    for a, b, g in SM.GRID.tolist():
        errors[a, b, g] = np.mean(
            [(y[o + h] - plain(y[: o + 1], a, b, g, h)[-1]) ** 2 for h in range(1, 8) for o in range(13, len(y) - h)]
        )
    best = min(errors, key=lambda k: round(errors[k], 6))
    got = SM.forecast_series(y, 7)
    assert got["made"].tolist() == pytest.approx(plain(y, *best, 7))
    own = [np.sqrt(np.mean([(y[o + h] - plain(y[: o + 1], *best, h)[-1]) ** 2 for o in range(13, len(y) - h)])) for h in range(1, 8)]
    assert got["sd"].tolist() == pytest.approx(own)


@pytest.mark.parametrize("seed", range(3))
def test_a_held_out_week_is_closer_than_by_the_line(spark, seed):
    y = weekly(70, seed)
    daily = frame(spark, series(y[:63]))
    truth = {START + dt.timedelta(days=63 + i): v for i, v in enumerate(y[63:])}
    error = lambda rows: np.mean([abs(r.alarm_count_forecast - truth[r.ds]) for r in rows])
    line = FC.forecast(daily, "ds", "alarm_count", horizon_days=7).collect()
    smoothed = SM.forecast_smoothed(daily, "ds", "alarm_count", 7, "region").collect()
    assert {r.ds for r in smoothed} == set(truth)
    assert error(smoothed) < 0.3 * error(line)
    inside = sum(r.alarm_count_lower <= truth[r.ds] <= r.alarm_count_upper for r in smoothed)
    assert inside >= 6


def test_short_gappy_empty_and_unnamed_series(spark):
    rows = series([5, 7, 9], "short") + series([3], "one") + [("gap", START, 4), ("gap", START + dt.timedelta(days=20), 6), ("gap", None, 9)]
    rows += [(None, START, 2)]
    got = SM.forecast_smoothed(frame(spark, rows), "ds", "alarm_count", 2, "region").collect()
    of = lambda name: sorted((r.ds, r.alarm_count_forecast) for r in got if r.region == name)
    assert of("short") == [(START + dt.timedelta(days=3 + i), 7.0) for i in range(2)]
    assert [v for _, v in of("one")] == [3.0, 3.0] and len(of("gap")) == 2 and len(of(None)) == 2
    assert of("gap")[0][0] == START + dt.timedelta(days=21)
    assert SM.forecast_smoothed(frame(spark, []), "ds", "alarm_count", 2, "region").count() == 0
    whole = SM.forecast_smoothed(frame(spark, series(weekly(30))), "ds", "alarm_count", 3)
    assert whole.columns == ["ds", "alarm_count_forecast", "alarm_count_upper", "alarm_count_lower"] and whole.count() == 3
