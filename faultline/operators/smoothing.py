"""Exponential smoothing with trend and weekly season, chosen per series by its own errors.

Level, trend and a season of ``SEASON`` days follow the additive recursions

    level'  = a * (y - season) + (1 - a) * (level + trend)
    trend'  = b * (level' - level) + (1 - b) * trend
    season' = g * (y - level') + (1 - g) * season

from the first season's mean and deviations. Every setting of the grid forecasts 1 to ``horizon``
days ahead from every day after the second season (rolling origin); the setting with the least mean
squared error over all origins and distances is taken, and its errors at each distance give that
distance's band. A series is one row per day, so a group is bounded by its days, however many rows
were counted into them.
"""

from __future__ import annotations

import datetime as dt
import sys
from itertools import product

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators.forecast import BAND_Z, DIGITS
from faultline.operators.metrics import fill_daily_gaps

# Tasks need not have this package: what runs there is sent by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEASON = 7
LEVELS, TRENDS, SEASONS = (0.1, 0.3, 0.5), (0.0, 0.1), (0.0, 0.1, 0.3)
# Grid rows in the order in which equal errors are resolved.
GRID = np.array(list(product(LEVELS, TRENDS, SEASONS)))
# Errors equal to so many digits count as equal.
ERROR_DIGITS = 6


def smooth(y: np.ndarray, grid: np.ndarray = GRID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States after each day, for all settings at once: level and trend (days x settings) and the
    seasons (days x ``SEASON`` x settings). Day ``SEASON - 1`` is the first with a state."""
    a, b, g = grid.T
    level = np.full(len(grid), y[:SEASON].mean())
    trend = np.zeros(len(grid))
    season = np.repeat((y[:SEASON] - y[:SEASON].mean())[:, None], len(grid), axis=1)
    levels, trends, seasons = [level], [trend], [season]
    for t in range(SEASON, len(y)):
        now = season[t % SEASON]
        new = a * (y[t] - now) + (1 - a) * (level + trend)
        trend = b * (new - level) + (1 - b) * trend
        season = season.copy()
        season[t % SEASON] = g * (y[t] - new) + (1 - g) * now
        level = new
        levels.append(level)
        trends.append(trend)
        seasons.append(season)
    return np.array(levels), np.array(trends), np.array(seasons)


def rolling_errors(y: np.ndarray, states: tuple[np.ndarray, np.ndarray, np.ndarray], horizon: int) -> list[np.ndarray]:
    """Per distance 1 to ``horizon`` the errors from every origin after the second season (origins x settings)."""
    levels, trends, seasons = states
    out = []
    for h in range(1, horizon + 1):
        origins = np.arange(2 * SEASON - 1, len(y) - h)
        at = origins - (SEASON - 1)
        made = levels[at] + h * trends[at] + seasons[at, (origins + h) % SEASON]
        out.append(y[origins + h][:, None] - made)
    return out


def forecast_series(y: np.ndarray, horizon: int) -> pd.DataFrame:
    """``h, made, sd`` for one gapless series.

    With fewer than two seasons and a day nothing can be tried: the forecast is the mean of the
    last season's days, and the band their spread.
    """
    distance = np.arange(1, horizon + 1)
    if len(y) < 2 * SEASON + 1:
        last = y[-SEASON:]
        return pd.DataFrame({"h": distance, "made": last.mean(), "sd": last.std()})
    states = smooth(y)
    errors = rolling_errors(y, states, horizon)
    squares = np.concatenate(errors) ** 2
    best = int(np.argmin(np.round(squares.mean(axis=0), ERROR_DIGITS)))
    level, trend, season = (s[-1][..., best] for s in states)
    made = level + distance * trend + season[(len(y) - 1 + distance) % SEASON]
    # A distance without an origin has the spread of the longest that has one.
    spread = [np.sqrt((e[:, best] ** 2).mean()) if len(e) else np.nan for e in errors]
    return pd.DataFrame({"h": distance, "made": made, "sd": pd.Series(spread).ffill().to_numpy()})


def forecast_smoothed(
    series: DataFrame,
    time_col: str,
    value_col: str,
    horizon_days: int,
    group_col: str | None = None,
    floor: float | None = 0.0,
) -> DataFrame:
    """Days after each series' last one: ``[group_col], time_col, <value>_forecast, <value>_upper,
    <value>_lower``, as ``forecast.forecast`` gives them.

    Days without a row count as 0. Rows with a null time are no days. An empty table gives no rows.
    """
    keys = [group_col] if group_col else []
    daily = fill_daily_gaps(series.where(F.col(time_col).isNotNull()), time_col, value_col, group_col)
    daily = daily.select(*(F.col(k).alias("g") for k in keys), F.col(time_col).alias("ds"), F.col(value_col).cast("double").alias("y"))
    if not keys:
        daily = daily.withColumn("g", F.lit(None).cast("string"))
    group_type = dict(daily.dtypes)["g"]

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("ds")
        out = forecast_series(f["y"].to_numpy(), horizon_days)
        last = f["ds"].iloc[-1]
        days = [last + dt.timedelta(days=int(h)) for h in out["h"]]
        return out.assign(g=f["g"].iloc[0], ds=days)[["g", "ds", "made", "sd"]]

    made = daily.groupBy("g").applyInPandas(run, f"g {group_type}, ds timestamp_ntz, made double, sd double")

    def clamp(c):
        return F.round(c if floor is None else F.greatest(F.lit(float(floor)), c), DIGITS)

    band = F.lit(BAND_Z) * F.col("sd")
    return made.select(
        *(F.col("g").alias(k) for k in keys),
        F.col("ds").alias(time_col),
        clamp(F.col("made")).alias(f"{value_col}_forecast"),
        clamp(F.col("made") + band).alias(f"{value_col}_upper"),
        clamp(F.col("made") - band).alias(f"{value_col}_lower"),
    )
