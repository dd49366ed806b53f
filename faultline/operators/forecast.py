"""Trend forecast of a daily series and the actual-versus-forecast table.

The model is ordinary least squares on the day number, fitted per series
with the ``regr_*`` aggregates (one pass, mergeable, so every series is one
partial row per map task). Future days come from ``sequence`` + ``explode``
on the one-row-per-series fit. Values are clamped at ``floor``; the band is
the fitted value ± 1.96 residual standard deviations.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAND_Z = 1.96
DIGITS = 4


def _day_number(ts: Column) -> Column:
    return F.unix_date(ts.cast("date")).cast("double")


def fit_trend(
    series: DataFrame, time_col: str, value_col: str, group_col: str | None = None, weekly: bool = False
) -> DataFrame:
    """Per series: slope, intercept, residual sd, last time stamp and value, point count.

    With ``weekly`` also the mean day number and mean value per weekday
    (arrays indexed by ``dayofweek``), from conditional averages in the
    same aggregation.
    """
    x = _day_number(F.col(time_col))
    y = F.col(value_col).cast("double")
    keys = [group_col] if group_col else []
    aggs = [
        F.regr_slope(y, x).alias("_slope"),
        F.regr_intercept(y, x).alias("_intercept"),
        F.regr_syy(y, x).alias("_syy"),
        F.regr_sxy(y, x).alias("_sxy"),
        F.regr_sxx(y, x).alias("_sxx"),
        F.regr_count(y, x).alias("_n"),
        F.avg(y).alias("_ybar"),
        F.max(time_col).alias("_last"),
        F.max_by(F.col(value_col), F.col(time_col)).alias("_last_value"),
    ]
    if weekly:
        dow = _weekday(F.col(time_col))
        aggs += [F.avg(F.when(dow == d, y)).alias(f"_wy{d}") for d in range(1, 8)]
        aggs += [F.avg(F.when(dow == d, x)).alias(f"_wx{d}") for d in range(1, 8)]
    fit = series.groupBy(*keys).agg(*aggs) if keys else series.agg(*aggs)
    sse = F.greatest(F.col("_syy") - F.col("_sxy") * F.col("_sxy") / F.col("_sxx"), F.lit(0.0))
    sd = F.when(F.col("_n") > 2, F.sqrt(sse / (F.col("_n") - 2))).otherwise(F.lit(0.0))
    return fit.select(
        *keys,
        # one distinct day: no slope; the forecast is flat at the mean
        F.coalesce(F.col("_slope"), F.lit(0.0)).alias("_slope"),
        F.coalesce(F.col("_intercept"), F.col("_ybar"), F.lit(0.0)).alias("_intercept"),
        sd.alias("_sd"),
        "_last",
        "_last_value",
        "_n",
        *(
            [
                F.array(*[F.col(f"_wy{d}") for d in range(1, 8)]).alias("_wy"),
                F.array(*[F.col(f"_wx{d}") for d in range(1, 8)]).alias("_wx"),
            ]
            if weekly
            else []
        ),
    )


def forecast(
    series: DataFrame,
    time_col: str,
    value_col: str,
    horizon: dt.datetime | str | None = None,
    horizon_days: int | None = None,
    group_col: str | None = None,
    floor: float | None = 0.0,
    weekly: bool = False,
) -> DataFrame:
    """Daily points after the last observation up to ``horizon`` (exclusive).

    Give either an absolute ``horizon`` or ``horizon_days`` after each
    series' last point. Output: ``[group_col], time_col,
    <value>_forecast, <value>_upper, <value>_lower`` rounded to 4 digits.
    ``weekly`` adds each weekday's mean residual from the trend (a weekday
    effect), ``avg_d(y) - intercept - slope * avg_d(x)``; the per-weekday
    means come out of the same single aggregation as the trend, so no join
    is needed. The band keeps the trend's residual spread.
    """
    fit = fit_trend(series, time_col, value_col, group_col, weekly)
    return _future(fit, time_col, value_col, horizon, horizon_days, group_col, floor)



def _weekday(ts: Column) -> Column:
    return F.dayofweek(ts.cast("date"))

def _future(
    fit: DataFrame,
    time_col: str,
    value_col: str,
    horizon,
    horizon_days: int | None,
    group_col: str | None,
    floor: float | None,
) -> DataFrame:
    if (horizon is None) == (horizon_days is None):
        raise ValueError("give exactly one of horizon, horizon_days")
    start = F.col("_last") + F.make_dt_interval(days=F.lit(1))
    if horizon is not None:
        end = F.lit(horizon).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(1))
    else:
        end = F.col("_last") + F.make_dt_interval(days=F.lit(horizon_days))
    days = F.when(start <= end, F.sequence(start, end, F.make_dt_interval(days=F.lit(1)))).otherwise(
        F.array().cast("array<timestamp_ntz>")
    )
    keys = [group_col] if group_col else []
    weekly = "_wy" in fit.columns
    carry = ["_wy", "_wx"] if weekly else []
    points = fit.select(*keys, "_slope", "_intercept", "_sd", *carry, F.explode(days).alias(time_col))
    yhat = F.col("_intercept") + F.col("_slope") * _day_number(F.col(time_col))
    if weekly:
        d = _weekday(F.col(time_col))
        my, mx = F.element_at(F.col("_wy"), d), F.element_at(F.col("_wx"), d)
        effect = my - (F.col("_intercept") + F.col("_slope") * mx)
        yhat = yhat + F.coalesce(effect, F.lit(0.0))

    def clamp(c: Column) -> Column:
        return F.round(c if floor is None else F.greatest(F.lit(float(floor)), c), DIGITS)

    band = F.lit(BAND_Z) * F.col("_sd")
    return points.select(
        *keys,
        time_col,
        clamp(yhat).alias(f"{value_col}_forecast"),
        clamp(yhat + band).alias(f"{value_col}_upper"),
        clamp(yhat - band).alias(f"{value_col}_lower"),
    )


def actual_vs_forecast(
    daily: DataFrame,
    time_col: str = "ds",
    value_col: str = "alarm_count",
    horizon: dt.datetime | str | None = None,
    horizon_days: int | None = None,
    group_col: str | None = None,
    floor: float | None = 0.0,
) -> DataFrame:
    """Three stacked parts per series: actuals, a bridge point, forecasts.

    The bridge repeats each series' last actual as a forecast value so the
    two lines meet. ``actual`` is the count (bigint), ``forecast`` a double.
    The bridge comes out of the same one-pass fit as the forecast
    (``max_by(value, time)``), so the daily series is aggregated once for
    the actuals and once for the fit, and both read the same shuffle.
    """
    keys = [group_col] if group_col else []
    fit = fit_trend(daily, time_col, value_col, group_col)
    actual = daily.select(
        *keys, time_col, F.col(value_col).cast("bigint").alias("actual"), F.lit(None).cast("double").alias("forecast")
    )
    bridge = fit.select(
        *keys,
        F.col("_last").alias(time_col),
        F.lit(None).cast("bigint").alias("actual"),
        F.col("_last_value").cast("double").alias("forecast"),
    )
    future = _future(fit, time_col, value_col, horizon, horizon_days, group_col, floor).select(
        *keys,
        time_col,
        F.lit(None).cast("bigint").alias("actual"),
        F.col(f"{value_col}_forecast").cast("double").alias("forecast"),
    )
    return actual.unionByName(bridge).unionByName(future)
