"""Metric datasets over Gold and Silver: KPIs, roll-ups, rankings, trends.

Rankings always add the entity key as a tie-break so ``limit`` is
deterministic; Spark plans ``orderBy(...).limit(k)`` as a per-partition
top-k followed by a merge (``TakeOrderedAndProject``), which never sorts
the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.scalar import CRITICAL

# Column sets of the published worst-site tables.
HEADLINE_COLUMNS = [
    "site_id",
    "site_name",
    "region",
    "vendor",
    "total_alarms",
    "critical_alarms",
    "active_alarms",
    "avg_mttr_min",
    "fault_score",
]
TOP_SITES_COLUMNS = ["site_id", "site_name", "region", "state", "vendor", "fault_score"]
WORST_FIVE_COLUMNS = ["site_id", "site_name", "region", "fault_score", "critical_alarms", "active_alarms"]
WORST_CURATED_COLUMNS = ["site_id", "site_name", "region", "fault_score", "critical_alarms"]
SITE_DETAIL_COLUMNS = [
    "site_id",
    "site_name",
    "region",
    "state",
    "vendor",
    "equipment_type",
    "latitude",
    "longitude",
    "total_alarms",
    "critical_alarms",
    "active_alarms",
    "avg_mttr_min",
    "fault_score",
]
MAP_COLUMNS = ["site_id", "site_name", "equipment_type", "latitude", "longitude", "critical_alarms", "fault_score"]


def top_k(df: DataFrame, k: int, order: list[Column], tiebreak: list[str]) -> DataFrame:
    return df.orderBy(*order, *[F.col(c).asc() for c in tiebreak]).limit(k)


def worst_sites(gold: DataFrame, k: int = 10, columns: list[str] | None = None) -> DataFrame:
    """Top ``k`` sites by ``fault_score`` descending (``site_id`` breaks ties)."""
    ranked = top_k(gold, k, [F.desc("fault_score")], ["site_id"])
    return ranked.select(*(columns or HEADLINE_COLUMNS))


def site_detail(gold: DataFrame) -> DataFrame:
    return gold.select(*SITE_DETAIL_COLUMNS)


def map_points(gold: DataFrame) -> DataFrame:
    """Sites with coordinates, for a point map sized or coloured by score."""
    return gold.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(*MAP_COLUMNS)


def network_kpis(gold: DataFrame) -> DataFrame:
    """One row: network totals and the mean of site MTTRs, as published."""
    return gold.agg(
        F.sum("critical_alarms").alias("total_critical"),
        F.sum("active_alarms").alias("total_active"),
        F.round(F.avg("avg_mttr_min"), 1).alias("network_mttr"),
        F.count(F.lit(1)).alias("sites"),
    )


def region_rollup(gold: DataFrame) -> DataFrame:
    """Per region: sites, critical, active, mean of site MTTRs (dashboard form)."""
    return gold.groupBy("region").agg(
        F.count(F.lit(1)).alias("sites"),
        F.sum("critical_alarms").alias("critical_alarms"),
        F.sum("active_alarms").alias("active_alarms"),
        F.round(F.avg("avg_mttr_min"), 1).alias("avg_mttr"),
    )


def region_rollup_ordered(gold: DataFrame) -> DataFrame:
    """Per region, ordered by critical alarms (notebook form)."""
    return (
        gold.groupBy("region")
        .agg(
            F.sum("critical_alarms").alias("critical_alarms"),
            F.sum("active_alarms").alias("active_alarms"),
            F.round(F.avg("avg_mttr_min"), 1).alias("avg_mttr_min"),
        )
        .orderBy(F.desc("critical_alarms"), "region")
    )


def critical_by_region(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("region")
        .agg(F.sum("critical_alarms").alias("total_critical"))
        .orderBy(F.desc("total_critical"), "region")
    )


def top_critical_region(gold: DataFrame) -> DataFrame:
    return top_k(critical_by_region(gold), 1, [F.desc("total_critical")], ["region"]).select("region")


def mttr_by(silver: DataFrame, by: str = "vendor") -> DataFrame:
    """Alarm-level mean time to clear per group (not a mean of site means)."""
    return (
        silver.where(F.col("time_to_clear_min").isNotNull())
        .groupBy(by)
        .agg(F.round(F.avg("time_to_clear_min"), 1).alias("mttr_min"))
        .orderBy(F.desc("mttr_min"), by)
    )


def slowest(silver: DataFrame, by: str = "vendor") -> DataFrame:
    """The group with the highest alarm-level MTTR (unrounded mean decides)."""
    means = (
        silver.where(F.col("time_to_clear_min").isNotNull())
        .groupBy(by)
        .agg(F.avg("time_to_clear_min").alias("_mttr"))
    )
    return top_k(means, 1, [F.desc("_mttr")], [by]).select(by)


def active_share(gold: DataFrame) -> DataFrame:
    """Share of open alarms per region: ratio of sums, not a mean of ratios."""
    return (
        gold.groupBy("region")
        .agg(F.round(F.try_divide(F.sum("active_alarms"), F.sum("total_alarms")), 3).alias("active_share"))
        .orderBy(F.desc("active_share"), "region")
    )


def top_active_region(gold: DataFrame) -> DataFrame:
    ratios = gold.groupBy("region").agg(
        F.try_divide(F.sum("active_alarms"), F.sum("total_alarms")).alias("_share")
    )
    return top_k(ratios, 1, [F.desc("_share")], ["region"]).select("region")


def daily_counts(silver: DataFrame, severity: str | None = None, name: str = "alarms") -> DataFrame:
    """Alarms per ``event_date``; days without an alarm are absent (no zero fill)."""
    src = silver if severity is None else silver.where(F.col("severity") == severity)
    return src.groupBy("event_date").agg(F.count(F.lit(1)).alias(name)).orderBy("event_date")


def daily_critical_trend(silver: DataFrame) -> DataFrame:
    return daily_counts(silver, CRITICAL, "critical_alarms")


def daily_alarms(silver: DataFrame, group_col: str | None = None, fill_gaps: bool = False) -> DataFrame:
    """The forecast input ``(ds, alarm_count)``, ``ds`` the day as a timestamp.

    Days without an alarm are absent unless ``fill_gaps``, which adds them
    with a zero count between each series' first and last day.
    """
    keys = ["event_date"] + ([group_col] if group_col else [])
    counts = silver.groupBy(*keys).agg(F.count(F.lit(1)).alias("alarm_count"))
    head = [group_col] if group_col else []
    daily = counts.select(*head, F.col("event_date").cast("timestamp_ntz").alias("ds"), "alarm_count")
    return fill_daily_gaps(daily, "ds", "alarm_count", group_col) if fill_gaps else daily


def fill_daily_gaps(daily: DataFrame, time_col: str, value_col: str, group_col: str | None = None) -> DataFrame:
    """Every day between each series' first and last day, missing days at 0.

    The day range comes from one min / max aggregate per series and
    ``sequence`` + ``explode``; the counts are joined back on
    ``(series, day)``, a key that never repeats.
    """
    keys = [group_col] if group_col else []
    aggs = [F.min(time_col).alias("_lo"), F.max(time_col).alias("_hi")]
    bounds = daily.groupBy(*keys).agg(*aggs) if keys else daily.agg(*aggs)
    days = bounds.select(
        *keys, F.explode(F.sequence("_lo", "_hi", F.make_dt_interval(days=F.lit(1)))).alias(time_col)
    )
    filled = days.join(daily, [*keys, time_col], "left")
    return filled.select(*keys, time_col, F.coalesce(F.col(value_col), F.lit(0)).cast("bigint").alias(value_col))


def worst_site(gold: DataFrame) -> DataFrame:
    """One-row frame: the site with the highest ``fault_score``."""
    return top_k(gold, 1, [F.desc("fault_score")], ["site_id"]).select("site_id")


def worst_site_causes(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Probable causes of the worst site's alarms, most frequent first.

    The right side is a single row (a top-1), so broadcasting it is safe at
    any scale; the join acts as a semi-join filter on Silver.
    """
    target = F.broadcast(worst_site(gold))
    return (
        silver.join(target, "site_id", "inner")
        .groupBy("probable_cause")
        .agg(F.count(F.lit(1)).alias("alarms"))
        .orderBy(F.desc("alarms"), "probable_cause")
    )


def worst_site_top_cause(silver: DataFrame, gold: DataFrame) -> DataFrame:
    causes = worst_site_causes(silver, gold)
    return top_k(causes, 1, [F.desc("alarms")], ["probable_cause"]).select("probable_cause")


def top_cause_by_site(silver: DataFrame) -> DataFrame:
    """``site_id, probable_cause, alarms, share`` of the most frequent cause of every site.

    Alarms are counted per site and cause first, in the map tasks: a hot site leaves a task as one
    row per cause. Equal counts go to the cause that sorts first; a null cause is a cause, last.
    """
    counts = silver.groupBy("site_id", "probable_cause").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct((-F.col("n")).alias("n"), F.col("probable_cause").isNull().alias("none"), "probable_cause")
    top = counts.groupBy("site_id").agg(F.min(rank).alias("top"), F.sum("n").alias("total"))
    return top.select(
        "site_id",
        F.col("top.probable_cause").alias("probable_cause"),
        (-F.col("top.n")).alias("alarms"),
        F.round(-F.col("top.n") / F.col("total"), 4).alias("share"),
    )


def severity_by_region(silver: DataFrame) -> DataFrame:
    return silver.groupBy("region", "severity").agg(F.count(F.lit(1)).alias("alarms"))


def clear_time_histogram(silver: DataFrame, width: int = 60) -> DataFrame:
    """Counts of cleared alarms in fixed-width minute buckets ``[lo, lo + width)``."""
    t = F.col("time_to_clear_min")
    return (
        silver.where(t.isNotNull())
        .groupBy((F.floor(t / F.lit(width)) * F.lit(width)).cast("bigint").alias("bucket_start_min"))
        .agg(F.count(F.lit(1)).alias("alarms"))
        .orderBy("bucket_start_min")
    )


def clear_time_summary(silver: DataFrame, by: str | None = None) -> DataFrame:
    """Min, exact quartiles (nearest rank) and max of minutes to clear, optionally per group.

    Alarms are counted per group and whole minute first; the running sum then sees the distinct
    minutes only, whatever the size of a group.
    """
    keys = [by] if by else []
    t = F.col("time_to_clear_min")
    minutes = silver.where(t.isNotNull()).groupBy(*keys, "time_to_clear_min").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    ranked = minutes.select(
        "*", F.sum("_n").over(group.orderBy(t)).alias("_upto"), F.sum("_n").over(group).alias("_all")
    )

    def percentile(p: int) -> Column:
        return F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * p, t))

    return ranked.groupBy(*keys).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("cleared_alarms"),
        F.min(t).alias("min_min"),
        *[percentile(p).alias(f"p{p}_min") for p in (25, 50, 75, 95)],
        F.max(t).alias("max_min"),
    )
