"""Silver (one clean row per alarm) and Gold (one health row per site)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.scalar import CRITICAL, SEVERITY_WEIGHTS, severity_weight, time_to_clear
from faultline.operators.dedupe import dedupe_first
from faultline.operators.joins import DEFAULT_BROADCAST_MAX_BYTES, bounded_broadcast
from faultline.schemas import ALARM_COLUMNS, GOLD_ATTRIBUTES, SITE_ATTRIBUTES


def site_dimension(sites: DataFrame) -> DataFrame:
    """The site columns Silver carries; its size is the one measured."""
    return sites.select("site_id", *SITE_ATTRIBUTES)


def build_silver(
    alarms: DataFrame,
    sites: DataFrame,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Deduplicate, enrich and clean the raw alarm feed.

    Order matters and is kept: the earliest copy of each ``alarm_id`` is
    chosen on the raw feed first; only then are rows with a null ``site_id``
    or ``severity`` (or an unknown site) dropped. An alarm whose earliest copy
    is incomplete is therefore lost even when a later copy is complete.

    Plan: one shuffle on ``alarm_id`` (pre-reduced by a partial
    ``WindowGroupLimit``), then a join to the site dimension that broadcasts
    the dimension when it is measured to be small and otherwise
    sort-merges on ``site_id`` with adaptive skew splitting.
    """
    first = dedupe_first(alarms.select(*ALARM_COLUMNS), "alarm_id", ["raised_ts"])
    dim = bounded_broadcast(site_dimension(sites), max_broadcast_bytes)
    joined = first.join(dim, "site_id", "inner")
    kept = joined.where(F.col("site_id").isNotNull() & F.col("severity").isNotNull())
    return kept.select(
        *ALARM_COLUMNS,
        *SITE_ATTRIBUTES,
        time_to_clear("raised_ts", "cleared_ts").alias("time_to_clear_min"),
        F.col("cleared_ts").isNull().alias("is_active"),
    )


def build_gold(silver: DataFrame, weights: dict[str, int] | None = None) -> DataFrame:
    """One row per ``site_id`` with alarm KPIs and the severity-weighted ``fault_score``.

    Built from Silver alone, so a site that has left the dimension, or changed there, keeps what
    Silver says. Each attribute is the ``MAX`` over the site's alarms, as sites may carry several
    values. Two steps: the large side is grouped by site and attributes with numeric buffers
    only (a code-generated hash aggregate with partial aggregation, so a hot site is one row per
    map task and attribute set); ``MAX`` of strings, which needs a sort-based aggregate, then
    sees about one row per site.

    Sites without a surviving alarm have no row; a site whose alarms are all open has a null
    ``avg_mttr_min``.
    """
    weights = SEVERITY_WEIGHTS if weights is None else weights
    partial = silver.groupBy("site_id", *GOLD_ATTRIBUTES).agg(
        F.count(F.lit(1)).alias("total_alarms"),
        F.count_if(F.col("severity") == CRITICAL).alias("critical_alarms"),
        F.count_if(F.col("is_active")).alias("active_alarms"),
        F.sum("time_to_clear_min").alias("_minutes"),
        F.count("time_to_clear_min").alias("_cleared"),
        F.sum(severity_weight("severity", weights)).cast("bigint").alias("fault_score"),
    )
    return partial.groupBy("site_id").agg(
        *[F.max(c).alias(c) for c in GOLD_ATTRIBUTES],
        *[F.sum(c).alias(c) for c in ("total_alarms", "critical_alarms", "active_alarms")],
        F.round(F.try_divide(F.sum("_minutes"), F.sum("_cleared")), 1).alias("avg_mttr_min"),
        F.sum("fault_score").alias("fault_score"),
    )
