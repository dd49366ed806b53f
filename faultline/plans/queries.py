"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the driver's tables through the fixture feeds, so its
work grows with them. Keys follow the operator inventory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators import contract
from faultline.operators import forecast as FC
from faultline.operators import governance as G
from faultline.operators import grading as GR
from faultline.operators import metrics as M
from faultline.operators import profile as P
from faultline.operators import quality as Q
from faultline.operators import sketches as SK
from faultline.operators.dedupe import dedupe_first
from faultline.operators.impact import impact
from faultline.operators.joins import bounded_broadcast
from faultline.operators.medallion import build_gold, build_silver
from faultline.operators.smoothing import forecast_smoothed
from faultline.plans.catalog import compile_metrics
from faultline.plans.pipeline import Layers
from faultline.schemas import ALARM_COLUMNS
from faultline.sources import footers
from faultline.sources import generate as GEN
from faultline.sources.fixtures import AUDIT_AS_OF, AUDIT_TABLE, alarms_from_events
from faultline.sources.tables import preview, read_files_sql, scan_named, table_path

# Parameters of the registered reports.
FORECAST_DAYS = 7
HISTOGRAM_WIDTH_MIN = 60
UPSTREAM_OF = AUDIT_TABLE
DOWNSTREAM_OF = "main.net.s3"
IMPACT_OF = "main.net.n1"
ORIGINS_OF = "main.net.n5"
SKETCH_DAYS = ("2024-01-11", "2024-01-24")
DASHBOARD = {
    "network": ((), ("sites", "total_alarms", "critical_alarms", "active_alarms", "avg_mttr_min")),
    "regions": (("region",), ("sites", "total_alarms", "critical_alarms", "fault_score", "avg_mttr_min")),
    "vendors": (("vendor",), ("sites", "fault_score", "active_share")),
    "region_vendors": (("region", "vendor"), ("fault_score", "active_alarms")),
    "equipment": (("equipment_type",), ("sites", "critical_alarms", "active_share")),
}
SITES_VIEW = "faultline_sites"
# Sites of the changed copies in ``gold_duplicate_sites``: one in so many.
CHANGED_SITE_ONE_IN = 50

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: Callable[[Layers], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Layers(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        run.layer_fn = fn
        REGISTRY[name] = run
        return run

    return deco


# ---- medallion -------------------------------------------------------------


@register("silver_alarms")
def q_silver(L: Layers) -> DataFrame:
    return L.silver()


@register("gold_site_health")
def q_gold(L: Layers) -> DataFrame:
    return L.gold()


@register("gold_duplicate_sites")
def q_gold_duplicate_sites(L: Layers) -> DataFrame:
    """Gold where one site in 50 has a second, changed row in the dimension."""
    sites = L.sites()
    number = F.substring("site_id", 6, 20).cast("bigint")
    changed = sites.where(number % CHANGED_SITE_ONE_IN == 0).withColumns(
        {"region": F.concat("region", F.lit(" B")), "latitude": F.col("latitude") - 1}
    )
    return build_gold(build_silver(L.alarms(), sites.unionByName(changed)))


# ---- rankings and roll-ups ---------------------------------------------------


@register("worst_sites_10")
def q_worst10(L: Layers) -> DataFrame:
    return M.worst_sites(L.gold(), 10, M.HEADLINE_COLUMNS)


@register("worst_sites_15")
def q_worst15(L: Layers) -> DataFrame:
    return M.worst_sites(L.gold(), 15, M.TOP_SITES_COLUMNS)


@register("worst_sites_5")
def q_worst5(L: Layers) -> DataFrame:
    return M.worst_sites(L.gold(), 5, M.WORST_FIVE_COLUMNS)


@register("worst_sites_curated")
def q_worst_curated(L: Layers) -> DataFrame:
    return M.worst_sites(L.gold(), 10, M.WORST_CURATED_COLUMNS)


@register("worst_site")
def q_worst_site(L: Layers) -> DataFrame:
    return M.worst_site(L.gold())


@register("site_detail")
def q_site_detail(L: Layers) -> DataFrame:
    return M.site_detail(L.gold())


@register("map_points")
def q_map_points(L: Layers) -> DataFrame:
    return M.map_points(L.gold())


@register("network_kpis")
def q_kpis(L: Layers) -> DataFrame:
    return M.network_kpis(L.gold())


@register("region_rollup")
def q_region_rollup(L: Layers) -> DataFrame:
    return M.region_rollup(L.gold())


@register("region_rollup_ordered")
def q_region_rollup_ordered(L: Layers) -> DataFrame:
    return M.region_rollup_ordered(L.gold())


@register("critical_by_region")
def q_critical_by_region(L: Layers) -> DataFrame:
    return M.critical_by_region(L.gold())


@register("top_critical_region")
def q_top_critical_region(L: Layers) -> DataFrame:
    return M.top_critical_region(L.gold())


@register("vendor_mttr")
def q_vendor_mttr(L: Layers) -> DataFrame:
    return M.mttr_by(L.silver(), "vendor")


@register("slowest_vendor")
def q_slowest_vendor(L: Layers) -> DataFrame:
    return M.slowest(L.silver(), "vendor")


@register("region_mttr")
def q_region_mttr(L: Layers) -> DataFrame:
    return M.mttr_by(L.silver(), "region")


@register("active_share")
def q_active_share(L: Layers) -> DataFrame:
    return M.active_share(L.gold())


@register("top_active_region")
def q_top_active_region(L: Layers) -> DataFrame:
    return M.top_active_region(L.gold())


@register("daily_critical_trend")
def q_daily_critical(L: Layers) -> DataFrame:
    return M.daily_critical_trend(L.silver())


@register("daily_alarms")
def q_daily_alarms(L: Layers) -> DataFrame:
    return M.daily_alarms(L.silver())


@register("daily_alarms_filled")
def q_daily_alarms_filled(L: Layers) -> DataFrame:
    return M.daily_alarms(L.silver(), "region", fill_gaps=True)


@register("worst_site_causes")
def q_worst_site_causes(L: Layers) -> DataFrame:
    return M.worst_site_causes(L.silver(), L.gold())


@register("worst_site_top_cause")
def q_worst_site_top_cause(L: Layers) -> DataFrame:
    return M.worst_site_top_cause(L.silver(), L.gold())


@register("severity_by_region")
def q_severity_by_region(L: Layers) -> DataFrame:
    return M.severity_by_region(L.silver())


@register("clear_time_histogram")
def q_clear_hist(L: Layers) -> DataFrame:
    return M.clear_time_histogram(L.silver(), HISTOGRAM_WIDTH_MIN)


# ---- profiling and quality ---------------------------------------------------


@register("null_profile")
def q_null_profile(L: Layers) -> DataFrame:
    return P.null_profile(L.alarms(), ["site_id", "severity"])


@register("duplicate_profile")
def q_duplicate_profile(L: Layers) -> DataFrame:
    return P.duplicate_profile(L.alarms(), "alarm_id")


@register("feed_profile")
def q_feed_profile(L: Layers) -> DataFrame:
    return P.feed_profile(L.alarms(), "alarm_id", ["site_id", "severity"])


@register("severity_distribution")
def q_severity_distribution(L: Layers) -> DataFrame:
    return P.distribution(L.alarms(), "severity")


@register("alarm_type_distribution")
def q_alarm_type_distribution(L: Layers) -> DataFrame:
    return P.distribution(L.alarms(), "alarm_type")


@register("coordinate_ranges")
def q_coordinate_ranges(L: Layers) -> DataFrame:
    return P.range_profile(L.sites(), "region", {"latitude": "lat", "longitude": "lon"}, "sites", 2)


@register("preview_alarms")
def q_preview_alarms(L: Layers) -> DataFrame:
    return preview(L.alarms(), 20, ALARM_COLUMNS)


@register("preview_sites")
def q_preview_sites(L: Layers) -> DataFrame:
    return preview(L.sites(), 20, ["site_id"])


@register("join_preview")
def q_join_preview(L: Layers) -> DataFrame:
    """Alarms joined to sites before deduplication (what Silver roughly holds)."""
    a = L.alarms()
    joined = a.join(bounded_broadcast(L.sites()), "site_id", "inner")
    return joined.where(F.col("site_id").isNotNull() & F.col("severity").isNotNull()).select(
        "alarm_id", "site_id", "region", "vendor", "severity", "latitude", "longitude"
    )


@register("dedupe_alarms")
def q_dedupe_alarms(L: Layers) -> DataFrame:
    return dedupe_first(L.alarms(), "alarm_id", ["raised_ts"])


@register("silver_rejects")
def q_silver_rejects(L: Layers) -> DataFrame:
    rejected = Q.silver_rejects(L.alarms(), L.sites())
    return rejected.select(*ALARM_COLUMNS, F.array_join(Q.REASONS, ",").alias("reason_list"))


@register("expectation_counts")
def q_expectation_counts(L: Layers) -> DataFrame:
    return Q.silver_expectation_counts(L.alarms(), L.sites())


@register("feed_contract")
def q_feed_contract(L: Layers) -> DataFrame:
    """Six rules about rows, keys, references and the whole feed, given as data."""
    return contract.report(L.alarms(), Q.feed_rules(L.sites()))


@register("silver_validation")
def q_silver_validation(L: Layers) -> DataFrame:
    """The raw feed is read as a path table inside SQL."""
    events = read_files_sql(L.spark, table_path(L.sf_dir, "events"))
    return Q.validate_silver(alarms_from_events(events), L.silver())


@register("sites_validation")
def q_sites_validation(L: Layers) -> DataFrame:
    """The sites are read by a table name bound at run time."""
    L.sites().createOrReplaceTempView(SITES_VIEW)
    return Q.validate_sites(scan_named(L.spark, SITES_VIEW))


@register("gold_validation")
def q_gold_validation(L: Layers) -> DataFrame:
    return Q.validate_gold(L.gold())


@register("clear_time_summary")
def q_clear_time_summary(L: Layers) -> DataFrame:
    return M.clear_time_summary(L.silver(), "region")


@register("clear_time_sketched")
def q_clear_time_sketched(L: Layers) -> DataFrame:
    """Quantiles of a window of days from the daily sketches per region."""
    daily = SK.quantile_sketch(L.silver(), ["event_date", "region"], "time_to_clear_min")
    window = daily.where(F.col("event_date").between(*SKETCH_DAYS))
    return SK.sketched_quantiles(SK.merge_quantiles(window, ["region"]), ["region"], [25, 50, 75, 95])


@register("site_top_cause")
def q_site_top_cause(L: Layers) -> DataFrame:
    return M.top_cause_by_site(L.silver())


@register("dashboard_metrics")
def q_dashboard_metrics(L: Layers) -> DataFrame:
    """Five reports of the dashboard from one pass over Gold."""
    return compile_metrics(L.gold(), DASHBOARD)


# ---- governance ------------------------------------------------------------


@register("table_usage")
def q_table_usage(L: Layers) -> DataFrame:
    return G.table_usage(L.feeds.audit(), AUDIT_TABLE, AUDIT_AS_OF, 30)


@register("table_grants")
def q_table_grants(L: Layers) -> DataFrame:
    return G.table_grants(L.feeds.grants(), AUDIT_TABLE)


@register("stale_grants")
def q_stale_grants(L: Layers) -> DataFrame:
    return G.stale_grants(L.feeds.grants(), L.feeds.audit(), AUDIT_TABLE, AUDIT_AS_OF, 30)


@register("lineage_upstream")
def q_lineage_upstream(L: Layers) -> DataFrame:
    return G.lineage(L.feeds.lineage(), UPSTREAM_OF, "upstream")


@register("lineage_downstream")
def q_lineage_downstream(L: Layers) -> DataFrame:
    return G.lineage(L.feeds.lineage(), DOWNSTREAM_OF, "downstream")


@register("lineage_impact")
def q_lineage_impact(L: Layers) -> DataFrame:
    return impact(L.feeds.table_graph(), IMPACT_OF, "downstream")


@register("lineage_origins")
def q_lineage_origins(L: Layers) -> DataFrame:
    return impact(L.feeds.table_graph(), ORIGINS_OF, "upstream")


@register("usage_rolling")
def q_usage_rolling(L: Layers) -> DataFrame:
    return G.usage_rolling(L.feeds.audit(), 30)


@register("frequent_tables_sketched")
def q_frequent_tables_sketched(L: Layers) -> DataFrame:
    """From daily sketches; exact up to a few hundred users a table."""
    return G.frequent_tables_sketched(G.usage_sketch(L.feeds.audit()), AUDIT_AS_OF.date(), 30, 10)


@register("frequent_users")
def q_frequent_users(L: Layers) -> DataFrame:
    return G.frequent_users(L.feeds.audit(), AUDIT_AS_OF, 30, 10)


@register("frequent_tables")
def q_frequent_tables(L: Layers) -> DataFrame:
    return G.frequent_tables(L.feeds.audit(), AUDIT_AS_OF, 30, 10)


@register("usage_notices")
def q_usage_notices(L: Layers) -> DataFrame:
    usage = G.table_usage(L.feeds.audit(), AUDIT_TABLE, AUDIT_AS_OF, 30)
    return G.usage_notices(usage, AUDIT_TABLE, 30)


@register("table_file_stats")
def q_table_file_stats(L: Layers) -> DataFrame:
    return footers.file_stats(L.spark, table_path(L.sf_dir, "events"))


@register("table_column_stats")
def q_table_column_stats(L: Layers) -> DataFrame:
    return footers.column_stats(L.spark, table_path(L.sf_dir, "events"))


# ---- forecast --------------------------------------------------------------


@register("daily_forecast")
def q_daily_forecast(L: Layers) -> DataFrame:
    return FC.forecast(M.daily_alarms(L.silver()), "ds", "alarm_count", horizon_days=FORECAST_DAYS, floor=0.0)


@register("daily_forecast_weekly")
def q_daily_forecast_weekly(L: Layers) -> DataFrame:
    daily = M.daily_alarms(L.silver())
    return FC.forecast(daily, "ds", "alarm_count", horizon_days=FORECAST_DAYS, floor=0.0, weekly=True)


@register("daily_forecast_smoothed")
def q_daily_forecast_smoothed(L: Layers) -> DataFrame:
    """Per region, with trend and weekly season."""
    daily = M.daily_alarms(L.silver(), "region")
    return forecast_smoothed(daily, "ds", "alarm_count", FORECAST_DAYS, group_col="region")


@register("alarm_forecast")
def q_alarm_forecast(L: Layers) -> DataFrame:
    daily = M.daily_alarms(L.silver())
    return FC.actual_vs_forecast(daily, "ds", "alarm_count", horizon_days=FORECAST_DAYS, floor=0.0)


@register("alarm_forecast_by_region")
def q_alarm_forecast_by_region(L: Layers) -> DataFrame:
    daily = M.daily_alarms(L.silver(), "region")
    return FC.actual_vs_forecast(
        daily, "ds", "alarm_count", horizon_days=FORECAST_DAYS, group_col="region", floor=0.0
    )


# ---- answer grading ----------------------------------------------------------


def _scored(L: Layers) -> DataFrame:
    return GR.score_answers(L.feeds.truths(), L.feeds.answers())


@register("benchmark_truths")
def q_benchmark_truths(L: Layers) -> DataFrame:
    return GR.benchmark_truths(L.silver(), L.gold())


@register("score_answers")
def q_score_answers(L: Layers) -> DataFrame:
    return _scored(L)


@register("round_score")
def q_round_score(L: Layers) -> DataFrame:
    return GR.round_score(_scored(L))


@register("answer_lift")
def q_answer_lift(L: Layers) -> DataFrame:
    return GR.answer_lift(_scored(L))


@register("lift_summary")
def q_lift_summary(L: Layers) -> DataFrame:
    return GR.lift_summary(_scored(L))


# ---- generators --------------------------------------------------------------


@register("gen_sites")
def q_gen_sites(L: Layers) -> DataFrame:
    """Synthetic sites, one per customer key."""
    return GEN.generate_sites(L.feeds.table("customer"), "c_custkey")


def site_span(L: Layers) -> dict[str, int]:
    """The numbers of the synthetic sites: as many as customers, from the first key on."""
    row = L.feeds.table("customer").agg(F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("low")).first()
    return {"n_sites": row.n, "first_site": row.low or 0}


@register("gen_alarms")
def q_gen_alarms(L: Layers) -> DataFrame:
    """Synthetic alarms, one per event id, on the synthetic sites."""
    return GEN.generate_alarms(L.feeds.table("events"), id_col="event_id", **site_span(L))


@register("seed_nulls")
def q_seed_nulls(L: Layers) -> DataFrame:
    alarms = GEN.generate_alarms(L.feeds.table("events"), id_col="event_id", **site_span(L))
    return P.null_profile(alarms, ["site_id", "severity"])


@register("seed_duplicates")
def q_seed_duplicates(L: Layers) -> DataFrame:
    feed = GEN.generate_alarm_feed(L.feeds.table("events"), id_col="event_id", **site_span(L))
    return P.duplicate_profile(feed, "alarm_id")


@register("gen_alarm_feed")
def q_gen_alarm_feed(L: Layers) -> DataFrame:
    return GEN.generate_alarm_feed(L.feeds.table("events"), id_col="event_id", **site_span(L))


@register("generated_gold")
def q_generated_gold(L: Layers) -> DataFrame:
    """Gold of the generated feeds: sites and alarms as the generators make them."""
    alarms = GEN.generate_alarm_feed(L.feeds.table("events"), id_col="event_id", **site_span(L))
    sites = GEN.generate_sites(L.feeds.table("customer"), "c_custkey")
    return build_gold(build_silver(alarms, sites))


def queries() -> dict[str, QueryFn]:
    return dict(REGISTRY)
