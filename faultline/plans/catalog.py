"""Metric catalogue: what each metric means, where it lives, how to rank.

A plain registry a user (or a question-answering front end) consults to
pick the right layer and function. ``compile_metrics`` plans several metrics by several
dimensions as one grouped pass over Gold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Metric:
    name: str
    layer: str  # "gold" (one row per site) or "silver" (one row per alarm)
    definition: str
    better: str  # "higher", "lower" or "n/a"
    query: str | None = None  # registered query answering it
    synonyms: tuple[str, ...] = field(default_factory=tuple)


# Metric definitions and ranking rules.
METRICS = {
    m.name: m
    for m in [
        Metric(
            "fault_score",
            "gold",
            "Severity-weighted alarm score per site: Critical 10, Major 5, Minor 2, any other severity 1, summed.",
            "lower",
            "worst_sites_10",
            ("worst", "most problematic", "unhealthiest", "priority", "top"),
        ),
        Metric("critical_alarms", "gold", "Count of alarms with severity exactly 'Critical'.", "lower", "critical_by_region"),
        Metric("active_alarms", "gold", "Alarms not yet cleared (cleared_ts is null).", "lower", "network_kpis"),
        Metric(
            "avg_mttr_min",
            "gold",
            "Mean minutes to clear a fault per site (mean time to repair); open alarms excluded.",
            "lower",
            "site_detail",
        ),
        Metric(
            "vendor_mttr",
            "silver",
            "Alarm-level mean minutes to clear per vendor; never an average of site averages.",
            "lower",
            "vendor_mttr",
        ),
        Metric(
            "region_mttr",
            "silver",
            "Alarm-level mean minutes to clear per region; never an average of site averages.",
            "lower",
            "region_mttr",
        ),
        Metric(
            "active_share",
            "gold",
            "Share of open alarms per region: sum(active_alarms) / sum(total_alarms).",
            "lower",
            "active_share",
        ),
        Metric("daily_alarms", "silver", "Alarms per event_date; days without alarms are absent.", "n/a", "daily_alarms"),
        Metric(
            "daily_critical_alarms",
            "silver",
            "Critical alarms per event_date.",
            "n/a",
            "daily_critical_trend",
        ),
        Metric(
            "top_probable_cause",
            "silver",
            "Most frequent probable_cause among the alarms of the site with the highest fault_score.",
            "n/a",
            "worst_site_top_cause",
        ),
    ]
}

# Which layer to use for which kind of question.
LAYER_GUIDANCE = {
    "gold": "One row per site with KPIs and coordinates: rankings, regional roll-ups, the map, site counts.",
    "silver": "One row per alarm joined to the site inventory: time trends, per-alarm detail, "
    "severity breakdowns, time-to-clear distributions.",
}


def metric(name: str) -> Metric:
    return METRICS[name]


def resolve(term: str) -> list[Metric]:
    """Metrics whose name or ranking synonyms match ``term`` (case-insensitive)."""
    t = term.lower()
    return [m for m in METRICS.values() if t == m.name or t in m.synonyms]


def _gold_expressions() -> dict[str, Column]:
    """Metrics that Gold answers for any group of sites."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return {
        "sites": F.count(F.lit(1)),
        "total_alarms": total("total_alarms"),
        "critical_alarms": total("critical_alarms"),
        "active_alarms": total("active_alarms"),
        "fault_score": total("fault_score"),
        "avg_mttr_min": F.round(F.avg("avg_mttr_min"), 1),
        "active_share": F.round(F.try_divide(F.sum("active_alarms"), F.sum("total_alarms")), 4),
    }


GOLD_METRICS = ("sites", "total_alarms", "critical_alarms", "active_alarms", "fault_score", "avg_mttr_min", "active_share")


def compile_metrics(gold: DataFrame, requests: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """Several reports at once: ``report``, all dimensions and all metrics that any request names.

    ``requests`` maps a report's name to its dimensions (none: one row for the network) and its
    metrics. Gold is read once: the dimension lists become grouping sets of one aggregate, combined
    in the map tasks. A report's rows have null in dimensions and metrics it did not ask for; two
    reports with the same dimensions share their aggregate.
    """
    known = _gold_expressions()
    for name, (dims, metrics) in requests.items():
        unknown = [m for m in metrics if m not in known] + [d for d in dims if d not in gold.columns]
        if unknown:
            raise KeyError(f"{name}: not in Gold or the catalogue: {', '.join(unknown)}")
    dims = list(dict.fromkeys(d for ds, _ in requests.values() for d in ds))
    metrics = [m for m in GOLD_METRICS if any(m in ms for _, ms in requests.values())]
    sets = list(dict.fromkeys(frozenset(ds) for ds, _ in requests.values()))
    aggs = [known[m].alias(m) for m in metrics]
    if dims:
        grouped = gold.groupingSets([[F.col(d) for d in dims if d in s] for s in sets], *dims)
        rows = grouped.agg(*aggs, F.grouping_id().alias("_set"))
    else:
        rows = gold.agg(*aggs, F.lit(0).alias("_set"))
    # Bit i of the grouping id, from the left, is set for a dimension that is not in the set.
    number = {s: sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in s) for s in sets}
    reports = [
        F.when(
            F.col("_set") == number[frozenset(ds)],
            F.struct(
                F.lit(name).alias("report"),
                *[F.col(d) for d in dims],
                *[(F.col(m) if m in ms else F.lit(None).cast(dict(rows.dtypes)[m])).alias(m) for m in metrics],
            ),
        )
        for name, (ds, ms) in requests.items()
    ]
    return rows.select(F.inline(F.filter(F.array(*reports), lambda r: r.isNotNull())))
