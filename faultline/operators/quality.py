"""Row expectations with reasons, and the layer invariants.

``expect`` evaluates every rule in one projection: each row gets the array
of names of the rules it breaks, so kept rows, quarantined rows and per-rule
counts all come from the same pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from faultline.operators import contract
from faultline.operators.contract import REASONS
from faultline.operators.joins import DEFAULT_BROADCAST_MAX_BYTES
from faultline.operators.medallion import build_silver
from faultline.schemas import ALARM_COLUMNS
from faultline.sources.sinks import write_feed

# The rule names of the Silver contract.
SILVER_RULES = ("first_copy_of_alarm", "site_id_not_null", "severity_not_null", "site_known")


def violated(predicate: Column) -> Column:
    """A rule fails when its predicate is false or null."""
    return ~F.coalesce(predicate, F.lit(False))


def with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``reasons``: names of the rules a row breaks (empty when it passes)."""
    flags = [F.when(violated(pred), F.lit(name)) for name, pred in rules.items()]
    return df.withColumn(REASONS, F.filter(F.array(*flags), lambda x: x.isNotNull()))


def expect(df: DataFrame, rules: dict[str, Column], on_violation: str = "drop") -> tuple[DataFrame, DataFrame]:
    """Apply row expectations.

    Returns ``(kept, rejected)``. ``on_violation``: ``drop`` keeps passing rows
    only; ``warn`` keeps every row (rejects are still reported); ``fail``
    raises if any row breaks a rule (this runs one counting job).
    """
    tagged = with_reasons(df, rules)
    passing = F.size(F.col(REASONS)) == 0
    rejected = tagged.where(~passing)
    if on_violation == "drop":
        kept = tagged.where(passing).drop(REASONS)
    elif on_violation == "warn":
        kept = tagged.drop(REASONS)
    elif on_violation == "fail":
        if not rejected.limit(1).isEmpty():
            raise ValueError("expectation failed: " + ", ".join(rules))
        kept = tagged.drop(REASONS)
    else:
        raise ValueError(f"unknown on_violation {on_violation!r}")
    return kept, rejected


def expectation_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``(rule, failed_rows, total_rows)`` per rule, computed in one aggregate."""
    totals = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(violated(pred)).alias(f"r{i}") for i, pred in enumerate(rules.values())],
    )
    stack = ", ".join(f"'{name}', r{i}" for i, name in enumerate(rules))
    return totals.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, failed_rows)", "total_rows")


def silver_rules(sites: DataFrame) -> list[contract.Rule]:
    """The Silver contract as data."""
    first, has_site, has_severity, known = SILVER_RULES
    return [
        contract.FirstCopy(first, "alarm_id", ("raised_ts",)),
        contract.RowRule(has_site, F.col("site_id").isNotNull()),
        contract.RowRule(has_severity, F.col("severity").isNotNull()),
        contract.KnownKey(known, "site_id", sites, "site_id"),
    ]


def feed_rules(sites: DataFrame) -> list[contract.Rule]:
    """The Silver contract and what is asked of the feed as a whole."""
    return [
        *silver_rules(sites),
        contract.UniqueKey("alarm_id_unique", "alarm_id"),
        contract.SetRule("feed_not_empty", F.count(F.lit(1)) > 0),
    ]


def silver_rejects(
    alarms: DataFrame,
    sites: DataFrame,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Raw rows kept out of Silver, each with the list of broken rules.

    A row reaches Silver exactly when it passes every rule: it is the first
    copy of its ``alarm_id`` (by ``raised_ts``), its ``site_id`` and
    ``severity`` are set and its site exists. Only the ids that occur more than once and the
    offending rows are shuffled.
    """
    return contract.rejects(alarms.select(*ALARM_COLUMNS), silver_rules(sites), max_broadcast_bytes)


def silver_expectation_counts(alarms: DataFrame, sites: DataFrame) -> DataFrame:
    """``(rule, failed_rows, total_rows)`` of the Silver rules, from counts alone.

    Surplus copies are rows less distinct ``alarm_id``s (nulls are one more); unknown sites come
    from the count per ``site_id``, so only those leave the map tasks.
    """
    rows = F.count(F.lit(1))
    has_null_id = F.coalesce(F.max(F.col("alarm_id").isNull().cast("bigint")), F.lit(0))
    failed = [
        rows - F.countDistinct("alarm_id") - has_null_id,
        F.count_if(F.col("site_id").isNull()),
        F.count_if(F.col("severity").isNull()),
    ]
    own = alarms.agg(rows.alias("total_rows"), *[c.alias(f"r{i}") for i, c in enumerate(failed)])
    per_site = alarms.where(F.col("site_id").isNotNull()).groupBy("site_id").agg(rows.alias("n"))
    unknown = per_site.join(sites.select("site_id"), "site_id", "left_anti")
    unknown = unknown.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("r3"))
    stack = ", ".join(f"'{name}', r{i}" for i, name in enumerate(SILVER_RULES))
    counts = _one_row_union([own, unknown])
    return counts.selectExpr(f"stack({len(SILVER_RULES)}, {stack}) AS (rule, failed_rows)", "total_rows")


def _one_row_union(frames: list[DataFrame]) -> DataFrame:
    """Combine one-row aggregates from different sources into one row.

    The aggregates are stacked with ``unionByName`` (missing columns null)
    and folded with ``max``: each column is non-null in exactly one input.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def validate_silver(raw: DataFrame, silver: DataFrame) -> DataFrame:
    """One row: raw rows, Silver rows, null keys left, duplicate ids left."""
    raw_stats = raw.agg(F.count(F.lit(1)).alias("raw_alarm_rows"))
    silver_stats = silver.agg(
        F.count(F.lit(1)).alias("silver_rows"),
        F.count_if(F.col("site_id").isNull()).alias("null_site_id"),
        F.count_if(F.col("severity").isNull()).alias("null_severity"),
        (F.count(F.lit(1)) - F.countDistinct("alarm_id")).alias("duplicate_alarm_ids"),
    )
    return _one_row_union([raw_stats, silver_stats]).select(
        "raw_alarm_rows", "silver_rows", "null_site_id", "null_severity", "duplicate_alarm_ids"
    )


def written_silver(alarms: DataFrame, sites: DataFrame, path: str) -> dict[str, int]:
    """Build Silver, write it to ``path`` and return the figures of ``validate_silver``, all from the
    one job that writes: raw rows are counted where the feed is scanned, Silver's where it is written.

    Distinct ids cannot be observed; ``duplicate_alarm_ids`` counts the rows numbered above one within
    their id. Silver is dealt by id already, so the numbering adds no shuffle where its site join
    broadcasts.
    """
    raw = Observation()
    silver = build_silver(alarms.observe(raw, F.count(F.lit(1)).alias("n")), sites)
    own = Window.partitionBy("alarm_id").orderBy("alarm_id")
    again = silver.withColumn("_again", (F.row_number().over(own) > 1).cast("bigint"))
    seen = Observation()
    counted = again.observe(
        seen,
        F.count(F.lit(1)).alias("silver_rows"),
        F.count_if(F.col("site_id").isNull()).alias("null_site_id"),
        F.count_if(F.col("severity").isNull()).alias("null_severity"),
        F.coalesce(F.sum("_again"), F.lit(0)).alias("duplicate_alarm_ids"),
    )
    write_feed(counted.drop("_again"), path)
    return {"raw_alarm_rows": raw.get["n"], **seen.get}


def validate_sites(sites: DataFrame) -> DataFrame:
    """One row: site rows, distinct ``site_id``s, surplus rows, rows without coordinates.

    Silver joins alarms to sites on ``site_id`` and Gold groups by the site
    attributes, both on the premise that ``site_id`` is unique in the
    dimension; ``duplicate_site_ids`` must be 0 for that to hold.
    """
    return sites.agg(
        F.count(F.lit(1)).alias("site_rows"),
        F.countDistinct("site_id").alias("distinct_sites"),
        (F.count(F.lit(1)) - F.countDistinct("site_id")).alias("duplicate_site_ids"),
        F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("null_coords"),
    )


def validate_gold(gold: DataFrame) -> DataFrame:
    """One row: site rows, distinct sites, rows without coordinates."""
    return gold.agg(
        F.count(F.lit(1)).alias("site_rows"),
        F.countDistinct("site_id").alias("distinct_sites"),
        F.count_if(F.col("latitude").isNull()).alias("null_coords"),
    )

