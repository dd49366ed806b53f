"""Synthetic site and alarm feeds with seeded defects.

Randomness comes from ``hashed_uniform(row index, stream)`` instead of
``rand()``, so a feed is reproducible, recomputes identically after an
executor loss, and can be rebuilt by any SQL engine. The generators take a
frame of row indexes (``spark.range(n)`` or an id column of a real table),
so they are plain projections: no shuffle, one task per input partition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.scalar import hashed_uniform, pick, zero_pad

# The eight metros (region, state, base latitude, base longitude).
METROS = [
    ("Dallas-FortWorth", "TX", 32.78, -96.80),
    ("Atlanta", "GA", 33.75, -84.39),
    ("LosAngeles", "CA", 34.05, -118.24),
    ("NewYork", "NY", 40.71, -74.01),
    ("Chicago", "IL", 41.88, -87.63),
    ("Houston", "TX", 29.76, -95.37),
    ("Miami", "FL", 25.76, -80.19),
    ("Seattle", "WA", 47.61, -122.33),
]
# Vendors, equipment, alarm types, severities, causes.
VENDORS = ["Ericsson", "Nokia", "Samsung"]
EQUIPMENT = ["eNodeB", "gNodeB", "Router", "Microwave", "Core"]
ALARM_TYPES = ["LinkDown", "HighTemperature", "PowerFault", "CellOutage", "PacketLoss", "LicenseExpiry"]
SEVERITIES = ["Critical", "Major", "Minor", "Warning"]
CAUSES = ["FiberCut", "PowerGridDip", "Overheating", "ConfigDrift", "HardwareFailure", "Congestion"]

# Stream ids: one independent uniform column per random draw.
S_VENDOR, S_EQUIP, S_LAT, S_LON, S_INSTALL = 1, 2, 3, 4, 5
S_SITE, S_SITE_NULL, S_NODE, S_TYPE, S_SEV_NULL, S_SEV = 11, 12, 13, 14, 15, 16
S_DAYS, S_HOURS, S_MINS, S_OPEN, S_CLEAR, S_ACK, S_CAUSE = 17, 18, 19, 20, 21, 22, 23

DEFAULT_AS_OF = dt.datetime(2024, 1, 31)
# One row in so many is repeated (5,000 of 200,000 at the default volume).
DUPLICATE_ONE_IN = 40


def _metro(idx: Column, field: int) -> Column:
    arr = F.array(*[F.lit(m[field]) for m in METROS])
    return F.element_at(arr, (idx % F.lit(len(METROS))).cast("int") + 1)


def generate_sites(ids: DataFrame, id_col: str = "id", as_of: dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    """One site per index: metro by index, jittered coordinates, random vendor and kit.

    Labels pad the index to four digits without truncating (``zero_pad``),
    unlike a plain 4-character left pad.
    """
    i = F.col(id_col).cast("bigint")
    u = lambda s: hashed_uniform(i, s)
    region, state = _metro(i, 0), _metro(i, 1)
    lat = F.round(_metro(i, 2) + (u(S_LAT) - F.lit(0.5)) * F.lit(0.6), 5)
    lon = F.round(_metro(i, 3) + (u(S_LON) - F.lit(0.5)) * F.lit(0.6), 5)
    install = F.timestamp_add(
        "DAY", -(u(S_INSTALL) * F.lit(2000)).cast("int"), F.lit(as_of).cast("timestamp_ntz")
    )
    return ids.select(
        zero_pad(i, 5, "SITE-").alias("site_id"),
        F.concat_ws("-", state, F.upper(F.substring(region, 1, 3)), zero_pad(i, 4)).alias("site_name"),
        region.alias("region"),
        state.alias("state"),
        pick(VENDORS, u(S_VENDOR)).alias("vendor"),
        pick(EQUIPMENT, u(S_EQUIP)).alias("equipment_type"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        install.alias("install_date"),
    )


def seed_nulls(df: DataFrame, col: str, fraction: float, idx: Column, stream: int) -> DataFrame:
    """Null ``col`` on about ``fraction`` of the rows (reproducibly, by index)."""
    return df.withColumn(col, F.when(hashed_uniform(idx, stream) < F.lit(fraction), F.lit(None)).otherwise(F.col(col)))


def generate_alarms(
    ids: DataFrame,
    n_sites: int,
    id_col: str = "id",
    as_of: dt.datetime = DEFAULT_AS_OF,
    null_site_rate: float = 0.02,
    null_severity_rate: float = 0.03,
    open_rate: float = 0.15,
    keep_index: bool = False,
    first_site: int = 0,
) -> DataFrame:
    """One alarm per index with a site key, type, severity, times and status.

    Alarms fall on the ``n_sites`` sites numbered from ``first_site``.
    Raised within the 60 days before ``as_of``; cleared 5..599 whole minutes
    later unless open; open alarms are ACTIVE or ACKNOWLEDGED at random.
    """
    i = F.col(id_col).cast("bigint")
    u = lambda s: hashed_uniform(i, s)
    site_n = (u(S_SITE) * F.lit(n_sites)).cast("bigint") + F.lit(first_site)
    raised = F.timestamp_add(
        "MINUTE",
        -((u(S_DAYS) * 60).cast("int") * 1440 + (u(S_HOURS) * 24).cast("int") * 60 + (u(S_MINS) * 60).cast("int")),
        F.lit(as_of).cast("timestamp_ntz"),
    )
    is_open = u(S_OPEN) < F.lit(open_rate)
    cleared = F.when(is_open, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.timestamp_add("MINUTE", (u(S_CLEAR) * 595 + 5).cast("int"), raised)
    )
    out = ids.select(
        i.alias("_idx"),
        zero_pad(i, 8, "ALM-").alias("alarm_id"),
        zero_pad(site_n, 5, "SITE-").alias("site_id"),
        zero_pad((u(S_NODE) * 50000).cast("int"), 5, "ENB-").alias("node_id"),
        pick(ALARM_TYPES, u(S_TYPE)).alias("alarm_type"),
        pick(SEVERITIES, u(S_SEV)).alias("severity"),
        raised.alias("raised_ts"),
        cleared.alias("cleared_ts"),
        F.when(~is_open, F.lit("CLEARED"))
        .when(u(S_ACK) < F.lit(0.5), F.lit("ACTIVE"))
        .otherwise(F.lit("ACKNOWLEDGED"))
        .alias("status"),
        pick(CAUSES, u(S_CAUSE)).alias("probable_cause"),
        F.date_format(raised, "yyyy-MM-dd").alias("event_date"),
    )
    out = seed_nulls(out, "site_id", null_site_rate, F.col("_idx"), S_SITE_NULL)
    out = seed_nulls(out, "severity", null_severity_rate, F.col("_idx"), S_SEV_NULL)
    return out if keep_index else out.drop("_idx")


def seed_duplicates(df: DataFrame, idx_col: str, one_in: int = DUPLICATE_ONE_IN) -> DataFrame:
    """Add a verbatim copy of each row whose index is divisible by ``one_in``, in the same scan."""
    copies = F.when(F.col(idx_col) % F.lit(one_in) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")


def generate_alarm_feed(
    ids: DataFrame,
    n_sites: int,
    one_in: int = DUPLICATE_ONE_IN,
    id_col: str = "id",
    as_of: dt.datetime = DEFAULT_AS_OF,
    first_site: int = 0,
) -> DataFrame:
    """Alarms plus a verbatim copy of one alarm in ``one_in``."""
    with_idx = generate_alarms(ids, n_sites, id_col, as_of, keep_index=True, first_site=first_site)
    return seed_duplicates(with_idx, "_idx", one_in).drop("_idx")
