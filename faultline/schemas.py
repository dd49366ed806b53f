"""Declared schemas of every layer, checked on read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STR = T.StringType()
DBL = T.DoubleType()
LONG = T.LongType()
BOOL = T.BooleanType()
TS = T.TimestampNTZType()

SITES = T.StructType(
    [
        T.StructField("site_id", STR),
        T.StructField("site_name", STR),
        T.StructField("region", STR),
        T.StructField("state", STR),
        T.StructField("vendor", STR),
        T.StructField("equipment_type", STR),
        T.StructField("latitude", DBL),
        T.StructField("longitude", DBL),
        T.StructField("install_date", TS),
    ]
)

ALARMS = T.StructType(
    [
        T.StructField("alarm_id", STR),
        T.StructField("site_id", STR),
        T.StructField("node_id", STR),
        T.StructField("alarm_type", STR),
        T.StructField("severity", STR),
        T.StructField("raised_ts", TS),
        T.StructField("cleared_ts", TS),
        T.StructField("status", STR),
        T.StructField("probable_cause", STR),
        T.StructField("event_date", STR),
    ]
)

SITE_ATTRIBUTES = [f.name for f in SITES.fields if f.name != "site_id"]
ALARM_COLUMNS = [f.name for f in ALARMS.fields]

SILVER = T.StructType(
    list(ALARMS.fields)
    + [f for f in SITES.fields if f.name != "site_id"]
    + [T.StructField("time_to_clear_min", LONG), T.StructField("is_active", BOOL)]
)

# Site attributes Gold carries; install_date is not one of them.
GOLD_ATTRIBUTES = ["site_name", "region", "state", "vendor", "equipment_type", "latitude", "longitude"]

GOLD = T.StructType(
    [T.StructField("site_id", STR)]
    + [f for f in SITES.fields if f.name in GOLD_ATTRIBUTES]
    + [
        T.StructField("total_alarms", LONG),
        T.StructField("critical_alarms", LONG),
        T.StructField("active_alarms", LONG),
        T.StructField("avg_mttr_min", DBL),
        T.StructField("fault_score", LONG),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("user_identity", T.StructType([T.StructField("email", STR)])),
        T.StructField("service_name", STR),
        T.StructField("action_name", STR),
        T.StructField("request_params", T.MapType(STR, STR)),
        T.StructField("event_time", TS),
    ]
)

GRANTS = T.StructType(
    [
        T.StructField("grantee", STR),
        T.StructField("privilege_type", STR),
        T.StructField("is_grantable", STR),
        T.StructField("table_catalog", STR),
        T.StructField("table_schema", STR),
        T.StructField("table_name", STR),
    ]
)

LINEAGE = T.StructType(
    [
        T.StructField("source_table_full_name", STR),
        T.StructField("target_table_full_name", STR),
        T.StructField("event_time", TS),
    ]
)

TRUTHS = T.StructType([T.StructField("case_id", LONG), T.StructField("truth", STR)])

ANSWERS = T.StructType(
    [
        T.StructField("case_id", LONG),
        T.StructField("round", LONG),
        T.StructField("answer_text", STR),
        T.StructField("first_row_text", STR),
    ]
)


class SchemaMismatch(ValueError):
    pass


def check_schema(df: DataFrame, schema: T.StructType, name: str = "frame") -> DataFrame:
    """Fail fast when ``df`` lacks a declared column or carries it with another type.

    Extra columns are allowed; nullability is not compared (Parquet footers
    mark every column nullable).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in schema.fields:
        if field.name not in have:
            problems.append(f"missing {field.name}")
        elif have[field.name] != field.dataType and not _compatible(have[field.name], field.dataType):
            problems.append(f"{field.name}: {have[field.name].simpleString()} != {field.dataType.simpleString()}")
    if problems:
        raise SchemaMismatch(f"{name}: " + "; ".join(problems))
    return df


_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def _compatible(have: T.DataType, want: T.DataType) -> bool:
    """Zoned and zone-less timestamps are interchangeable (read in a UTC session)."""
    return isinstance(have, _TIMESTAMPS) and isinstance(want, _TIMESTAMPS)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in declared order, casting where needed."""
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
