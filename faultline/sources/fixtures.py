"""Reshape the driver's tables into the feeds the library consumes.

Every feed is derived row by row from a driver table with integer
arithmetic, so its size grows with the table and any SQL engine can build
the same rows (see FIXTURES.md for the definitions).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.scalar import zero_pad
from faultline.operators.joins import bounded_broadcast
from faultline.schemas import ALARMS, SITES, conform
from faultline.sources.tables import read_table

# Fixed values of the fixture definitions.
FIXTURE_SEVERITIES = ["Critical", "Major", "Minor", "Warning"]
INSTALL_EPOCH = dt.datetime(2020, 1, 1)
AUDIT_AS_OF = dt.datetime(2024, 1, 30, 23, 57, 0)
AUDIT_TABLE = "main.net.t1"
EMAIL_DOMAIN = "example.com"


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def sites_from_tables(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """``sites`` from ``customer ⨝ nation ⨝ region`` (one site per customer)."""
    geo = nation.select("n_nationkey", "n_name", "n_regionkey").join(
        bounded_broadcast(region.select("r_regionkey", "r_name")),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment").join(
        bounded_broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    out = c.select(
        zero_pad(key, 5, "SITE-").alias("site_id"),
        F.concat_ws(
            "-",
            F.col("n_name"),
            F.upper(F.substring(F.col("r_name"), 1, 3)),
            F.lpad(key.cast("string"), 4, "0"),
        ).alias("site_name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("state"),
        F.col("c_mktsegment").alias("vendor"),
        F.concat(F.lit("EQ"), (key % 5).cast("string")).alias("equipment_type"),
        ((F.lit(25) + F.col("n_nationkey")).cast("double") + (key % 100).cast("double") / 100).alias("latitude"),
        (-(F.lit(70) + F.col("r_regionkey") * 10).cast("double") - (key % 97).cast("double") / 100).alias(
            "longitude"
        ),
        F.timestamp_add("DAY", (key % 2000).cast("int"), F.lit(INSTALL_EPOCH).cast("timestamp_ntz")).alias(
            "install_date"
        ),
    )
    return conform(out, SITES)


def alarms_from_events(events: DataFrame) -> DataFrame:
    """``alarms`` from ``events`` plus verbatim copies of every 40th event."""
    eid = F.col("event_id")
    k = F.col("_k")
    sev = F.element_at(F.array(*[F.lit(s) for s in FIXTURE_SEVERITIES]), k % 4 + 1)
    # ``_k`` is parsed once in its own projection; Catalyst keeps it there
    # rather than inlining the JSON parse into both columns that read it.
    parsed = events.select("event_id", "ts", "user_id", "event_type", "value", _k(F.col("props")).alias("_k"))
    # Copies come from the same scan, beside their original.
    copies = F.when(eid % 40 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    parsed = parsed.select("*", F.explode(copies).alias("_copy"))
    base = parsed.select(
        zero_pad(eid, 8, "ALM-").alias("alarm_id"),
        F.when(eid % 50 == 0, F.lit(None).cast("string"))
        .otherwise(zero_pad(F.col("user_id"), 5, "SITE-"))
        .alias("site_id"),
        zero_pad(eid % 50000, 5, "ENB-").alias("node_id"),
        F.col("event_type").alias("alarm_type"),
        F.when(eid % 33 == 0, F.lit(None).cast("string")).otherwise(sev).alias("severity"),
        F.col("ts").alias("raised_ts"),
        F.when(eid % 7 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.timestamp_add("MINUTE", F.floor(F.col("value") * 60), F.col("ts")))
        .alias("cleared_ts"),
        F.when(eid % 7 != 0, F.lit("CLEARED"))
        .when(eid % 2 == 0, F.lit("ACTIVE"))
        .otherwise(F.lit("ACKNOWLEDGED"))
        .alias("status"),
        F.concat(F.lit("C"), (k % 6).cast("string")).alias("probable_cause"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("event_date"),
    )
    return conform(base, ALARMS)


def audit_from_events(events: DataFrame) -> DataFrame:
    """Access-audit rows: one per event."""
    eid = F.col("event_id")
    etype = F.col("event_type")
    return events.select(
        F.struct(F.format_string(f"user%d@{EMAIL_DOMAIN}", F.col("user_id")).alias("email")).alias("user_identity"),
        F.when(eid % 5 == 0, F.lit("jobs")).otherwise(F.lit("unityCatalog")).alias("service_name"),
        F.when(etype == "view", F.lit("getTable"))
        .when(etype == "click", F.lit("generateTemporaryTableCredential"))
        .otherwise(etype)
        .alias("action_name"),
        F.create_map(F.lit("full_name_arg"), F.format_string("main.net.t%d", eid % 3)).alias("request_params"),
        F.col("ts").alias("event_time"),
    )


def grants_from_customers(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    return customer.select(
        F.format_string(f"user%d@{EMAIL_DOMAIN}", key).alias("grantee"),
        F.when(key % 2 == 0, F.lit("SELECT")).otherwise(F.lit("MODIFY")).alias("privilege_type"),
        F.when(key % 4 == 0, F.lit("YES")).otherwise(F.lit("NO")).alias("is_grantable"),
        F.lit("main").alias("table_catalog"),
        F.lit("net").alias("table_schema"),
        F.format_string("t%d", key % 3).alias("table_name"),
    )


def lineage_from_orders(orders: DataFrame) -> DataFrame:
    okey = F.col("o_orderkey")
    return orders.select(
        F.when(okey % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.format_string("main.net.s%d", F.col("o_custkey") % 20))
        .alias("source_table_full_name"),
        F.format_string("main.net.t%d", okey % 3).alias("target_table_full_name"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("event_time"),
    )


def table_graph_from_orders(orders: DataFrame) -> DataFrame:
    """Lineage among many tables: customers' tables feed those of their orders, two orders to a table."""
    return orders.select(
        F.format_string("main.net.n%d", F.col("o_custkey")).alias("source_table_full_name"),
        F.format_string("main.net.n%d", F.floor(F.col("o_orderkey") / 2)).alias("target_table_full_name"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("event_time"),
    )


def truths_from_customers(customer: DataFrame) -> DataFrame:
    """Ground truth per graded case: the customer name."""
    return customer.select(F.col("c_custkey").cast("bigint").alias("case_id"), F.col("c_name").alias("truth"))


def answers_from_customers(customer: DataFrame) -> DataFrame:
    """Two answer rounds per case; round 1 misses every 3rd case, round 2 every 6th.

    Every 5th answer that does not miss names the truth in its first result row only.
    """
    key = F.col("c_custkey")

    def one_round(rnd: int, miss_every: int) -> DataFrame:
        return customer.select(
            key.cast("bigint").alias("case_id"),
            F.lit(rnd).cast("bigint").alias("round"),
            F.when(key % miss_every == 0, F.lit("unknown"))
            .when(key % 5 == 0, F.lit("The answer is in the table;"))
            .otherwise(F.concat(F.lit("The answer is "), F.lower(F.col("c_name"))))
            .alias("answer_text"),
            F.when((key % miss_every != 0) & (key % 5 == 0), F.concat(F.upper(F.col("c_name")), F.lit(" 1")))
            .alias("first_row_text"),
        )

    return one_round(1, 3).unionByName(one_round(2, 6))


class Feeds:
    """Lazily built fixture feeds of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._sites: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def sites(self) -> DataFrame:
        if self._sites is None:
            self._sites = sites_from_tables(self.table("customer"), self.table("nation"), self.table("region"))
        return self._sites

    def alarms(self) -> DataFrame:
        return alarms_from_events(self.table("events"))

    def audit(self) -> DataFrame:
        return audit_from_events(self.table("events"))

    def grants(self) -> DataFrame:
        return grants_from_customers(self.table("customer"))

    def lineage(self) -> DataFrame:
        return lineage_from_orders(self.table("orders"))

    def table_graph(self) -> DataFrame:
        return table_graph_from_orders(self.table("orders"))

    def truths(self) -> DataFrame:
        return truths_from_customers(self.table("customer"))

    def answers(self) -> DataFrame:
        return answers_from_customers(self.table("customer"))
