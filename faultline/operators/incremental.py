"""Silver kept up to date by days: a load rewrites the days it changes and no others.

Two tables are carried, both partitioned by ``event_date``: the first copy of every alarm seen so far
(``firsts``, raw columns) and Silver. A load may repeat alarms of any earlier day, bring late ones,
or bring a copy that is earlier than the first one known; the rules of ``build_silver`` hold over all
loads together. Ids of the load look up their first copies; days in which a first copy comes, goes or
changes are written anew by dynamic partition overwrite, from ``firsts`` of those days alone.

Silver is switched before ``firsts``. A load that fails in between is run again: ``firsts`` still says
what was known before, so the same days are found and written again with the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators.dedupe import dedupe_first
from faultline.operators.joins import bounded_broadcast
from faultline.operators.medallion import build_silver
from faultline.schemas import ALARM_COLUMNS, ALARMS
from faultline.sources.scratch import written

DAY = "event_date"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def create_tables(spark: SparkSession, sites: DataFrame, firsts: str, silver: str) -> None:
    """The two empty tables, if they are not there."""
    nothing = spark.createDataFrame([], ALARMS)
    for table, frame in ((firsts, nothing.select(*ALARM_COLUMNS)), (silver, build_silver(nothing, sites.limit(0)))):
        if not spark.catalog.tableExists(table):
            frame.write.format("parquet").partitionBy(DAY).saveAsTable(table)


def _switch(df: DataFrame, table: str, days: list[str | None]) -> None:
    """Replace the partitions ``days`` of ``table`` by the rows of ``df``; days without a row go."""
    spark = df.sparkSession
    df = written(df.select(*spark.table(table).columns), "refreshed-days")
    left = {r[DAY] for r in df.select(DAY).distinct().collect()}
    before = spark.conf.get(OVERWRITE_MODE)
    # The writer's option of this name does not reach insertInto; the session's own setting is put back.
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)
    have = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for day in days:
        name = "__HIVE_DEFAULT_PARTITION__" if day is None else day
        if day not in left and f"{DAY}={name}" in have:
            value = "NULL" if day is None else f"'{day}'"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({DAY}={value})")


def _in_days(df: DataFrame, days: list[str | None]) -> DataFrame:
    """A literal list, so that only the partitions of these days are read."""
    known = F.col(DAY).isin([d for d in days if d is not None])
    return df.where(known | F.col(DAY).isNull()) if None in days else df.where(known)


def load(batch: DataFrame, sites: DataFrame, firsts: str, silver: str) -> list[str | None]:
    """Take one load of raw alarms into the two tables; return the days that were written anew.

    An empty load, and one that only repeats what is known, writes nothing. Rows may repeat inside a
    load; ids may be null (a null id is an id, as in ``build_silver``). The list of days is the only
    thing that passes through the driver.
    """
    spark = batch.sparkSession
    new = written(dedupe_first(batch.select(*ALARM_COLUMNS), "alarm_id", ["raised_ts"]), "load-firsts")
    # Null ids meet null ids.
    ids = new.select(F.col("alarm_id").alias("id"))
    known = spark.table(firsts).select(*ALARM_COLUMNS)
    met = known.join(bounded_broadcast(ids), known["alarm_id"].eqNullSafe(ids["id"]), "left_semi")
    met = written(met, "load-known")
    best = written(dedupe_first(met.unionByName(new), "alarm_id", ["raised_ts"]), "load-best")
    # Copies are verbatim rows: what is not among the known first copies comes, what is no longer first goes.
    comes, goes = written(best.exceptAll(met), "load-comes"), written(met.exceptAll(best), "load-goes")
    days = [r[DAY] for r in comes.select(DAY).union(goes.select(DAY)).distinct().collect()]
    if not days:
        return []
    days = sorted(days, key=lambda d: (d is not None, d))
    gone = goes.select(F.col("alarm_id").alias("id"))
    stay = _in_days(known, days)
    stay = stay.join(bounded_broadcast(gone), stay["alarm_id"].eqNullSafe(gone["id"]), "left_anti")
    now = written(stay.unionByName(comes.select(*ALARM_COLUMNS)), "load-days")
    _switch(build_silver(now, sites), silver, days)
    _switch(now, firsts, days)
    return days
