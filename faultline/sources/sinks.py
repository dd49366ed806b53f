"""Sinks and catalog helpers: Parquet feeds, published tables, schemas."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def write_feed(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Overwrite a Parquet feed at ``path`` (optionally partitioned). Returns the path.

    Write then read back: re-running the plan for a second action could
    give other values when it depends on the clock.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_counted(
    df: DataFrame, path: str, counts: dict[str, Column], partition_by: list[str] | None = None
) -> dict[str, object]:
    """``write_feed``, and figures of the rows it wrote, from the writing job itself.

    ``counts`` maps names to aggregates without DISTINCT. The plan runs once: no second pass counts
    or previews the rows, and the figures are those of the files.
    """
    seen = Observation()
    write_feed(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), path, partition_by)
    return dict(seen.get)


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def publish(
    df: DataFrame,
    table: str,
    partition_by: list[str] | None = None,
    bucket_by: tuple[int, str] | None = None,
    fmt: str = "parquet",
    path: str | None = None,
) -> DataFrame:
    """Create or replace ``table`` from ``df`` (CTAS; schema changes replace the table).

    ``partition_by`` (e.g. ``event_date`` on Silver) lets date filters prune
    files; ``bucket_by=(n, key)`` pre-shuffles on ``key`` so later joins and
    aggregations on it need no exchange. With ``path`` the table's files live
    there (an external table; give each version a folder of its own), else in the warehouse.
    The new version is written beside the old one and takes its name only once it is whole.
    A partitioned table always lies in a folder of its own, as its partitions keep their places
    when the table is renamed; the folder of the version before stays until its owner removes it.
    """
    spark = df.sparkSession
    if partition_by and not path:
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}-{uuid.uuid4().hex}"
    if bucket_by:
        # One writing task per bucket, whatever the last shuffle was: as many files as buckets.
        df = df.repartition(bucket_by[0], bucket_by[1])
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    if path:
        writer = writer.option("path", path)
    staged = f"{table}__next"
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": staged})
    writer.saveAsTable(staged)
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": table})
    spark.sql(f"ALTER TABLE {_quoted(staged)} RENAME TO {_quoted(table)}")
    return spark.table(table)


def try_sql(spark: SparkSession, statement: str, label: str) -> bool:
    """Run a statement; report and swallow failure (e.g. missing privilege)."""
    try:
        spark.sql(statement)
        return True
    except Exception as exc:  # noqa: BLE001 - the caller only needs success or not
        print(f"{label}: {type(exc).__name__}: {str(exc).splitlines()[0][:200]}")
        return False


def ensure_schema(spark: SparkSession, schema: str) -> bool:
    """Create ``schema`` if absent and make it current; False if that is not allowed."""
    if not spark.catalog.databaseExists(schema):
        if not try_sql(spark, f"CREATE SCHEMA IF NOT EXISTS `{schema}`", f"create schema {schema}"):
            return False
    spark.catalog.setCurrentDatabase(schema)
    return True


def list_tables(spark: SparkSession, schema: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema))
