"""Read-only profiling of a raw feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: ``null_<col>`` per column and ``total_rows``, in a single pass."""
    return df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols],
        F.count(F.lit(1)).alias("total_rows"),
    )


def duplicate_profile(df: DataFrame, key: str, exact: bool = True) -> DataFrame:
    """One row: rows, distinct keys and surplus rows (``rows - distinct``).

    The exact form is a two-level aggregate (group by key with map-side
    pre-aggregation, then count), so a key repeated across a third of the
    table collapses per map task. ``exact=False`` uses a HyperLogLog sketch
    (one pass, no shuffle of keys) for a quick look at very large feeds.
    """
    distinct = F.countDistinct(key) if exact else F.approx_count_distinct(key)
    return df.agg(
        F.count(F.lit(1)).alias("rows_total"),
        distinct.alias(f"distinct_{key}s"),
    ).withColumn("duplicate_rows", F.col("rows_total") - F.col(f"distinct_{key}s"))


def feed_profile(df: DataFrame, key: str, null_cols: list[str]) -> DataFrame:
    """Null counts, row count, distinct keys and surplus rows in one job.

    The reference profiles a feed in several passes; here one aggregate does
    it (Spark plans the distinct count as a second aggregation level over
    the key, with the other counts carried through it).
    """
    return df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_cols],
        F.count(F.lit(1)).alias("rows_total"),
        F.countDistinct(key).alias(f"distinct_{key}s"),
    ).withColumn("duplicate_rows", F.col("rows_total") - F.col(f"distinct_{key}s"))


def distribution(df: DataFrame, col: str, name: str = "alarms") -> DataFrame:
    """Rows per value, most frequent first; null is a group of its own."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc_nulls_first(col))


def range_profile(df: DataFrame, by: str, cols: dict[str, str], count_name: str = "rows", digits: int = 2) -> DataFrame:
    """Per group: row count and rounded min / max of each column.

    ``cols`` maps a column to the short label used in the output names
    (``min_<label>``, ``max_<label>``).
    """
    aggs = [F.count(F.lit(1)).alias(count_name)]
    for c, label in cols.items():
        aggs += [
            F.round(F.min(c), digits).alias(f"min_{label}"),
            F.round(F.max(c), digits).alias(f"max_{label}"),
        ]
    return df.groupBy(by).agg(*aggs).orderBy(F.desc(count_name), by)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Size of a frame as a one-row DataFrame (stays distributed until collected)."""
    return df.agg(F.count(F.lit(1)).alias(name))
