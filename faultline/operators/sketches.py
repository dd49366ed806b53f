"""Small tables that stand for large ones: quantiles and distinct counts per day, merged for any window.

* ``quantile_sketch``: counts per logarithmic bucket. A value's bucket is bounded by a relative
  error, so any quantile is found within that error of an exact one. Sketches merge by addition:
  a merge equals the sketch of all rows together, in any order.
* ``distinct_sketch``: HyperLogLog states (DataSketches), one per group, merged by
  ``hll_union_agg``.

Both are written once per day; reports over any window read them and not the log.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 0.01
# log2 of the registers: 12 gives a standard error of about 1.6 %.
LG_K = 12


def _base(accuracy: float) -> float:
    """Neighbouring bucket bounds differ by this factor."""
    if not 0 < accuracy < 1:
        raise ValueError("accuracy must lie between 0 and 1")
    return (1 + accuracy) / (1 - accuracy)


def quantile_sketch(df: DataFrame, by: list[str], value: str, accuracy: float = ACCURACY) -> DataFrame:
    """``by, bucket, n``: how many values lie in each bucket, per group.

    Bucket b holds values above base^(b-1) up to base^b; 0 has a bucket of its own (null). Null
    values do not count; a negative one is an error, as its bucket is not defined.
    """
    v = F.col(value).cast("double")
    checked = F.when(v < 0, F.raise_error(F.lit(f"{value} must not be negative"))).otherwise(v)
    bucket = F.when(checked > 0, F.ceil(F.ln(checked) / F.lit(log(_base(accuracy))))).cast("int")
    return df.where(v.isNotNull()).groupBy(*by, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge_quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """The sketch of coarser groups: counts of equal buckets add up."""
    return sketch.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def bucket_value(bucket: Column, accuracy: float = ACCURACY) -> Column:
    """The value that is within ``accuracy`` of every value of the bucket."""
    base = _base(accuracy)
    return F.when(bucket.isNull(), 0.0).otherwise(F.pow(F.lit(base), bucket.cast("double")) * (2 / (1 + base)))


def sketched_quantiles(sketch: DataFrame, by: list[str], percents: list[int], accuracy: float = ACCURACY, digits: int = 2) -> DataFrame:
    """``by, n, p<percent>`` (nearest rank) of a sketch that has one row per group and bucket.

    The window sees buckets, a few thousand at most per group, whatever was counted into them.
    """
    group = Window.partitionBy(*(by or [F.lit(0)]))
    ranked = sketch.select(
        "*",
        F.sum("n").over(group.orderBy(F.asc_nulls_first("bucket"))).alias("_upto"),
        F.sum("n").over(group).alias("_all"),
    )
    value = bucket_value(F.col("bucket"), accuracy)
    found = [F.round(F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * p, value)), digits).alias(f"p{p}") for p in percents]
    return ranked.groupBy(*by).agg(F.sum("n").cast("bigint").alias("n"), *found)


def distinct_sketch(df: DataFrame, by: list[str], value: Column | str, name: str = "users", lg_k: int = LG_K) -> DataFrame:
    """``by, n, <name>``: rows and the HyperLogLog state of ``value`` per group (nulls do not count)."""
    column = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(column, lg_k).alias(name))


def merge_distinct(sketch: DataFrame, by: list[str], name: str = "users") -> DataFrame:
    """``by, n, <name>`` of coarser groups."""
    return sketch.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg(name).alias(name))


def distinct_count(name: str = "users") -> Column:
    return F.hll_sketch_estimate(name)
