"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.session import ensure_checkpoint_dir

# What separates words, as a regular-expression class and as characters.
BLANK_CLASS = r"\x20\x09-\x0D"
BLANKS = " \t\n\x0b\x0c\r"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the folder all executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages, and tasks that
    replace those of a lost executor, start from the files instead of from the inputs."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` in one, named ``_row``: names added beside it cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_array(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    core = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, f"[{BLANK_CLASS}]+"))


def without(text: Column, pattern: str) -> Column:
    """How many characters stay when matches of ``pattern`` go (faster than ``translate``)."""
    return F.length(F.regexp_replace(text, pattern, ""))


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("bigint")


def materialised(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column as the output of a generator. The optimizer does not copy an expression
    through a generator, so a column used many times is computed once per row."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def running(df: DataFrame, order: list[Column], sums: list[str], name: str) -> DataFrame:
    """Add ``pos`` (0, 1, ... in ``order``) and ``before_<c>`` (sum of ``c`` over earlier rows).

    No task sees all rows: a range shuffle deals contiguous pieces of the order, which are
    written with their piece number; positions inside a piece come from a window over that
    piece and the offsets from one row per piece (as many rows as shuffle partitions).
    ``order`` must name a total order, or tied rows be interchangeable.
    """
    n = partitions(df.sparkSession)
    dealt = cut(df.repartitionByRange(n, *order).withColumn("_piece", F.spark_partition_id()), name)
    totals = dealt.groupBy("_piece").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{c}") for c in sums]
    )
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_piece",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_o"),
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums],
    )
    inside = Window.partitionBy("_piece").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_r", F.row_number().over(inside) - 1)
    for c in sums:
        placed = placed.withColumn(f"_b_{c}", F.coalesce(F.sum(c).over(so_far), F.lit(0)))
    # One row per shuffle partition: a size that is set, not one that grows with the data.
    placed = placed.join(F.broadcast(offsets), "_piece")
    return placed.select(
        *df.columns,
        (F.col("_o") + F.col("_r")).cast("bigint").alias("pos"),
        *[(F.col(f"_o_{c}") + F.col(f"_b_{c}")).alias(f"before_{c}") for c in sums],
    )
