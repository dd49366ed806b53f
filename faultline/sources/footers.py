"""What Parquet footers know of a table, read by executors without reading its data.

``parquet_footers`` is a Python data source: one row per row group and column. Files are listed once
and dealt to tasks; each task opens only the ends of its files. Paths are anything that
``pyarrow.fs`` resolves (local folders, and stores named by a URI).
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Tasks need not have this package: what runs there is sent by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "parquet_footers"
FILES_PER_TASK = 64
SCHEMA = (
    "file string, file_bytes bigint, row_group int, rows bigint, column_name string, num_values bigint, null_count bigint, "
    "compressed_bytes bigint, min_number double, max_number double, min_text string, max_text string, has_range boolean"
)


@dataclass
class Files(InputPartition):
    paths: list[tuple[str, int]]


def _resolve(path: str):
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    return fs.FileSystem.from_uri("file://" + rest if scheme == "file" and not rest.startswith("//") else path)


def _numbers_and_texts(low, high) -> tuple:
    """A column's range as numbers or as texts; times as ISO texts, booleans as 0 and 1."""
    if isinstance(low, (bool, int, float)):
        return float(low), float(high), None, None
    if isinstance(low, (dt.date, dt.time)):
        return None, None, low.isoformat(), high.isoformat()
    if isinstance(low, str):
        return None, None, low, high
    return None, None, None, None


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, root = _resolve(self.path)
        top = store.get_file_info(root)
        if top.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [top] if top.is_file else store.get_file_info(fs.FileSelector(root, recursive=True))
        # Spark's own rule: names that start with _ or . are no data.
        data = sorted((f.path, f.size) for f in found if f.is_file and f.base_name[0] not in "_." and (top.is_file or f.extension == "parquet"))
        return [Files(data[i : i + FILES_PER_TASK]) for i in range(0, len(data), FILES_PER_TASK)] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        import pyarrow.parquet as pq

        store, _ = _resolve(self.path)
        for path, size in partition.paths:
            with store.open_input_file(path) as f:
                meta = pq.read_metadata(f)
            if not meta.num_row_groups:
                yield (path, size, None, 0, *[None] * 8, False)
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                for c in range(group.num_columns):
                    column = group.column(c)
                    stats = column.statistics
                    nulls = stats.null_count if stats is not None and stats.has_null_count else None
                    known = stats is not None and stats.has_min_max
                    low_high = _numbers_and_texts(stats.min, stats.max) if known else (None,) * 4
                    if not column.num_values:
                        nulls = 0
                    # A column of nulls alone has no range and needs none.
                    ranged = any(x is not None for x in low_high) or nulls == column.num_values
                    yield (
                        path, size, g, group.num_rows, column.path_in_schema, column.num_values, nulls,
                        column.total_compressed_size, *low_high, ranged,
                    )


class ParquetFooters(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def footers(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, row group and column of the Parquet files at ``path``; a file without row
    groups has one row with null group and column."""
    spark.dataSource.register(ParquetFooters)
    return spark.read.format(FORMAT).option("path", path).load()


def file_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row: files, their bytes and rows. Empty files count."""
    groups = footers(spark, path).select("file", "file_bytes", "row_group", "rows").distinct()
    files = groups.groupBy("file", "file_bytes").agg(F.sum("rows").alias("rows"))
    return files.agg(
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("file_bytes"), F.lit(0)).cast("bigint").alias("size_in_bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("num_rows"),
    )


def column_stats(spark: SparkSession, path: str) -> DataFrame:
    """``column_name, num_values, null_count, min_number, max_number, min_text, max_text`` per column.

    A figure that any row group does not record is null, not a figure of the others.
    """
    rows = footers(spark, path).where("column_name is not null")

    def if_all(value, recorded):
        return F.when(F.bool_and(recorded), value)

    of = [
        F.sum("num_values").cast("bigint").alias("num_values"),
        if_all(F.sum("null_count"), F.col("null_count").isNotNull()).cast("bigint").alias("null_count"),
        *[
            if_all(least_or_most(f"{end}_{kind}"), F.col("has_range")).alias(f"{end}_{kind}")
            for kind in ("number", "text")
            for end, least_or_most in (("min", F.min), ("max", F.max))
        ],
    ]
    return rows.groupBy("column_name").agg(*of)
