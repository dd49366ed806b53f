"""Figures from Parquet footers, against DuckDB's reading of the same footers."""

from __future__ import annotations

import os
import tempfile

import duckdb
import pytest
from helpers import SF_SMALL
from pyspark.sql import functions as F

from faultline.sources import footers as FT


def test_file_stats(spark):
    path = f"{SF_SMALL}/events.parquet"
    assert tuple(FT.file_stats(spark, path).first()) == (1, os.path.getsize(path), 1000)
    # Files in sub-folders count; marker and hidden files do not.
    out = os.path.join(tempfile.mkdtemp(prefix="stats-"), "t")
    spark.read.parquet(path).write.partitionBy("event_type").parquet(out)
    parts = [os.path.join(r, f) for r, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")]
    assert tuple(FT.file_stats(spark, "file:" + out).first()) == (len(parts), sum(map(os.path.getsize, parts)), 1000)


def test_every_row_group_and_column_is_read(spark):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tempfile.mkdtemp(prefix="groups-")
    table = pa.table({"a": list(range(100)), "b": [None] * 100, "c": [f"x{i:03}" for i in range(100)], "d": [True, None] * 50,
                      "e": pa.array([[i] for i in range(100)])}, pa.schema([("a", pa.int64()), ("b", pa.string()), ("c", pa.string()),
                      ("d", pa.bool_()), ("e", pa.list_(pa.int32()))]))
    pq.write_table(table, f"{folder}/x.parquet", row_group_size=30)
    pq.write_table(table.slice(0, 0), f"{folder}/empty.parquet")
    got = FT.footers(spark, folder)
    want = duckdb.sql(f"SELECT row_group_id, path_in_schema, num_values, stats_null_count, total_compressed_size FROM parquet_metadata('{folder}/x.parquet')")
    columns = ("row_group", F.regexp_replace("column_name", r"\.", ", "), "num_values", "null_count", "compressed_bytes")
    assert sorted(map(tuple, got.where("file like '%x.parquet'").select(*columns).collect())) == sorted(want.fetchall())
    assert FT.file_stats(spark, folder).first().num_files == 2
    stats = {r.column_name: tuple(r)[1:] for r in FT.column_stats(spark, folder).collect()}
    assert stats["a"] == (100, 0, 0.0, 99.0, None, None) and stats["b"] == (100, 100, None, None, None, None)
    assert stats["c"] == (100, 0, None, None, "x000", "x099") and stats["d"] == (100, 50, 1.0, 1.0, None, None)


def test_figures_that_a_row_group_lacks_are_null(spark):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tempfile.mkdtemp(prefix="nostats-")
    pq.write_table(pa.table({"a": [1, 2]}), f"{folder}/x.parquet")
    pq.write_table(pa.table({"a": [9, 10]}), f"{folder}/y.parquet", write_statistics=False)
    assert tuple(FT.column_stats(spark, folder).first()) == ("a", 4, None, None, None, None, None)


def test_missing_and_empty_folders(spark):
    assert tuple(FT.file_stats(spark, tempfile.mkdtemp(prefix="none-")).first()) == (0, 0, 0)
    with pytest.raises(Exception, match="no/such/folder"):
        FT.file_stats(spark, "/no/such/folder").collect()
