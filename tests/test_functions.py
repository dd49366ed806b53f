"""Column helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions import (
    contains_ignore_case,
    elapsed_minutes,
    excerpt,
    hashed_uniform,
    severity_weight,
    zero_pad,
)


def test_zero_pad_matches_format_string(spark):
    df = spark.createDataFrame([(0,), (7,), (99999,), (123456,), (-3,)], "v long")
    got = df.select(zero_pad("v", 5, "SITE-").alias("a"), F.format_string("SITE-%05d", "v").alias("b")).collect()
    assert all(r.a == r.b for r in got)
    assert [r.a for r in got] == ["SITE-00000", "SITE-00007", "SITE-99999", "SITE-123456", "SITE--0003"]


def test_severity_weight(spark):
    df = spark.createDataFrame([("Critical",), ("Major",), ("Minor",), ("Warning",), ("critical",), (None,)], "s string")
    assert [r.w for r in df.select(severity_weight("s").alias("w")).collect()] == [10, 5, 2, 1, 1, 1]
    custom = df.select(severity_weight("s", {"Warning": 3}, default=0).alias("w")).collect()
    assert [r.w for r in custom] == [0, 0, 0, 3, 0, 0]


def test_elapsed_minutes_counts_whole_minutes(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-01 10:00:59' AS a, TIMESTAMP_NTZ'2024-01-01 10:01:01' AS b, "
        "TIMESTAMP_NTZ'2024-01-01 11:00:59' AS c"
    )
    r = df.select(elapsed_minutes("a", "b").alias("x"), elapsed_minutes("a", "c").alias("y")).collect()[0]
    assert (r.x, r.y) == (0, 60)


def test_hashed_uniform_range_and_streams(spark):
    df = spark.range(20000).select(hashed_uniform("id", 1).alias("u1"), hashed_uniform("id", 2).alias("u2"))
    r = df.agg(F.min("u1"), F.max("u1"), F.avg("u1"), F.corr("u1", "u2")).collect()[0]
    assert 0.0 <= r[0] and r[1] < 1.0
    assert abs(r[2] - 0.5) < 0.02 and abs(r[3]) < 0.05


def test_hashed_uniform_triples_are_independent(spark):
    """A 6 x 6 x 6 table of three consecutive streams is as even as chance makes it."""
    n, k = 43_200, 6
    cells = spark.range(n).select(*[F.floor(hashed_uniform("id", s) * k).alias(f"c{s}") for s in (17, 18, 19)])
    counts = [r["count"] for r in cells.groupBy("c17", "c18", "c19").count().collect()]
    expected = n / k**3
    chi2 = sum((c - expected) ** 2 / expected for c in counts)
    assert len(counts) == k**3 and 140 < chi2 < 310  # 215 degrees of freedom


def test_hashed_uniform_has_no_short_period(spark):
    far = 2**31 - 1
    df = spark.range(2000).select(hashed_uniform("id", 1).alias("a"), hashed_uniform(F.col("id") + far, 1).alias("b"))
    assert df.where("a = b").count() == 0


def test_excerpt_and_containment(spark):
    df = spark.createDataFrame([("SELECT 1;; \n", "select"), ("x" * 300, "X" * 5)], "t string, n string")
    got = df.select(excerpt("t", 160).alias("e"), contains_ignore_case("t", "n").alias("c")).collect()
    assert got[0].e == "SELECT 1" and got[0].c is True
    assert len(got[1].e) == 160 and got[1].c is True
