"""Contracts given as data, against plain Python."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from faultline.operators import contract as C

SCHEMA = "id string, at int, site string, n int, row int, hit string, key string, b0 int"
ROWS = [
    ("a", 1, "s1", 5), ("a", 2, "s1", 5), ("a", 2, "s9", None), ("b", 1, None, -1), ("c", 1, "s9", 3), ("c", 1, "s9", 3),
    (None, 3, "s1", 1), (None, 1, "s2", 1), ("d", None, "s2", 0), ("e", 1, "s1", 7),
]


def feed(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)


def rules(spark):
    sites = spark.createDataFrame([("s1",), ("s2",), ("s2",), (None,)], "name string")
    return [
        C.FirstCopy("first", "id", ("at",)),
        C.RowRule("positive", F.col("n") > 0),
        C.UniqueKey("unique", "id"),
        C.KnownKey("known", "site", sites, "name"),
        C.SetRule("some_rows", F.count(F.lit(1)) > 0),
        C.SetRule("mean_above_9", F.avg("n") > 9),
    ]


def slow(rows):
    """``(row, reasons)`` per row that breaks a rule."""
    ids = Counter(r[0] for r in rows)
    low = lambda x: (x is not None, x)
    first = {}
    for i, r in sorted(enumerate(rows), key=lambda x: [low(v) if v is not None else (False, 0) for v in (x[1][1], x[1][2], x[1][3])]):
        first.setdefault(r[0], i)
    out = []
    for i, r in enumerate(rows):
        reasons = [
            name
            for name, broken in (
                ("first", first[r[0]] != i), ("positive", not (r[3] is not None and r[3] > 0)),
                ("unique", r[0] is not None and ids[r[0]] > 1), ("known", r[2] is not None and r[2] not in ("s1", "s2")),
            )
            if broken
        ]
        if reasons:
            out.append((r, tuple(reasons)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bound", [0, 1 << 20])
def test_rejects_match_plain_python(spark, bound):
    got = C.rejects(feed(spark).repartition(3), rules(spark), bound)
    assert got.columns == [*feed(spark).columns, "reasons"]
    assert sorted([(tuple(r)[:4], tuple(r.reasons)) for r in got.collect()], key=str) == slow(ROWS)


def test_report_counts_what_rejects_names(spark):
    got = {r.rule: (r.failed_rows, r.total_rows, r.passed) for r in C.report(feed(spark), rules(spark)).collect()}
    want = Counter(x for _, reasons in slow(ROWS) for x in reasons)
    assert got == {n: (want[n], 10, want[n] == 0) for n in ("first", "positive", "unique", "known")} | {
        "some_rows": (0, 10, True), "mean_above_9": (0, 10, False)}


def test_empty_feed(spark):
    assert C.rejects(feed(spark, []), rules(spark)).count() == 0
    got = {r.rule: r.passed for r in C.report(feed(spark, []), rules(spark)).collect()}
    assert got == {"first": True, "positive": True, "unique": True, "known": True, "some_rows": False, "mean_above_9": False}


def test_only_keys_and_offending_rows_are_shuffled(spark, layers_small):
    """The feed's columns beyond the keys cross no exchange before the filter on offending rows."""
    import contextlib
    import io

    from faultline.operators.quality import silver_rejects

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        silver_rejects(layers_small.alarms(), layers_small.sites()).explain("simple")
    lines = buf.getvalue().splitlines()
    wide = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    assert len(wide) == 1
    # Children print below their parents: only rows whose key has copies reach the one exchange.
    assert any("BroadcastHashJoin" in x and "Inner" in x for x in lines[wide[0] :]) and "SortMergeJoin" not in buf.getvalue()


def test_two_orders_of_copies_are_refused(spark):
    with pytest.raises(ValueError):
        C.rejects(feed(spark), [C.FirstCopy("x", "id", ("at",)), C.FirstCopy("y", "site", ("at",))])
