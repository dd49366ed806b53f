"""Physical-plan properties the library relies on at scale."""

from __future__ import annotations

import contextlib
import io
import os
import tempfile

import pytest
from helpers import SF_SMALL

from faultline.plans.queries import queries
from faultline.operators import metrics as M
from faultline.operators.medallion import build_gold, build_silver
from faultline.operators.quality import silver_rejects, validate_silver
from faultline.plans.pipeline import Layers, publish_layer
from faultline.sources.sinks import write_feed

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "PythonUDF",
)


def plan_of(df, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cross_join_or_python_in_any_query(spark, name):
    plan = plan_of(queries()[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"


def test_silver_pre_reduces_before_its_shuffle(layers_small):
    plan = plan_of(layers_small.silver())
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any(line.rstrip().endswith("Partial") for line in limits)
    assert any(line.rstrip().endswith("Final") for line in limits)
    # children print below parents: the partial limit runs before the alarm_id exchange
    exchange = plan.index("Exchange hashpartitioning(alarm_id")
    partial = max(i for i, line in enumerate(plan.splitlines()) if "WindowGroupLimit" in line and "Partial" in line)
    assert partial > plan[:exchange].count("\n")
    # the site dimension is broadcast, never the alarms
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan


def test_gold_is_a_hash_aggregate(layers_small):
    plan = plan_of(build_gold(layers_small.silver()))
    # The only sort-based aggregate is Gold's second step, over about one row per site.
    assert all("partial_max(" in x or "max(" in x for x in plan.splitlines() if "SortAggregate(" in x)
    assert plan.count("HashAggregate") >= 2  # partial + final


def test_published_silver_prunes_and_pushes(spark, layers_small):
    folder = tempfile.mkdtemp(prefix="silver-")
    silver = spark.read.parquet(write_feed(layers_small.silver(), os.path.join(folder, "silver")))
    plan = plan_of(M.mttr_by(silver, "vendor"))
    assert "ReadSchema: struct<vendor:string,time_to_clear_min:bigint>" in plan
    assert "PushedFilters: [IsNotNull(time_to_clear_min)]" in plan


def test_bucketed_silver_needs_no_exchange_for_alarm_id(spark, layers_small):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    silver = publish_layer(Layers(spark, SF_SMALL).silver(), "silver_bucketed_test", bucket_by=(n, "alarm_id"))
    plan = plan_of(validate_silver(layers_small.alarms(), silver))
    assert "Bucketed: true" in plan
    assert "hashpartitioning(alarm_id" not in plan


@pytest.mark.parametrize("bound", [0, 64 * 1024 * 1024])
def test_published_silver_has_one_file_per_bucket(spark, layers_small, bound):
    L = layers_small
    silver = build_silver(L.alarms(), L.sites(), max_broadcast_bytes=bound)
    table = publish_layer(silver, f"silver_files_{bound}", bucket_by=(8, "alarm_id"))
    assert len(table.inputFiles()) == 8
    # a second version replaces the first, whose files go
    again = publish_layer(silver, f"silver_files_{bound}", bucket_by=(8, "alarm_id"))
    assert len(again.inputFiles()) == 8 and not set(again.inputFiles()) & set(table.inputFiles())
    assert again.count() == L.silver().count()


def test_rejects_exchange_no_row_id(layers_small):
    plan = plan_of(silver_rejects(layers_small.alarms(), layers_small.sites()))
    assert "monotonically_increasing_id" not in plan and "SortMergeJoin" not in plan


def test_worst_site_join_broadcasts_one_row(layers_small):
    plan = plan_of(M.worst_site_causes(layers_small.silver(), layers_small.gold()))
    assert "TakeOrderedAndProject(limit=1" in plan
    assert "BroadcastExchange" in plan


def test_date_partitioned_silver_prunes_partitions(spark, layers_small):
    from pyspark.sql import functions as F

    silver = publish_layer(Layers(spark, SF_SMALL).silver(), "silver_by_date_test", partition_by=["event_date"])
    recent = silver.where(F.col("event_date") >= "2024-01-25")
    plan = plan_of(M.daily_critical_trend(recent))
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-25" in plan
    assert recent.count() == layers_small.silver().where(F.col("event_date") >= "2024-01-25").count()
