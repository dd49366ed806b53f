"""Metric catalogue."""

from __future__ import annotations

import __spark_entry__ as E
from faultline.plans.catalog import LAYER_GUIDANCE, METRICS, metric, resolve


def test_every_metric_points_at_a_registered_query():
    registered = set(E.queries())
    for m in METRICS.values():
        assert m.layer in LAYER_GUIDANCE
        assert m.query is None or m.query in registered, m.name


def test_ranking_synonyms_resolve_to_fault_score():
    assert [m.name for m in resolve("worst")] == ["fault_score"]
    assert [m.name for m in resolve("Unhealthiest")] == ["fault_score"]
    assert metric("vendor_mttr").layer == "silver"
    assert resolve("no such metric") == []
