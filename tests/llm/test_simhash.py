from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from faultline.llm import simhash
from faultline.llm.components import components


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, bits):
    label = list(range(len(fps)))
    for _ in fps:
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= bits:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def test_matches_brute_force_on_edge_rows(edge_docs, edge_rows):
    got = simhash.near_duplicates(edge_docs).collect()
    fps = [slow_fingerprint(t) for _, t, _, _ in edge_rows]
    label = slow_components(fps, 4)
    low = {}
    for (i, *_), c in zip(edge_rows, label):
        low[c] = min(filter(lambda x: x is not None, [low.get(c), i]), default=None)
    want = sorted((str(r[0]), f"{f:016x}", str(low[c])) for r, f, c in zip(edge_rows, fps, label))
    assert sorted((str(g["doc_id"]), g["fingerprint"], str(g["component_id"])) for g in got) == want


def test_one_document_of_each_component_stays(edge_docs, edge_rows):
    kept = simhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    fps = [slow_fingerprint(t) for _, t, _, _ in edge_rows]
    assert kept.count() == len(set(slow_components(fps, 4)))


def test_components_that_share_an_id_keep_one_row_each(make):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a, "en", "s"), (2, a, "en", "s"), (1, b, "en", "s"), (3, b, "en", "s"), (None, b, "en", "s")]
    kept = simhash.drop_near_duplicates(make(rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, a), (1, b)]


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("hot_key", [4, 64, 10_000])
def test_hot_keys_lose_no_link(spark, hot_key):
    rng = np.random.default_rng(5)
    fps = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))
           for c in rng.integers(0, 1 << 62, 4) for _ in range(60)}
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint").repartition(3)
    links = simhash.fingerprint_links(df, 4, hot_key=hot_key, blocks=2)
    assert links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 4).count() == 0
    root = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
    label = slow_components(fps, 4)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    groups = {}
    for s, c in zip(signed, label):
        groups.setdefault(c, set()).add(root.get(s, s))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_components_of_chain_star_and_pair(spark):
    links = [(i, i + 1) for i in range(100)] + [(1000, 500 + i) for i in range(50)] + [(9000, 8000), (8000, 9000), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    assert {got[i] for i in range(101)} == {0} and {got[i] for i in [1000, *range(500, 550)]} == {500}
    assert got[9000] == got[8000] == 8000
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


@pytest.mark.parametrize("order", ["rising", "zigzag", "shuffled"])
def test_components_of_a_long_chain_take_few_steps(spark, order):
    n = 1000
    ids = {"rising": list(range(n)), "zigzag": [i // 2 if i % 2 else n - i // 2 for i in range(n)],
           "shuffled": np.random.default_rng(1).permutation(n).tolist()}[order]
    steps = []
    got = components(spark.createDataFrame(list(zip(ids, ids[1:])), "a bigint, b bigint"), "a", "b", steps).collect()
    assert len(got) == n and {r["root"] for r in got} == {min(ids)}
    assert steps.count("doubling") <= 40 and steps.count("round") <= 10
