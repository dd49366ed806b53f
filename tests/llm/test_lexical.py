from __future__ import annotations

import collections
import math
import random
import re

import pytest

from faultline.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def slow_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def slow_search(docs, items, k=20):
    """Every item against every document."""
    tf = [(i, collections.Counter(slow_terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in tf if c)
    length = sum(sum(c.values()) for _, c in tf)
    df = collections.Counter(t for _, c in tf for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for doc, c in tf:
            n, score = sum(c.values()), 0
            for t in slow_terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * (75 + (25 * n * n_docs) // length)))
            if score > 0:
                found.append((-score, doc is None, doc))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, "x", 3) for i, t in items], "item_id bigint, text string, doc_id string, score int")


ITEMS = [
    (1, "alpha1 beta2 alpha1 RIVER3"), (2, "über7 naïve9,the1"), (3, None), (4, ""), (5, " \n.;-"), (None, "stone4 river3"),
    (6, "the1 the1 the1 of2"), (6, "the1 the1 the1 of2"), (7, "nowhere to be found"), (8, "word"), (8, "run 5 x"),
    (9, "ab.c@de 974 555 mail"), (10, "line one here"), (11, "中文 word"),
]


@pytest.mark.parametrize("max_postings,cells,k", [(500_000, 1 << 20, 20), (5, 64, 3)])
def test_matches_brute_force_on_edge_rows(spark, edge_docs, edge_rows, monkeypatch, max_postings, cells, k):
    """Nulls, empty and very long texts, repeated documents and items, many blocks, small tables."""
    monkeypatch.setattr(lexical, "CELLS", cells)
    monkeypatch.setattr(lexical, "GROUP_ROWS", 7)
    got = lexical.search(edge_docs.repartition(4), items_frame(spark, ITEMS), k, max_postings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == slow_search([r[:2] for r in edge_rows], ITEMS, k)


def test_a_hot_term_and_ties_keep_the_smallest_ids(spark, make):
    rows = [(i, "common rare" if i == 77 else "common", "en", "s") for i in range(300, 0, -1)]
    got = lexical.search(make(rows).repartition(5), items_frame(spark, [(1, "common")]))
    assert [r["doc_id"] for r in got.orderBy("rank").collect()] == list(range(1, 21))
    assert sorted(map(tuple, got.collect()), key=str) == slow_search([r[:2] for r in rows], [(1, "common")])


def test_empty_tables(spark, no_docs, edge_docs):
    assert lexical.search(no_docs, items_frame(spark, ITEMS)).count() == 0
    assert lexical.search(edge_docs, items_frame(spark, [])).count() == 0
    assert lexical.search(edge_docs, items_frame(spark, [(1, None), (2, "...")])).count() == 0


def test_heaps_hold_the_best_in_any_order():
    import numpy as np

    r = random.Random(4)
    rows = [(r.randrange(3), r.randrange(1, 6), r.randrange(50), r.random() < 0.1) for _ in range(400)]
    heaps = lexical._Heaps(3, 4)
    for s in range(0, 400, 37):
        part = rows[s : s + 37]
        heaps.offer(*(np.array([x[c] for x in part], t) for c, t in enumerate((np.int64, np.int64, np.int64, bool))))
    for item in range(3):
        want = sorted((-s, none, d) for i, s, d, none in rows if i == item)[:4]
        at = heaps.item == item
        assert list(zip((-heaps.score[at]).tolist(), heaps.none[at].tolist(), heaps.doc[at].tolist())) == want
        assert heaps.worst[item] == -want[-1][0]
