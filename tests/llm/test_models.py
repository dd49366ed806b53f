"""The trained operators: quality classifier, language, personal data."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from faultline.llm import crf, langid, weaklabel

SF = "/root/testdata/sf0.01"


def test_vote_model_finds_reliable_labellers():
    import numpy as np

    rng = np.random.default_rng(0)
    bad = rng.random(5000) < 0.15
    votes = np.where(rng.random((5000, 4)) < np.where(bad[:, None], 0.6, 0.001), -1, 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior = weaklabel.fit_votes(patterns, counts.astype(float))
    said = np.array([posterior[tuple(int(x) for x in v)] >= 0.5 for v in votes])
    assert (said == bad).mean() > 0.97
    assert weaklabel.fit_votes(np.empty((0, 4), int), np.empty(0)) == {}


def test_classifier_keeps_good_and_rejects_bad(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 4000")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = weaklabel.classify(docs).join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in got}
    assert n.get((1, False), 0) <= 0.01 * n[1, True] and n.get((0, True), 0) <= 0.1 * n[0, False]


def test_classifier_judges_short_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 4000").select("doc_id", "text")
    short = [(10**6 + i, t) for i, t in enumerate(["That*** atly.###", "Reon*** haeand$$$ and&&& ererti$$$ reorsh$$$ ererndhe.***"])]
    plain = [(10**6 + 10 + i, t) for i, t in enumerate(["Thtion.", "De.", "The esingor.", "Therti onor theasthe.", "", None])]
    got = weaklabel.classify(docs.union(spark.createDataFrame(short + plain, "doc_id bigint, text string"))).where("doc_id >= 1000000")
    p = {r["doc_id"] - 10**6: r["p_bad"] for r in got.collect()}
    assert min(p[0], p[1]) >= weaklabel.REJECT_FROM and max(p[i] for i in range(10, 16)) < weaklabel.REJECT_FROM
    assert p[14] == p[15] == 0 < min(p[i] for i in range(10, 14))


def test_classifier_edge_rows(edge_docs, edge_rows, no_docs):
    got = weaklabel.classify(edge_docs).collect()
    assert collections.Counter(g["doc_id"] for g in got) == collections.Counter(r[0] for r in edge_rows)
    assert weaklabel.keep_good(edge_docs).columns == edge_docs.columns
    assert weaklabel.classify(no_docs).count() == weaklabel.keep_good(no_docs).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [g for g in got if g["held_out"]]
    assert all(g["held_out"] == (zlib.crc32(str(g["doc_id"]).encode()) % 4 == 2) for g in got)
    assert sum(g["lang_pred"] == g["lang"] for g in out) >= 0.98 * len(out) and all(0 <= g["score"] <= 1 for g in got)


def test_language_edge_rows(edge_docs, edge_rows, no_docs, make):
    got = langid.identify(edge_docs).collect()
    assert collections.Counter(g["doc_id"] for g in got) == collections.Counter(r[0] for r in edge_rows)
    assert all(g["lang_pred"] == "und" and g["score"] == 0 for g in got if g["doc_id"] in (200, 201, 202))
    assert langid.identify(no_docs).count() == 0
    unlabelled = langid.identify(make([(1, "some text", None, None)])).first()
    assert (unlabelled["lang_pred"], unlabelled["score"]) == ("und", 0.0)


def luhn(s):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(s[::-1])) % 10 == 0


def slow_base(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [("ip", *m.span())] if all(int(p) <= 255 for p in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        out += [("card", *m.span())] if 13 <= len(d) <= 19 and luhn(d) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [("phone", *m.span())] if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15 else []
    return out


def test_base_spans_match_the_patterns():
    r = random.Random(4)
    parts = ["a@b.c", "x.y@", "@d.e", "@f.g", "1.2.3.4", "300.1.1.1", "00.1.02.3", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (974) 555-3436", "+49", "+", "12", "7", ".", " ", "-", "@", "é", "+1+22 333 44 55 66", "٣"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(1, 9)))
        assert crf.base_spans(text) == slow_base(text), text
    assert crf.base_spans("9" * 200_000) == [] and crf.base_spans("a" * 200_000 + "@") == []


def test_ip_parts_of_many_zeros():
    zeros = "0" * 5000
    assert crf.base_spans(f"{zeros}.1.1.{zeros}7") == [("ip", 0, 10_006)] and crf.base_spans(f"{zeros}256.1.1.1") == []


def test_field_learns_its_table_and_leaves_others_alone():
    field = crf.train()
    hits = wanted = wrong = 0
    for text, spans in crf.labelled_table():
        base, added = crf.find([text], field)[0]
        got = {(s, e) for _, s, e in base + added}
        wanted += len(spans)
        hits += sum(any(s < b and e > a for s, e in got) for _, a, b in spans)
        wrong += sum(not any(s < b and e > a for _, a, b in spans) for _, s, e in added)
    assert hits >= 0.95 * wanted and wrong == 0
    text = "phone (212) 555-0199 or 4845168114407329 under version 2.0 of 2019"
    assert [(k, text[s:e]) for k, s, e in crf.find([text], field)[0][1]] == [("phone", "(212) 555-0199")]


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    k = len(crf.LABELS)
    field = crf.Field({}, np.zeros((1, k)), rng.normal(size=(k, k)), rng.normal(size=k))
    emit = rng.normal(size=(5, 3, k))
    for e, path in zip(emit, field.viterbi(emit)):
        score = lambda p: field.begin[p[0]] + sum(e[i, x] for i, x in enumerate(p)) + field.move[p[0], p[1]] + field.move[p[1], p[2]]  # noqa: E731,B023
        assert score(tuple(path)) == pytest.approx(max(map(score, itertools.product(range(k), repeat=3))))


def test_personal_data_edge_rows(edge_docs, edge_rows, no_docs):
    got = crf.personal_data(edge_docs).collect()
    want = collections.Counter()
    for i, t, _, _ in edge_rows:
        spans = ",".join(f"{k}:{s}:{e}" for k, s, e in slow_base(t or ""))
        want[i, hashlib.sha256(spans.encode()).hexdigest()] += 1
    assert collections.Counter((g["doc_id"], g["base_sha256"]) for g in got) == want
    clean = {r["doc_id"]: r for r in crf.redact(edge_docs).collect()}
    assert clean[207]["text"] == "mail <EMAIL> or <PHONE> now" and clean[207]["n_chars"] == len(clean[207]["text"])
    assert clean[200]["text"] is None and clean[200]["n_chars"] is None
    assert crf.redact(edge_docs).columns == edge_docs.columns
    assert crf.personal_data(no_docs).count() == crf.redact(no_docs).count() == 0
    assert crf.redact(edge_docs).where(F.col("key") != "x").count() == 0


def test_language_sample_is_the_smallest_hashes_whatever_the_spread(spark):
    """One language with nearly all rows, repeated ids, a language with few."""
    from pyspark.sql import functions as F

    rows = spark.range(20_000).select("id", F.when(F.col("id") % 100 == 0, "few").otherwise("hot").alias("lang"))
    rows = rows.union(rows.where("id < 50"))
    got = {(r["lang"], r["id"]): r["rank"] for r in langid.smallest_hashes(rows, 150).collect()}
    for lang in ("hot", "few"):
        order = [r["id"] for r in rows.where(F.col("lang") == lang).select("id", F.xxhash64("id").alias("h")).distinct().orderBy("h").limit(150).collect()]
        assert {i: r for (x, i), r in got.items() if x == lang} == {i: n for n, i in enumerate(order, 1)}


def test_many_languages_share_the_training_rows(make, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_ROWS", 8)
    monkeypatch.setattr(langid, "TRAIN_LANDMARKS", 4)
    docs = make([(i, f"text {i} {'abcd'[i % 4] * 9}", f"l{i % 4}", None) for i in range(60)])
    assert set(langid.train(docs)["names"]) == {"l0", "l1", "l2", "l3"}
    monkeypatch.setattr(langid, "TRAIN_LANDMARKS", 3)
    with pytest.raises(ValueError, match="languages"):
        langid.train(docs)
