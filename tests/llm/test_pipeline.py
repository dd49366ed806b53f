from __future__ import annotations

import collections
import zlib

import numpy as np
from pyspark.sql import functions as F
from test_packing_mixing import check_layout, slow_copies, words
from test_simhash import slow_components, slow_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from faultline.llm import crf, mixing, simhash, weaklabel
from faultline.llm.common import BLANKS, cut
from faultline.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_nothing_else_is_lost(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in weaklabel.classify(docs).where("kept").collect()}
    good = cut(corpus_pipeline.quality(spark, docs, SF), "t")
    assert {r["doc_id"] for r in good.collect()} == kept and good.columns == docs.columns

    near = simhash.near_duplicates(good).collect()
    single = cut(corpus_pipeline.near_dedup(spark, good, SF), "t")
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({r["component_id"] for r in near})

    clean = cut(corpus_pipeline.personal_data(spark, single, SF), "t")
    assert clean.columns == docs.columns and clean.count() == single.count()
    assert all(not crf.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in clean.collect())

    mixed = cut(corpus_pipeline.mixture(spark, clean, SF), "t")
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(clean).collect() if r["copies"]}
    assert collections.Counter(r["doc_id"] for r in mixed.collect()) == want

    packed = corpus_pipeline.pack(spark, mixed, SF).collect()
    assert collections.Counter(r["doc_id"] for r in packed if r["piece"] == 0) == want
    result = corpus_pipeline.run(spark, SF).collect()
    cols = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert collections.Counter(tuple(r[c] for c in cols) for r in result) == collections.Counter(tuple(r[c] for c in cols) for r in packed)


def plain_pipeline(spark, docs, rows):
    """The five stages row by row, with the trained models and the random numbers as inputs: the pieces
    of the corpus as ``doc_id, piece, start, length, ids_crc32``."""
    # Quality: what the scorer's weights say of each text.
    model = weaklabel.train(docs)
    kept = []
    for r in rows:
        if r[1] is not None and r[1].strip(BLANKS):
            values, own = weaklabel.features(r[1])
            z = own * float(values @ model["weights"]) + (1 - own) * model["typical"] + model["bias"]
            if 1 / (1 + np.exp(-np.clip(z, -60, 60))) >= weaklabel.REJECT_FROM:
                continue
        kept.append(r)
    # Near-duplicates: every pair of fingerprints; of a component the smallest id, then hash, stays once.
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    label = slow_components([slow_fingerprint(r[1]) for r in kept], 4)
    first = {}
    for r, c in zip(kept, label):
        key = (r[0] is None, r[0] or 0, hashes[r[1]])
        if c not in first or key < first[c][0]:
            first[c] = (key, r)
    single = [r for _, r in first.values()]
    # Personal data: spans from the trained field, from the left, overlapping ones as one.
    field, clean = crf.train(), []
    for i, t, g, s in single:
        base, added = crf.find([t or ""], field)[0]
        made, at = "", 0
        for kind, a, b in sorted(base + added, key=lambda x: (x[1], -x[2])):
            if a >= at:
                made += (t or "")[at:a] + f"<{kind.upper()}>"
            at = max(at, b)
        clean.append((i, None if t is None else made + t[at:], g, s))
    # Mixing: a plain ranking with the hashed numbers.
    of = spark.createDataFrame([(i, t) for i, t, _, _ in clean], "doc_id bigint, text string")
    u = {(r["doc_id"], r["text"]): r["u"] for r in of.select("*", mixing.uniform(of["doc_id"], of["text"]).alias("u")).collect()}
    copies = slow_copies([(s, words(t), u[i, t]) for i, t, _, s in clean])
    # Packing: ids by the tokenizer, pieces of 2048.
    tokenizer, out = Tokenizer.from_file(tokenizer_path()), collections.Counter()
    for (i, t, _, _), n in zip(clean, copies):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for p, a in enumerate(range(0, len(ids), 2048)):
            out[i, p, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())] += n
    return +out


def test_run_matches_a_plain_version_on_edge_rows(spark, edge_docs, edge_rows, tmp_path):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing column names."""
    edge_docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    cols = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert collections.Counter(tuple(r[c] for c in cols) for r in got) == plain_pipeline(spark, docs, edge_rows)
    assert check_layout(got, 2048) <= -(-sum(r["length"] for r in got) // 2048) + 1


def test_run_on_an_empty_table(spark, no_docs, tmp_path):
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
