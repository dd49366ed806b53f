from __future__ import annotations

import collections
import re
import zlib

import numpy as np
import pytest

from faultline.llm import mixing, packing
from faultline.llm.queries import tokenizer_path


def check_layout(rows, sequence):
    placed = collections.defaultdict(list)
    for r in rows:
        placed[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in placed.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(n for _, n in parts) <= sequence
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    return len(placed)


def test_pack_edge_rows(edge_docs, edge_rows, no_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = packing.pack(edge_docs, tokenizer_path()).collect()
    want = collections.Counter()
    for i, t, _, _ in edge_rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for p, s in enumerate(range(0, len(ids), 2048)):
            want[i, p, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    total = sum(r["length"] for r in rows)
    assert check_layout(rows, 2048) <= -(-total // 2048) + 1
    assert packing.pack(no_docs, tokenizer_path()).count() == 0


@pytest.mark.parametrize("text", ["a<|endoftext|>b <|startoftext|> c", "\x1c\x1d a\u2003b\u00a0c", "e\u0301 ẞ İ ΑΣ don't I'LL 3½", "\ue000 \ud7ff 🙂🙂 ok"])
def test_words_tokenize_like_whole_texts(text):
    words = packing.WordTokenizer(tokenizer_path())
    whole = words.tokenizer.encode(text, add_special_tokens=False).ids
    assert words([text, None, text])[2].tolist() == [*whole, 0] and words(["new " + text])[0].tolist()[-len(whole) - 1 :] == [*whole, 0]


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    n = 64
    histogram = np.r_[0, rng.integers(0, [3, 50, 5000][seed % 3], n)] * (rng.random(n + 1) < 0.6)
    plan = packing.plan(histogram, n)
    fill = np.zeros(int(plan["sequences"]), np.int64)
    ends = collections.defaultdict(int)
    for length, first, count, base, offset in zip(*(plan[k].tolist() for k in ("length", "first", "count", "base", "offset"))):
        assert first == ends[length]
        ends[length] += count
        assert offset + length <= n
        fill[base : base + count] += length
    assert all(ends[i] == histogram[i] for i in range(1, n + 1)) and (fill <= n).all() and (fill > 0).all()
    bound = -(-int((histogram * np.arange(n + 1)).sum()) // n)
    assert len(fill) <= bound * 1.35 + 2


def slow_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, unfilled = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), set(order)
    while left > 1e-9 and unfilled:
        whole = sum(weight[s] for s in unfilled)
        give, left = left, 0.0
        for s in list(unfilled):
            target[s] += give * weight[s] / whole
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
                unfilled.discard(s)
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix_edge_rows(edge_docs, edge_rows, no_docs):
    got = mixing.mix(edge_docs).collect()
    sizes = collections.Counter()
    for _, t, _, s in edge_rows:
        sizes[s] += words(t)
    target = slow_targets(sizes)
    want = collections.Counter((i, words(t), sizes[s], round(target[s], 6)) for i, t, _, s in edge_rows)
    assert collections.Counter((g["doc_id"], g["size"], g["source_size"], round(g["target"], 6)) for g in got) == want
    assert all(g["taken"] == g["size"] * g["copies"] and g["copies"] <= 2 for g in got)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(edge_docs.repartition(5)).collect()), key=str)
    copies = mixing.mixed_documents(edge_docs)
    assert copies.columns == edge_docs.columns and copies.count() == sum(g["copies"] for g in got)
    assert mixing.mix(no_docs).count() == mixing.mixed_documents(no_docs).count() == 0


def test_mix_comes_near_targets(make):
    docs = make([(i, "w " * (1 + i * 7919 % 50), "en", [None, "b", "a", "é", "hot", "hot", "hot"][i % 7]) for i in range(7000)])
    taken = collections.Counter()
    target = {}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    for g in mixing.mix(docs).collect():
        taken[source[g["doc_id"]]] += g["taken"]
        target[source[g["doc_id"]]] = g["target"]
    assert all(abs(taken[s] - target[s]) <= 50 for s in target) and len(target) == 5


def slow_copies(rows):
    """``copies`` per row of source, size, u: sizes in descending order for c, then ranks in order."""
    sizes = collections.Counter()
    for s, n, _ in rows:
        sizes[s] += n
    target, copies = slow_targets(sizes), []
    ranks, edge = {}, {}
    for s in sizes:
        whole = int(target[s] / sizes[s] + 1e-12) if sizes[s] else 0
        need = target[s] - whole * sizes[s]
        mine = sorted({n for x, n, _ in rows if x == s and n}, reverse=True)
        ranks[s], edge[s] = (whole, None), None
        if need <= 1e-6 * max(sizes[s], 1):
            continue
        for z in mine:
            c = (need - sum(n for x, n, _ in rows if x == s and n > z)) / sum(n * n for x, n, _ in rows if x == s and n <= z)
            if c * z < 1:
                break
        rank = lambda n, u, c=c: 0.0 if c * n >= 1 else (o := u / (1 - u) / (c * n / (1 - c * n))) / (1 + o)
        ranks[s] = (whole, rank)
        by_rank = collections.Counter()
        for x, n, u in rows:
            if x == s and n:
                by_rank[rank(n, u)] += n
        begin = 0
        for q in sorted(by_rank):
            if begin < need and begin + by_rank[q] - need <= need - begin:
                edge[s] = q
            begin += by_rank[q]
    for s, n, u in rows:
        whole, rank = ranks[s]
        copies.append(whole + (rank is not None and n > 0 and edge[s] is not None and rank(n, u) <= edge[s]))
    return copies


@pytest.mark.parametrize("bins", [4096, 4])
def test_documents_taken_match_a_plain_ranking(make, edge_rows, monkeypatch, bins):
    monkeypatch.setattr(mixing, "BINS", bins)
    rng = np.random.default_rng(bins)
    rows = [(i, "w " * int(rng.integers(0, 60)) + ("long " * 900 if i % 97 == 0 else ""), "en", ["a", "b", None, "c", "hot", "hot"][i % 6]) for i in range(1500)]
    rows += [rows[5], rows[5], rows[11]] + edge_rows
    docs = make(rows)
    keyed = docs.select("doc_id", "source", mixing.word_count(docs["text"]).alias("n"), mixing.uniform(docs["doc_id"], docs["text"]).alias("u")).collect()
    want = collections.Counter((r["doc_id"], r["n"], c) for r, c in zip(keyed, slow_copies([(r["source"], r["n"], r["u"]) for r in keyed])))
    got = mixing.mix(docs).collect()
    assert collections.Counter((g["doc_id"], g["size"], g["copies"]) for g in got) == want
    assert len({c for *_, c in want}) > 1


def test_longer_documents_are_included_as_often_as_stated(make):
    """600 sources of equal sizes are 200 draws for each weight: frequencies against min(1, c * words)."""
    sizes = [1, 2, 3, 5, 8, 13, 21, 34, 55, 89] * 4
    docs = make([(1000 * s + i, "w " * n, "en", f"s{s:03}") for s in range(600) for i, n in enumerate(sizes)])
    total, often, share = sum(sizes), collections.defaultdict(list), {}
    for g in mixing.mix(docs).collect():
        turn = g["doc_id"] // 1000 % 3
        share[turn] = g["target"] / total
        often[turn, g["size"]].append(g["copies"])
    assert len({round(x, 6) for x in share.values()}) == 3
    for turn, f in share.items():
        whole, need = int(f + 1e-9), (f - int(f + 1e-9)) * total
        if need < 1e-6:
            assert all(c == whole for (t, _), cs in often.items() if t == turn for c in cs)
            continue
        for z in sorted(set(sizes), reverse=True):
            c = (need - sum(n for n in sizes if n > z)) / sum(n * n for n in sizes if n <= z)
            if c * z < 1:
                break
        for n in set(sizes):
            p = min(1.0, c * n)
            seen = np.mean(often[turn, n]) - whole
            # Four standard deviations of 800 draws, and a little for the last document of each sample.
            assert abs(seen - p) <= 4 * np.sqrt(p * (1 - p) / len(often[turn, n])) + 0.02, (turn, n, seen, p)


def test_another_kind_of_tokenizer_is_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="blank-separated"):
        packing.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def test_workers_keep_one_memory():
    from faultline.llm.memory import of_process

    made = []
    assert of_process("test key", lambda: made.append(1) or made) is of_process("test key", lambda: made.append(2)) and made == [1]
