"""The operators made of DataFrame functions alone: fingerprints, url rules, quality rules."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from faultline.llm import multiset, risk, urlrules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_edited_fingerprints(edge_docs, edge_rows):
    got = multiset.edited_fingerprints(edge_docs).collect()
    assert len(got) == len(edge_rows)
    ids = sorted({r[0] for r in edge_rows}, key=lambda i: (i is not None, i))
    heads = {i: [r[1] or "" for r in edge_rows if r[0] == i] for i in ids}
    after = dict(zip(ids, ids[1:] + ids[:1]))
    want = collections.Counter()
    for i, t, _, _ in edge_rows:
        t = t or ""
        # Rows of one id share the beginning the longest of them needs; the smallest stands.
        need = max(len(x) // 4 for x in heads[i])
        head = min((x[:need] for x in heads[after[i]]), key=str.encode)
        new = t[: len(t) - len(t) // 4] + head[: len(t) // 4]
        want[i, len(t), hashlib.sha256(new.encode()).hexdigest()] += 1
    assert collections.Counter((g["doc_id"], g["n_chars"], g["edited_sha256"]) for g in got) == want
    assert all(0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1 for g in got)
    by = {g["n_chars"]: g for g in got if g["n_chars"] > 10_000}
    assert all(g["near_edited"] > 0.5 or g["n_chars"] == 50_000 for g in by.values())


def test_edited_fingerprint_is_that_of_the_edited_text(make):
    rows = [(i, "\n".join(f"line {j} of {i} goes on" for j in range(i + 1)), "en", "s") for i in range(8)]
    got = {g["doc_id"]: g for g in multiset.edited_fingerprints(make(rows)).collect()}
    edited = []
    for i, t, *_ in rows:
        nxt = rows[(i + 1) % len(rows)][1]
        edited.append((i, t[: len(t) - len(t) // 4] + nxt[: len(t) // 4], "en", "s"))
    direct = multiset.fingerprint(make(edited)).select("doc_id", multiset.to_string(F.col("fingerprint")).alias("s"))
    assert all(r["s"] == got[r["doc_id"]]["edited_fingerprint"] for r in direct.collect())


def test_order_insert_and_delete(spark):
    df = spark.createDataFrame([("a b c\nd e\nd e\n\nlong " + "w " * 30, "d e\nlong " + "w " * 30 + "\n\na b c\nd e", "a b c\nd e\n\nd e", "long " + "w " * 30)], "x string, y string, z string, one string")
    for c in ("x", "y", "z", "one"):
        df = multiset.fingerprint(df, c, f"f_{c}")
    row = df.select(
        (F.col("f_x") == F.col("f_y")).alias("same"),
        (multiset.insert(F.col("f_z"), F.col("f_one")) == F.col("f_x")).alias("inserted"),
        (multiset.delete(F.col("f_x"), F.col("f_one")) == F.col("f_z")).alias("deleted"),
        (F.col("f_x") == F.col("f_z")).alias("other"),
        multiset.likeness(F.col("f_x"), F.col("f_y")).alias("one"),
    ).first()
    assert (row["same"], row["inserted"], row["deleted"], row["other"], row["one"]) == (True, True, True, False, 1.0)


def slow_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    host = re.match(r"[^/?#]*", rest)[0] if rest is not None else ""
    path = re.match(r"[^?#]*", rest[len(host) :])[0] if rest is not None else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h) + len(p), len(h), v == "block", h + p, v)
        for v, h, p in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


def test_urls_match_brute_force(spark):
    r = random.Random(1)
    labels = ["com", "net", "example", "a", "b", "a-b", "x", "co", "é", ""]
    name = lambda: ".".join(r.choice(labels) for _ in range(r.randrange(1, 5)))
    rules = [(r.choice(["allow", "block"]), name(), r.choice(["/", "", "/en/", "/en/x", "/de/"])) for _ in range(60)]
    rules += [rules[0], ("block", "", "/")]
    urls = [f"{r.choice(['http', 'HTTPS'])}://{name()}{r.choice(['', '/', '/en/', '/en/xy?q=/de/', '/de/#x', '?a', '#b'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "a://b://c/d", "http://EXAMPLE.net/en/", "http://", "x\ny://h\n/p"] + ["http://hot.example.net/en/"] * 300
    rows = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id bigint, url string, host string, `_key` string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    got = {g["page_id"]: (g["host"], g["path"], g["rule"], g["verdict"]) for g in urlrules.judge_urls(rows.drop("_key"), table, "url").collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert got[i] == slow_verdict(u, [x for x in rules if x[1]]), u
    assert urlrules.judge_urls(rows.limit(0).drop("_key"), table, "url").count() == 0
    assert {g["verdict"] for g in urlrules.judge_urls(rows.drop("_key"), table.limit(0), "url").collect()} == {"allow"}


def test_many_nested_path_rules_on_one_host(spark):
    """20,000 rules on one host, nested up to eight deep; no event holds more than one rule."""
    rules = [("block" if i % 2 else "allow", "h.com", "/" + "/".join(str(i + 10**4)[: n + 1])) for n in range(5) for i in range(4000)]
    rules = sorted(set(rules)) + [("allow", "com", "/1"), ("block", "h.com", "/\U0010ffff"), ("allow", "x.h.com", "/1/0/")]
    urls = [f"http://{h}/{'/'.join(str(i * 37 % 4000 + 10**4))}{t}" for i in range(400) for h in ("h.com", "x.h.com") for t in ("", "/z")]
    urls += ["http://h.com/\U0010ffff\U0010ffffx", "http://h.com/9", "http://other.com/1", "http://h.com"]
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    got = {g["page_id"]: (g["host"], g["path"], g["rule"], g["verdict"]) for g in urlrules.judge_urls(rows, table, "url").collect()}
    by_path = {}
    for v, h, p in rules:
        by_path.setdefault(p, []).append((v, h, p))
    for i, u in enumerate(urls):
        path = u.split("://")[1].partition("/")[2]
        near = [x for n in range(len(path) + 2) for x in by_path.get(("/" + path)[:n], [])]
        assert got[i] == slow_verdict(u, near), u
    assert not any(t.startswith("array") for _, t in urlrules._events(urlrules._usable(table)).dtypes)


def slow_measures(text):
    text = text or ""
    w = WORD.findall(text)
    seen, covered = collections.Counter(zip(w, w[1:], w[2:])), set()
    for i, x in enumerate(zip(w, w[1:], w[2:])):
        if seen[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures_match_brute_force(edge_docs, edge_rows, no_docs, spark):
    labels = spark.createDataFrame([(0, 1), (0, None), (None, 1)], "doc_id bigint, quality int")
    got = risk.judge(edge_docs, labels).collect()
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    want = collections.Counter((i, *slow_measures(t)) for i, t, _, _ in edge_rows)
    assert collections.Counter((g["doc_id"], *[g[c] for c in cols]) for g in got) == want
    assert all(g["base_failed"] == (g["n_words"] < 50 or 100 * g["n_repeat_words"] > 50 * g["n_words"]) for g in got)
    assert all(g["kept"] == (not g["base_failed"]) for g in got)
    assert risk.judge(no_docs, labels).count() == 0


@pytest.mark.parametrize("k,n", [(0, 10), (3, 1000), (9, 1000), (0, 100_000), (950, 100_000), (30, 1000), (0, 0)])
def test_binomial_p(spark, k, n):
    r = 0.01
    got = spark.range(1).select(risk.binomial_p(F.lit(k), F.lit(n), r)).first()[0]
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(r) + (n - i) * math.log1p(-r)
    want = sum(math.exp(log(i)) for i in range(k + 1)) if k < n * r else 1.0
    assert got == pytest.approx(want, rel=1e-8)


def test_cutoffs_hold_their_risk(spark, make):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(9000):
        bad = i % 5 == 0
        words = [f"w{r.randrange(5000)}" + ("$$$" if bad else "$" if r.random() < 0.02 else "") for _ in range(60)]
        rows.append((i, " ".join(words), "en" if i % 30 else None, "s"))
        labels.append((i, int(not bad)))
    table = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = {g["doc_id"]: g for g in risk.judge(make(rows), table).collect()}
    good = [g for i, g in got.items() if i % 5]
    assert sum(not g["kept"] for g in good) <= risk.RISK * len(good)
    assert all(not g["kept"] for i, g in got.items() if i % 5 == 0 and i % 30)
    # The null stratum has bad documents only: nothing can be certified, nothing is rejected there.
    assert all(g["kept"] for i, g in got.items() if i % 30 == 0)


def slow_certified(rows, risk_share=0.02, error=0.05):
    """``{stratum: (steps, n, k)}`` from rows of stratum, good, levels, selects."""
    out, strata = {}, sorted({r[0] for r in rows}, key=str)
    plans = {}
    for s in strata:
        mine = [r for r in rows if r[0] == s and r[3]]
        steps = []
        for rule in range(len(risk.RULES)):
            worst = max([r[2][rule] for r in mine if r[1]], default=0) + 1
            beyond = [r[2][rule] for r in mine if not r[1] and r[2][rule] >= worst]
            if beyond:
                steps.append((-len(beyond), rule, math.ceil((worst + min(beyond)) / 2)))
        if steps:
            plans[s] = [x[1:] for x in sorted(steps)]
    for s, steps in plans.items():
        good = [r for r in rows if r[0] == s and not r[3] and r[1]]
        for i in range(1, len(steps) + 1):
            k = sum(any(r[2][rule] >= c for rule, c in steps[:i]) for r in good)
            n, q = len(good), risk_share
            p = sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(q) + (n - j) * math.log1p(-q)) for j in range(k + 1)) if k < n * q else 1.0
            if p > error / len(plans):
                break
            out[s] = (steps[:i], n, k)
    return out


def test_certified_unions_match_plain_python_and_hold_on_other_rows(spark, make):
    """Three strata: one with two useful rules, one where a rule rejects too many, one with few labels."""
    r = random.Random(7)
    rows, labels = [], []
    for i in range(6000):
        stratum, bad = ["en", "en", "de", "en", "de", None][i % 6], r.random() < 0.15
        words = [f"w{r.randrange(5000)}" for _ in range(60)]
        if bad and r.random() < 0.6:
            words = [w + "$$" for w in words]
        elif bad:
            words = [w + "!" for w in words]
        elif stratum == "de" and r.random() < 0.04:
            words = [w + "!!" for w in words]
        if stratum is None and i > 900:
            continue
        rows.append((i, " ".join(words), stratum, "s"))
        if i % 2:
            labels.append((i, int(not bad)))
    table = spark.createDataFrame([*labels, labels[0], (None, 1), (labels[1][0], None)], "doc_id bigint, quality int")
    measured = risk.measures(make(rows))
    plain = [tuple(x) for x in risk._labelled(measured, table).select("stratum", "good", "levels", "selects").collect()]
    want = slow_certified(plain)
    got = {c["stratum"]: ([tuple(x) for x in c["steps"]], c["n"], c["k"]) for c in risk.certified(measured, table).collect()}
    assert got == want and "en" in got and None not in got
    # Rows without a label took no part in the choice.
    judged = {g["doc_id"]: g for g in risk.judge(make(rows), table).collect()}
    held = [g for i, g in judged.items() if i not in dict(labels)]
    for g in held:
        steps = want.get(g["stratum"], ([],))[0]
        assert g["failed_rules"] == [risk.RULES[k] for k in sorted(k for k, c in steps if level(g, k) >= c)]
    clean = [g for g in held if g["n_symbols"] == 0 and g["n_marks"] == 0]
    assert sum(not g["kept"] for g in clean) <= risk.RISK * len(clean)


def level(g, rule):
    over = {"symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"),
            "marks": ("n_marks", "n_words"), "capitals": ("n_capitals", "word_chars")}[risk.RULES[rule]]
    return math.floor(min(g[over[0]] / max(g[over[1]], 1), 1.0) * risk.STEPS)


def test_strong_lanes_are_not_functions_of_each_other(spark):
    """A lane hashes the paragraph itself: it cannot be had from another lane and the lane's number."""
    rows = spark.range(200).select(F.concat(F.lit("paragraph "), "id").alias("p"))
    lanes = rows.select("p", multiset.paragraph_sum(F.array("p"), F.array().cast("array<bigint>")).alias("v"), F.xxhash64("p").alias("h"))
    mask = F.lit(multiset.MODULUS_MASK)
    for j in range(multiset.STRONG):
        chained = lanes.where(F.element_at("v", j + 1) == F.xxhash64("p", F.lit(j)).bitwiseAND(mask)).count()
        own = lanes.where(F.element_at("v", j + 1) == F.xxhash64(F.lit(j), F.col("p")).bitwiseAND(mask)).count()
        assert (chained, own) == (0, 200)


def test_fingerprint_keeps_clashing_columns_and_empty_tables(spark, no_docs):
    df = spark.createDataFrame([("a b", 1, "x", 2)], "text string, `_hashes` int, `_text` string, `_row` int")
    got = multiset.fingerprint(df)
    assert got.columns == ["text", "_hashes", "_text", "_row", "fingerprint"] and tuple(got.first())[:4] == ("a b", 1, "x", 2)
    assert multiset.edited_fingerprints(no_docs).count() == 0
