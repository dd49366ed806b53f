"""Operator 6: a quality classifier learned from weak labels.

Heuristic labellers vote good, bad or nothing on every document, from measures that Spark
computes. Expectation-maximisation estimates how each labeller votes on good and on bad documents,
without any true label: it needs only how often each pattern of votes occurs (at most
3**labellers rows, counted over all documents). The posterior of a document's pattern is its
weak label. A linear scorer over hashed features of the whole text is then trained on a bounded
sample (``PER_CLASS`` documents of each weak label, those with the smallest id hash), and scores
every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import BLANK_CLASS, BLANKS, cut, materialised, whole_row, without, word_array

# Labeller: measure, bad from here on, good up to here (the last is turned round).
LABELLERS = (
    ("symbols", 0.30, 0.05),
    ("marks", 0.30, 0.05),
    ("capitals", 0.50, 0.20),
    ("echoes", 0.30, 0.05),
    ("dup_lines", 0.40, 0.20),
    ("sameness", 0.80, 0.60),
)
MAX_FALSE = 0.002
PER_CLASS = 2000
DIMS = 4096
GRAMS = 4
# Shares seen in few class characters are drawn to those of good texts, as if so many more were typical.
TYPICAL = 4
BUCKETS = 20
REJECT_FROM = 0.5

_CLASSES = np.full(256, ord("a"), np.uint8)
for _c in range(128):
    _s = chr(_c)
    _CLASSES[_c] = ord("a" if _s.islower() else "A" if _s.isupper() else "9" if _s.isdigit() else " " if _s in BLANKS else _s)


def votes(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``votes``, an array of 1 (good), -1 (bad) and 0 per labeller.

    No measure is defined without a word: there all labellers abstain. A text of one word or one
    line repeats none (shares of 0).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialised(docs.withColumn("_t", text), "_w", word_array(F.col("_t")))
    rows = rows.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != ""))
    t, n = F.col("_t"), F.greatest(F.size("_w"), F.lit(1))
    count = lambda pattern: F.length(t) - without(t, pattern)
    echo = F.zip_with("_w", F.expr("slice(_w, 2, greatest(size(_w), 1))"), lambda a, b: F.when(a == b, F.lit(1)))
    lines = F.greatest(F.size("_l"), F.lit(1))
    of: dict[str, Column] = {
        "symbols": count("[#*$%&|<>]") / n,
        "marks": count("!") / n,
        "capitals": count(r"\p{Lu}") / F.greatest(without(t, f"[{BLANK_CLASS}]"), F.lit(1)),
        "echoes": F.size(F.array_compact(echo)) / n,
        "dup_lines": 1 - F.size(F.array_distinct("_l")) / lines,
        "sameness": 1 - F.size(F.array_distinct("_w")) / n,
    }
    vote = [
        F.when(F.size("_w") == 0, F.lit(0)).when(of[m] >= bad, F.lit(-1)).when(of[m] <= good, F.lit(1)).otherwise(F.lit(0))
        for m, bad, good in LABELLERS
    ]
    return rows.withColumn("votes", F.array(*vote)).drop("_t", "_w", "_l")


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> dict[tuple[int, ...], float]:
    """The posterior of "bad" per vote pattern, by expectation-maximisation over two classes.

    ``patterns`` is patterns x labellers of -1, 0, 1. It starts from "bad if anyone says bad";
    counts are smoothed by one. One assumption names the classes: a labeller says "bad" of at most
    a share ``MAX_FALSE`` of good documents. Fewer than two kinds of pattern still give a defined
    result.
    """
    if not len(patterns):
        return {}
    bad = np.where((patterns < 0).any(axis=1), 0.9, 0.1)
    hot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds):
        share = []
        for weight in (bad, 1 - bad):
            seen = np.einsum("p,plv->lv", counts * weight, hot) + 1
            share.append(seen / seen.sum(axis=1, keepdims=True))
        accused = np.minimum(share[1][:, :1], MAX_FALSE)
        share[1] = np.c_[accused, share[1][:, 1:] * (1 - accused) / share[1][:, 1:].sum(axis=1, keepdims=True)]
        prior = (counts @ bad + 1) / (counts.sum() + 2)
        odds = np.log(prior / (1 - prior)) + np.einsum("plv,lv->p", hot, np.log(share[0]) - np.log(share[1]))
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if np.abs(new - bad).max() < 1e-9:
            break
        bad = new
    return {tuple(int(v) for v in p): float(b) for p, b in zip(patterns, bad)}


def features(text: str | None) -> tuple[np.ndarray, float]:
    """Hashed features of a whole text: n-grams of character classes (runs of letters as one),
    as square roots of their shares, and buckets of how much words and lines repeat. Beside them
    the weight of the text's own features against those of a typical good text."""
    raw = (text or "").encode("utf-8", "replace")
    kinds = _CLASSES[np.frombuffer(raw, np.uint8)]
    letters = (kinds == ord("a")) | (kinds == ord("A"))
    keep = np.r_[True, ~(letters[1:] & (kinds[1:] == kinds[:-1]))] if len(kinds) else letters
    kinds = kinds[keep].astype(np.uint64)
    out = np.zeros(DIMS, np.float32)
    code = np.zeros(len(kinds), np.uint64)
    for g in range(1, GRAMS + 1):
        if len(kinds) < g:
            break
        code = code[: len(kinds) - g + 1] * np.uint64(257) + kinds[g - 1 :]
        slot = ((code + np.uint64(g << 40)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 12)
        out += np.sqrt(np.bincount(slot.astype(np.int64), minlength=DIMS) / len(code), dtype=np.float32)
    words, lines = (text or "").split(), [x for x in (text or "").split("\n") if x.strip()]
    if words:
        shares = (
            sum(map(str.__eq__, words, words[1:])) / len(words),
            1 - len(set(words)) / len(words),
            1 - len(set(lines)) / max(len(lines), 1),
        )
        for kind, share in enumerate(shares):
            step = (kind * (BUCKETS + 1) + int(share * BUCKETS) + 1) * 0x9E3779B1 % DIMS
            out[step] += 1
    return out, len(kinds) / (len(kinds) + TYPICAL)


def fit_scorer(x: np.ndarray, bad: np.ndarray, ridge: float = 1e-3, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated gradient steps; classes weigh alike."""
    if not len(x):
        return np.zeros(DIMS, np.float32), -1.0
    share = np.clip(bad.mean(), 1e-6, 1 - 1e-6)
    weight = bad / share + (1 - bad) / (1 - share)
    target = (bad / share) / weight
    weight = weight / weight.sum()
    step = 1 / (0.25 * float((x.astype(np.float64) ** 2).sum(axis=1).max() + 1) + ridge)
    w, b = np.zeros(x.shape[1]), 0.0
    aw, ab, momentum = w, b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ aw.astype(np.float32) + ab, -60, 60)))
        slope = weight * (p - target)
        nw, nb = aw - step * (slope.astype(np.float32) @ x + ridge * aw), ab - step * slope.sum()
        nm = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        aw, ab = nw + (momentum - 1) / nm * (nw - w), nb + (momentum - 1) / nm * (nb - b)
        w, b, momentum = nw, nb, nm
    return w.astype(np.float32), float(b)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Vote posteriors over all documents and the scorer trained on the bounded sample."""
    key = F.coalesce(F.xxhash64(F.col(id_col)), F.lit(0))
    rows = docs.select(key.alias("pick"), F.col(text_col).alias("text"))
    voted = cut(votes(rows, "text").select("pick", "votes"), "weak-votes")
    counted = voted.groupBy("votes").count().collect()  # at most 3 ** labellers rows
    patterns = np.array([list(r["votes"]) for r in counted], int).reshape(-1, len(LABELLERS))
    posterior = fit_votes(patterns, np.array([r["count"] for r in counted], float))
    chosen = []
    for side in (True, False):
        mine = [list(p) for p, b in posterior.items() if (b >= 0.5) == side]
        if mine:
            wanted = {"".join(map(str, p)) for p in mine}
            some = voted.where(F.array_join(F.col("votes").cast("array<string>"), "").isin(*sorted(wanted)))
            chosen += some.select("pick").distinct().orderBy("pick").limit(PER_CLASS).collect()
    picks = docs.sparkSession.createDataFrame([(r["pick"],) for r in chosen], "pick bigint")
    # At most 2 x PER_CLASS rows.
    sample = votes(rows.join(F.broadcast(picks), "pick", "left_semi"), "text").select("text", "votes", "pick")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = [features(t) for t in f["text"]]
            yield pd.DataFrame({
                "pick": f["pick"].to_numpy(), "bad": [posterior[tuple(int(v) for v in x)] for x in f["votes"]],
                "at": [np.flatnonzero(m).astype(np.int16).tobytes() for m, _ in made],
                "value": [m[m != 0].astype(np.float32).tobytes() for m, _ in made],
                "own": [own for _, own in made],
            })

    got = sample.mapInPandas(run, "pick bigint, bad double, at binary, value binary, own double")
    # One row per hash: repeated rows of a sampled id would pass the bound.
    got = got.dropDuplicates(["pick"]).orderBy("pick").collect()
    x = np.zeros((len(got), DIMS), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r["at"], np.int16)] = np.frombuffer(r["value"], np.float32)
    bad = np.array([r["bad"] for r in got], float)
    own = np.array([r["own"] for r in got], np.float32)[:, None]
    typical = x[bad < 0.5].mean(axis=0) if (bad < 0.5).any() else np.zeros(DIMS, np.float32)
    weights, bias = fit_scorer(own * x + (1 - own) * typical, bad)
    return {"posterior": posterior, "weights": weights, "bias": bias, "typical": float(typical @ weights)}


def score(docs: DataFrame, model: dict, text_col: str = "text", name: str = "p_bad") -> DataFrame:
    """``docs`` with the scorer's probability of "bad" for the whole text; a null text or one
    without a word has nothing to judge and gets 0."""
    weights, bias, typical = model["weights"], model["bias"], model["typical"]

    @F.pandas_udf("double")
    def p_bad(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None or not t.strip(BLANKS):
                return 0.0
            values, own = features(t)
            return float(1 / (1 + np.exp(-np.clip(own * (values @ weights) + (1 - own) * typical + bias, -60, 60))))

        return texts.map(one)

    return docs.withColumn(name, p_bad(F.col(text_col)))


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, p_bad, kept`` per row of ``docs``.

    Repeated rows are judged alike; null ids are allowed; an empty table gives no rows; other
    columns are not read.
    """
    model = train(docs, id_col, text_col)
    scored = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return scored.select("doc_id", "p_bad", (F.col("p_bad") < REJECT_FROM).alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows the classifier rejects; columns and order as they were.

    Repeated rows stay or go together; an empty table gives no rows.
    """
    model = train(docs, id_col, text_col)
    rows = docs.select(whole_row(docs), F.col(text_col).alias("text"))
    return score(rows, model).where(F.col("p_bad") < REJECT_FROM).select("_row.*")
