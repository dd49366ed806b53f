"""Operator 7: language identification with a string kernel.

The kernel of two texts is the number of n-grams (1 to ``GRAMS`` bytes, hashed to ``DIMS`` slots)
present in both, over the root of the product of their numbers: a blended-spectrum presence
kernel with unit diagonal. Landmarks are training texts; with the Nystroem feature map
``K(x, L) K(L, L)^(-1/2)`` ridge regression is solved once per language against the rest. A batch
of texts is scored as a presence matrix times landmarks times coefficients.

Training reads a bounded sample: per language the ``PER_LANGUAGE`` eligible documents with the
smallest id hash, of which the first ``LANDMARKS`` are landmarks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import cut

GRAMS = 4
DIM_BITS = 13
DIMS = 1 << DIM_BITS
PER_LANGUAGE = 400
LANDMARKS = 64
RIDGE = 1.0
BATCH = 256
UNKNOWN = "und"
SLICES = 64
# Training rows are collected, and landmarks travel with the model: so many in all, whatever the
# number of languages. With more than 40 languages each has fewer.
TRAIN_ROWS = 40 * PER_LANGUAGE
TRAIN_LANDMARKS = 40 * LANDMARKS

_SPACED = np.arange(256, dtype=np.uint8)
for _c in range(128):
    if not chr(_c).isalpha():
        _SPACED[_c] = 32


def presence(text: str | None) -> np.ndarray | None:
    """Which n-gram slots the whole lower-cased text has; None if it has no letter.

    What is not a letter in ASCII counts as one blank; other bytes stay.
    """
    if not text or not any(map(str.isalpha, text)):
        return None
    codes = _SPACED[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    codes = codes[np.r_[True, ~((codes[1:] == 32) & (codes[:-1] == 32))]].astype(np.uint64)
    out = np.zeros(DIMS, bool)
    gram = np.zeros(len(codes), np.uint64)
    for g in range(1, GRAMS + 1):
        if len(codes) < g:
            break
        gram = gram[: len(codes) - g + 1] * np.uint64(256) + codes[g - 1 :]
        out[((gram + np.uint64(g << 40)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - DIM_BITS)] = True
    return out


def held_out(id_col: str):
    """Whether crc32 of the id as text leaves 2 modulo 4; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(grams: np.ndarray, langs: list[str], landmark: np.ndarray) -> dict:
    """Kernel ridge regression, one language against the rest; languages in sorted order."""
    names = sorted(set(langs))
    if not names:
        return {"names": [], "landmarks": np.zeros((0, DIMS), np.float32), "coefficients": np.zeros((0, 0), np.float32)}
    unit = grams.astype(np.float32)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    marks = unit[landmark]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = (vectors[:, good] / np.sqrt(values[good])) @ vectors[:, good].T
    phi = (unit @ marks.T).astype(np.float64) @ root
    target = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weight = 1 / np.array([langs.count(x) for x in langs])  # languages weigh alike
    weight *= len(langs) / weight.sum()
    phi1 = np.c_[phi, np.ones(len(phi))]
    penalty = RIDGE * np.eye(phi1.shape[1])
    penalty[-1, -1] = 0
    beta = np.linalg.solve(phi1.T @ (weight[:, None] * phi1) + penalty + 1e-9 * np.eye(len(penalty)), phi1.T @ (weight[:, None] * target))
    return {"names": names, "landmarks": marks, "coefficients": root @ beta[:-1], "bias": beta[-1]}


def smallest_hashes(ids: DataFrame, most: int = PER_LANGUAGE) -> DataFrame:
    """``id, lang, rank`` of the ``most`` ids of each language with the smallest hashes.

    Ids are ranked per language and slice of the hash first, so a language that holds most rows is
    spread over ``SLICES`` tasks; what these leave, at most ``SLICES * most`` rows a language, is
    ranked again. Repeated ids are one.
    """
    h = F.xxhash64("id")
    sliced = ids.select("id", "lang", h.alias("h"), F.pmod(h, F.lit(SLICES)).alias("slice")).distinct()
    inner = Window.partitionBy("lang", "slice").orderBy("h", "id")
    few = sliced.withColumn("r", F.row_number().over(inner)).where(F.col("r") <= most)
    few = cut(few.select("id", "lang", "h"), "language-candidates")
    outer = Window.partitionBy("lang").orderBy("h", "id")
    return few.select("id", "lang", F.row_number().over(outer).alias("rank")).where(F.col("rank") <= most)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """Fit on the sample of documents with an id and a language that are not held out."""
    eligible = F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col)
    ids = docs.where(eligible).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"))
    names = max(1, ids.select("lang").distinct().count())
    if names > TRAIN_LANDMARKS:
        raise ValueError(f"{names} languages to learn, at most {TRAIN_LANDMARKS} are supported")
    marks = min(LANDMARKS, TRAIN_LANDMARKS // names)
    picked = smallest_hashes(ids, min(PER_LANGUAGE, TRAIN_ROWS // names))
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # At most TRAIN_ROWS rows.
    sample = rows.join(F.broadcast(picked), ["id", "lang"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = [presence(t) for t in f["text"]]
            f = f.assign(bits=[None if m is None else np.packbits(m).tobytes() for m in made])
            yield f.loc[f["bits"].notna(), ["id", "lang", "rank", "bits"]]

    got = sample.mapInPandas(run, "id bigint, lang string, rank int, bits binary")
    got = got.dropDuplicates(["id", "lang"]).orderBy("lang", "rank").collect()
    grams = np.array([np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in got], np.uint8).reshape(-1, DIMS)
    langs = [r["lang"] for r in got]
    seen: dict[str, int] = {}
    first = np.array([seen.setdefault(x, 0) < marks and not seen.update({x: seen[x] + 1}) for x in langs], bool)
    return fit(grams, langs, first)


def predict(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1: the regression value from -1 to 1, shifted).

    ``und`` and 0 for a null text, one without a letter, or a model without languages.
    """
    names, marks = model["names"], model["landmarks"].T.copy()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            best, value = np.full(len(f), UNKNOWN, object), np.zeros(len(f))
            for s in range(0, len(f) if names else 0, BATCH):
                made = [presence(t) for t in f[text_col].iloc[s : s + BATCH]]
                at = [i for i, m in enumerate(made) if m is not None]
                if not at:
                    continue
                x = np.array([made[i] for i in at], np.float32)
                kernel = (x @ marks) / np.sqrt(x.sum(axis=1, keepdims=True))
                scores = kernel @ model["coefficients"] + model["bias"]
                top = scores.argmax(axis=1)
                best[np.array(at) + s] = np.array(names, object)[top]
                value[np.array(at) + s] = np.clip((scores[np.arange(len(top)), top] + 1) / 2, 0, 1)
            yield f.drop(columns=[text_col]).assign(lang_pred=best, score=value)

    kept = [f for f in docs.schema.fields if f.name != text_col and f.name not in ("lang_pred", "score")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["lang_pred string", "score double"])
    return docs.select(*[f.name for f in kept], text_col).mapInPandas(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row of ``docs``.

    Repeated rows are predicted alike; a null id is not held out and not learned from; an empty
    table gives no rows; other columns are not read.
    """
    model = train(docs, id_col, text_col, lang_col)
    # A nullable integer column would reach pandas as floats; the id travels as text.
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return predict(rows, model).withColumn("doc_id", F.col("doc_id").cast("bigint"))
