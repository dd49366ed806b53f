from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, fp int, size string, `_n` int, stratum int, rule string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(doc_id, text, lang, source)``, with columns whose names the operators use inside."""

    def run(rows):
        full = [(i, t, g, s, None if t is None else len(t), "x", 7, "y", 1, 3, "z") for i, t, g, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return run


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, near and exact copies."""
    r = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "river", "stone", "über", "naïve", "the", "of", "And", "run."]
    prose = lambda n: " ".join(r.choice(words) + str(r.randrange(40)) for _ in range(n))
    base = prose(300)
    near = [base.replace(" ", "\n", k) for k in range(3)] + [base + " one more tail", base.upper()]
    rows = [(i, prose(r.randrange(1, 120)), ["en", "de"][i % 2], f"s{i % 3}") for i in range(30)]
    rows += [(100 + i, t, "en", "s0") for i, t in enumerate(near)]
    rows += [(200, None, "en", "s1"), (201, "", None, None), (202, " \n\t ", "de", "s2"), (None, base, "en", "s0")]
    rows += [(None, "lonely text without any id", None, None), (203, "word", "en", "s1"), (203, "word", "en", "s1")]
    rows += [(204, prose(20_000), "en", "s1"), (205, "x" * 50_000, "de", "s0"), (0, rows[0][1], rows[0][2], rows[0][3])]
    rows += [(206, "line one here\n" * 40 + prose(60), "en", "s2"), (207, "mail a.b@c.de or +1 (974) 555-3436 now", "en", None)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(make, edge_rows):
    return make(edge_rows)


@pytest.fixture(scope="session")
def no_docs(make):
    return make([])


def text_of(row):
    return row[1] or ""
