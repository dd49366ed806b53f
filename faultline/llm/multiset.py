"""Operator 3: document fingerprints by a homomorphic multiset hash. DataFrame functions only.

A paragraph (a line) is hashed into a vector, and a text's fingerprint is the sum of the vectors
of its paragraphs, lane by lane modulo 2**56. So the order of paragraphs does not matter, and
paragraphs are inserted or deleted by adding or subtracting their vectors. The lanes:

- ``STRONG`` lanes: hashes of the whole paragraph. They decide equality.
- 32 sketch lanes: the paragraph is cut into pieces of ``PIECE_WORDS`` words, each hashed to 64
  bits; lane j counts, in two fields, the pieces with bit j and with bit j + 32 set.
- one lane with the number of pieces.

With n pieces, ``2 * count - n`` per bit is a 64-dimensional random sign projection of the
multiset of pieces, so squared distances between two fingerprints estimate how many pieces
differ: ``likeness`` is one minus that share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import cut, materialised, running, whole_row

STRONG = 4
SKETCH = 32
PIECE_WORDS = 8
MODULUS_MASK = (1 << 56) - 1
FIELDS_MASK = (1 << 32) + 1
COUNT_MASK = (1 << 32) - 1
PIECE_PATTERN = r"[^\n\x20\x09\x0B-\x0D]+(?:[\x20\x09\x0B-\x0D]+[^\n\x20\x09\x0B-\x0D]+){0,%d}" % (PIECE_WORDS - 1)
NULL_KEY = -(1 << 63)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def piece_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(PIECE_PATTERN), F.lit(0)), lambda p: F.xxhash64(p))


def _sum(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: (acc + of(x)).bitwiseAND(F.lit(MODULUS_MASK)))


def paragraph_sum(lines: Column, hashes: Column) -> Column:
    """The vector of a list of paragraphs, given as a column, and the hashes of their pieces.

    Each strong lane hashes the paragraph itself from a seed of its own (the hash of the lane's
    number), so paragraphs that agree in one lane are no more alike in the others.
    """
    strong = [_sum(lines, lambda p, j=j: F.xxhash64(F.lit(j), p).bitwiseAND(F.lit(MODULUS_MASK))) for j in range(STRONG)]
    sketch = [
        _sum(hashes, lambda h, j=j: F.shiftrightunsigned(h, j).bitwiseAND(F.lit(FIELDS_MASK))) for j in range(SKETCH)
    ]
    return F.array(*strong, *sketch, F.size(hashes).cast("bigint"))


def insert(vector: Column, paragraphs: Column) -> Column:
    return F.zip_with(vector, paragraphs, lambda a, b: (a + b).bitwiseAND(F.lit(MODULUS_MASK)))


def delete(vector: Column, paragraphs: Column) -> Column:
    return F.zip_with(vector, paragraphs, lambda a, b: (a - b).bitwiseAND(F.lit(MODULUS_MASK)))


def to_string(vector: Column) -> Column:
    """14 hex digits per lane."""
    return F.array_join(F.transform(vector, lambda x: F.lower(F.lpad(F.hex(x), 14, "0"))), "")


def _signed(vector: Column) -> Column:
    """The 64 sign sums behind the sketch lanes."""
    n = F.element_at(vector, -1)
    lanes = F.slice(vector, STRONG + 1, SKETCH)
    low = F.transform(lanes, lambda x: F.lit(2) * x.bitwiseAND(F.lit(COUNT_MASK)) - n)
    high = F.transform(lanes, lambda x: F.lit(2) * F.shiftrightunsigned(x, 32) - n)
    return F.transform(F.concat(low, high), lambda x: x.cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: one for equal fingerprints, else the estimated share of pieces in common."""
    square = lambda acc, x: acc + x * x
    zero = F.lit(0.0)
    x, y = _signed(a), _signed(b)
    apart = F.aggregate(F.zip_with(x, y, lambda p, q: p - q), zero, square)
    whole = F.aggregate(x, zero, square) + F.aggregate(y, zero, square)
    near = F.when(whole > 0, F.greatest(zero, F.least(F.lit(1.0), 1 - apart / whole))).otherwise(zero)
    return F.when(a == b, F.lit(1.0)).otherwise(near)


def fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the vector of the whole text in column ``name`` (a null text is empty).

    A column of that name is replaced; all others stay, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = materialised(docs.select(whole_row(docs), text.alias("_text")), "_hashes", piece_hashes(F.col("_text")))
    kept = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c != name]
    return hashed.select(*kept, paragraph_sum(lines_of(F.col("_text")), F.col("_hashes")).alias(name))


def _neighbours(rows: DataFrame) -> DataFrame:
    """``(prev_key, key, need)``: each key after another in ascending order, the first after the
    last, and how many code points of its text the one before takes."""
    keys = rows.groupBy("key").agg(F.max(F.floor(F.length("text") / 4)).cast("int").alias("need"))
    placed = cut(running(keys, [F.col("key")], [], "multiset-order"), "multiset-keys")
    n = placed.count()
    ahead = placed.select(F.col("key").alias("prev_key"), "need", ((F.col("pos") + 1) % F.lit(max(n, 1))).alias("pos"))
    return ahead.join(placed.select("pos", "key"), "pos").select("prev_key", "key", "need")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has the last ``floor(n_chars / 4)`` code points replaced by the first as many
    (or all) of the next document by id (after the last: the first). Its fingerprint comes from
    the text's by the homomorphism: paragraphs that stay whole are hashed once, for both; those of
    the old end are left out, those of the new end inserted.

    Texts are shuffled once, by id; of the next document only the part taken travels. Null ids
    count as smaller than all others; rows that repeat an id share their place in the order,
    and where such rows differ the smaller beginning and fingerprint stand for the next document.
    Null texts are empty. Returns ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``; an empty table gives no rows.
    """
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_KEY))
    rows = docs.select(key.alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    after = _neighbours(rows)
    heads = rows.join(after, "key").select(
        F.col("prev_key"), F.col("key").alias("next_key"), F.expr("substring(text, 1, need)").alias("head")
    )
    heads = heads.groupBy("prev_key", "next_key").agg(F.min("head").alias("head"))
    joined = rows.join(heads.withColumnRenamed("prev_key", "key"), "key")

    n = F.length("text")
    joined = joined.withColumn("n_chars", n.cast("bigint")).withColumn("stay", (n - F.floor(n / 4)).cast("int"))
    # ``head`` may be longer than this row needs if another row of the same id is longer.
    joined = joined.withColumn("head", F.expr("substring(head, 1, cast(n_chars as int) - stay)"))
    joined = joined.withColumn("front", F.expr("substring(text, 1, stay)"))
    joined = joined.withColumn("open", F.substring_index("front", "\n", -1))
    whole = F.col("stay") - F.length("open")
    parts = joined.select(
        "key", "next_key", "n_chars",
        F.sha2(F.concat("front", "head"), 256).alias("edited_sha256"),
        F.when(whole > 0, F.expr("substring(front, 1, stay - length(open) - 1)")).alias("same"),
        F.substring(F.col("text"), whole + 1, n).alias("old"),
        F.concat("open", "head").alias("new"),
    )
    for part in ("same", "old", "new"):
        parts = materialised(parts, f"h_{part}", piece_hashes(F.coalesce(part, F.lit(""))))
        lines = F.when(F.col(part).isNull(), F.array().cast("array<string>")).otherwise(lines_of(F.col(part)))
        parts = parts.withColumn(f"v_{part}", paragraph_sum(lines, F.col(f"h_{part}"))).drop(f"h_{part}")
    table = cut(
        parts.select(
            "key", "next_key", "n_chars", F.unhex("edited_sha256").alias("sha"),
            insert(F.col("v_same"), F.col("v_old")).alias("fp"), insert(F.col("v_same"), F.col("v_new")).alias("edited"),
        ),
        "multiset",
    )
    following = table.groupBy(F.col("key").alias("next_key")).agg(F.min("fp").alias("next_fp"))
    out = table.join(following, "next_key")
    return out.select(
        F.when(F.col("key") != NULL_KEY, F.col("key")).alias("doc_id"), "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"), to_string(F.col("fp")).alias("fingerprint"),
        to_string(F.col("edited")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
