"""Operator 13: ranked lexical search, reversed: documents stream through an index of the items.

Items are the standing side. Their terms form an inverted index (term to the items that hold it),
which is broadcast; documents pass through it once, as counts of the terms that any item holds:

1. one pass over the texts writes each document's length and its counts of the items' terms;
   collection figures (documents, terms, document frequencies) are sums over that table;
2. the counts are streamed through the index. A task holds, per item, a heap of the best
   documents seen so far (at most ``k``); only documents that beat an item's worst enter;
3. the heaps of all tasks are merged per item by a ranked window.

The index is broadcast only up to ``MAX_POSTINGS`` entries and ``MAX_ITEMS`` items. More are dealt into as many
blocks as that takes, and the documents pass once per block, each with a broadcast of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import cut

# Entries of one broadcast index; an entry takes under 100 bytes.
MAX_POSTINGS = 500_000
# Items of one index: a task's heaps take under 1 kB each.
MAX_ITEMS = 50_000
K = 20
GROUP_ROWS = 1024
# Cells of the table of scores that a task fills at a time, and postings it expands at a time.
CELLS = 1 << 20
ITEM_SCHEMA = "item bigint, term binary, repeats bigint"
COUNT_SCHEMA = "doc_id bigint, n_terms bigint, terms array<int>, counts array<int>"
HEAP_SCHEMA = "item int, score bigint, doc_id bigint"

# Upper-case ASCII letters become lower case; other ASCII characters that are no letter or digit part terms.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a whole text in UTF-8: runs of letters, digits and characters beyond ASCII."""
    return text.translate(_TABLE).split() if text else []


def weight(n_docs: int, doc_frequency: int) -> int:
    """How much a term counts; 0 for no documents."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * doc_frequency + 1)))


def _postings(items: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Distinct items with a number of their own, and ``item, term, repeats`` of all their terms."""
    distinct = items.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
    # A number without one task for all items: the partition's number and the row's in it; written
    # once, so that it never changes.
    numbered = cut(distinct.withColumn("item", F.monotonically_increasing_id()), "search-items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch["item"], batch["text"]):
                found = Counter(terms(text.as_py()))
                if found:
                    columns = [pa.array([item.as_py()] * len(found)), pa.array(list(found)), pa.array(list(found.values()))]
                    yield pa.record_batch(columns, ["item", "term", "repeats"])

    rows = numbered.select("item", F.col("text").cast("binary").alias("text"))
    return numbered, cut(rows.mapInArrow(run, ITEM_SCHEMA), "search-postings")


def _counts(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Per document its number of terms and the counts of those in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        # A few documents at a time: counts as Python objects are large.
        for batch in (b.slice(s, GROUP_ROWS) for b in batches for s in range(0, len(b), GROUP_ROWS)):
            sizes, held, counts = [], [], []
            for text in batch["text"]:
                words = terms(text.as_py())
                found = Counter(words)
                known = [(number[t], n) for t, n in found.items() if t in number]
                sizes.append(len(words))
                held.append([t for t, _ in known])
                counts.append([n for _, n in known])
            columns = [batch["doc_id"], pa.array(sizes, pa.int64()), *(pa.array(c, pa.list_(pa.int32())) for c in (held, counts))]
            yield pa.record_batch(columns, ["doc_id", "n_terms", "terms", "counts"])

    return cut(docs.mapInArrow(run, COUNT_SCHEMA), "search-counts")


class _Heaps:
    """The best ``k`` documents of each item: highest score, then smallest id, ids before null."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.item, self.score, self.doc, self.none = (np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))
        self.worst = np.zeros(n_items, np.int64)  # scores must be above 0, and no worse than this once full

    def offer(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        item, score = np.r_[self.item, item], np.r_[self.score, score]
        doc, none = np.r_[self.doc, doc], np.r_[self.none, none]
        order = np.lexsort((doc, none, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order, kept = order[place < self.k], item[place < self.k]
        self.item, self.score, self.doc, self.none = kept, score[order], doc[order], none[order]
        last = np.flatnonzero(place[place < self.k] == self.k - 1)
        self.worst[kept[last]] = self.score[last]


def _search_block(counts: DataFrame, index: dict, k: int) -> DataFrame:
    """The heaps of all tasks: ``item, score, doc_id``, with items by their place in the block."""
    shared = counts.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        first, item, repeats, weights, n_items = ix["first"], ix["item"], ix["repeats"], ix["weight"], ix["n_items"]
        heaps = _Heaps(n_items, k)

        def offer(size, doc, none, row, term, count) -> None:
            """Documents ``0..``, and their counts by ``row``: scores in a table, the best into the heaps."""
            m = 75 + (25 * size * ix["docs"]) // ix["length"]
            worth = weights[term] * ((1_000_000_000 * count) // (1000 * count + 12 * m[row]))
            n = first[term + 1] - first[term]
            at = np.repeat(first[term] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            cell = np.repeat(row, n) * n_items + item[at]
            value = np.repeat(worth, n) * repeats[at]
            # Two sums of doubles, each exact far beyond what a text can hold, are a sum of longs.
            cells = len(size) * n_items
            low = np.bincount(cell, value & 0xFFFFFF, cells).astype(np.int64)
            score = (np.bincount(cell, value >> 24, cells).astype(np.int64) << 24) + low
            hit = np.flatnonzero((score > 0) & (score.reshape(-1, n_items) >= heaps.worst).ravel())
            if len(hit):
                heaps.offer(hit % n_items, score[hit], doc[hit // n_items], none[hit // n_items])

        rows = max(1, CELLS // n_items)
        for batch in batches:
            size = batch["n_terms"].to_numpy(zero_copy_only=False)
            none = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
            doc = batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
            held, tally = batch["terms"], batch["counts"]
            edges = held.offsets.to_numpy().astype(np.int64)
            term = held.values.to_numpy(zero_copy_only=False)
            tally_from = tally.offsets.to_numpy()[0] - edges[0]
            count = tally.values.to_numpy(zero_copy_only=False).astype(np.int64)
            # Postings up to each document's start, to cut groups by what they expand to.
            reach = np.r_[0, np.cumsum(first[term + 1] - first[term])][edges]
            a = 0
            while a < len(size):
                fits = np.searchsorted(reach, reach[a] + CELLS, side="right") - 1
                b = max(a + 1, min(int(fits), a + rows, len(size)))
                s, e = edges[a], edges[b]
                row = np.repeat(np.arange(b - a), np.diff(edges[a : b + 1]))
                offer(size[a:b], doc[a:b], none[a:b], row, term[s:e], count[s + tally_from : e + tally_from])
                a = b
        doc_id = pa.array(heaps.doc, pa.int64(), mask=heaps.none)
        yield pa.record_batch([pa.array(heaps.item.astype(np.int32)), pa.array(heaps.score), doc_id], ["item", "score", "doc_id"])

    return counts.where("size(terms) > 0").mapInArrow(run, HEAP_SCHEMA)


def search(
    docs: DataFrame, items: DataFrame, k: int = K, max_postings: int = MAX_POSTINGS,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    Equal scores rank by ascending id, a null id last. Whole texts count; a null text has no
    terms, and an item without terms no rows. Every row of ``docs`` is a document, repeated rows
    too; repeated items are one, and different texts under one item id are ranked each for itself.
    An empty table on either side gives no rows; other columns are not read. One item's postings
    are never cut, so a single item above ``max_postings`` is a block of its own.
    """
    spark = docs.sparkSession
    numbered, postings = _postings(items, item_col, item_text_col)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    size = postings.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("item").alias("items")).first()
    blocks = max(1, math.ceil(size["n"] / max_postings), math.ceil(size["items"] / MAX_ITEMS))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    out = None
    for b in range(blocks):
        rows = postings.where(block == b).orderBy("term", "item").collect()
        if not rows:
            continue
        vocabulary = sorted({bytes(r["term"]) for r in rows})
        number = {t: i for i, t in enumerate(vocabulary)}
        names = sorted({r["item"] for r in rows})
        place = {x: i for i, x in enumerate(names)}
        counts = _counts(texts, vocabulary)
        totals = counts.agg(F.count_if(F.col("n_terms") > 0).alias("n"), F.sum("n_terms").alias("l")).first()
        if not totals["l"]:
            break
        held = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()
        frequency = {r["term"]: r["n"] for r in held}
        owner = np.array([number[bytes(r["term"])] for r in rows])
        index = {
            "first": np.searchsorted(owner, np.arange(len(vocabulary) + 1)),
            "item": np.array([place[r["item"]] for r in rows], np.int64),
            "repeats": np.array([r["repeats"] for r in rows], np.int64),
            "weight": np.array([weight(totals["n"], frequency.get(i, 0)) for i in range(len(vocabulary))], np.int64),
            "n_items": len(names), "docs": totals["n"], "length": totals["l"],
        }
        heaps = _search_block(counts, index, k)
        # At most one row per item of the block.
        keys = spark.createDataFrame(pa.table({"item": pa.array(range(len(names)), pa.int32()), "number": pa.array(names, pa.int64())}))
        found = heaps.join(F.broadcast(keys), "item").select(F.col("number").alias("item"), "score", "doc_id")
        out = found if out is None else out.unionByName(found)
    schema = f"item_id {dict(numbered.dtypes)['item_id']}, rank int, doc_id bigint, score bigint"
    if out is None:
        return spark.createDataFrame([], schema)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
