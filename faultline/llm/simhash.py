"""Operator 1: near-duplicates by SimHash fingerprints and pigeonhole blocks.

Two fingerprints that differ in at most ``max_bits`` bits agree on ``k`` of ``max_bits + k``
blocks of bits, whichever bits differ. So every fingerprint is dealt once for each choice of
``k`` blocks, under the bits of that choice; fingerprints under one key are compared and the
Hamming distance decides. Work is on distinct fingerprints; copies follow their fingerprint.

The rows of one key are compared in their task in blocks of numpy rows and leave as a spanning
forest (at most one link fewer than rows), never as all pairs. A key with more than
``HOT_KEY`` distinct fingerprints is not compared there: its rows leave marked, are cut into
chunks, and each pair of chunks becomes a group of its own, so no task holds or compares more
than about ``HOT_KEY`` rows at a time and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import cut, partitions, whole_row
from faultline.llm.components import components

HASH_SEED = 42
HOT_KEY = 16_384
SMALL_RUN = 8
COMPARE_ROWS = 128


def text_fingerprint(text: str | None, shingle: int = 4) -> int:
    """The 64-bit fingerprint: a bit is 1 if over half the shingle hashes have it.

    A-Z is lower-cased; fewer words than ``shingle`` are one shingle; no word gives 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        hashes = digest(whole, HASH_SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[:-shingle].tolist()]
        hashes = b"".join([digest(whole[i:j], HASH_SEED) for i, j in zip(starts, (ends[shingle - 1 :] - 1).tolist())])
    n = len(hashes) // 8
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(n, 8), axis=1)
    whole_rows = n // 255 * 255
    counts = bits[whole_rows:].sum(axis=0, dtype=np.int64)
    if whole_rows:
        counts += bits[:whole_rows].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, fp)`` per row of ``docs``; ``fp`` is the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((text_fingerprint(t.as_py(), shingle) for t in batch["text"]), np.uint64, len(batch))
            columns = [batch["doc_id"], batch["text_hash"], pa.array(found.view(np.int64))]
            yield pa.record_batch(columns, ["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def block_masks(max_bits: int, shared: int) -> list[int]:
    """The masks (signed) of every choice of ``shared`` blocks among ``max_bits + shared``."""
    n = max_bits + shared
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    masks = [sum(choice) for choice in combinations(blocks, shared)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def shared_blocks(rows: int, max_bits: int) -> int:
    """The fewest shared blocks whose keys have about as many values as there are rows.

    A plan choice: any number gives the same links, more blocks mean fewer false candidates
    and more copies of each row.
    """
    for k in range(2, 9):
        if 64 * k // (max_bits + k) >= log2(max(rows, 2)):
            return k
    return 8


def _spanning_links(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is within ``max_bits``: each row is reached once, from a row already reached."""
    out, rest = [], fps
    while len(rest):
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            reached = []
            for i in range(0, len(front), COMPARE_ROWS):
                if not len(rest):
                    break
                part = front[i : i + COMPARE_ROWS]
                near = np.bitwise_count(part[:, None] ^ rest[None, :]) <= max_bits
                hit = near.any(axis=0)
                out.append((part[near[:, hit].argmax(axis=0)], rest[hit]))
                reached.append(rest[hit])
                rest = rest[~hit]
            front = np.concatenate(reached) if reached else rest[:0]
    return out


def _links_of_runs(run: np.ndarray, fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """``run`` numbers the groups of consecutive rows; links inside each group."""
    out = []
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    sizes = np.diff(np.r_[starts, len(run)])
    for s, n in zip(starts[sizes > SMALL_RUN].tolist(), sizes[sizes > SMALL_RUN].tolist()):
        out += _spanning_links(np.unique(fps[s : s + n]), max_bits)
    small = np.repeat((sizes > 1) & (sizes <= SMALL_RUN), sizes)
    run, fps = run[small], fps[small]
    for d in range(1, SMALL_RUN):
        near = (run[d:] == run[:-d]) & (np.bitwise_count(fps[d:] ^ fps[:-d]) <= max_bits)
        out.append((fps[:-d][near], fps[d:][near]))
    return out


def _compare(max_bits: int, hot: int | None):
    """A task's part of the join: rows sorted by key in, links out (``tab`` null) and, marked by
    their ``tab`` and ``key``, the rows of keys with more than ``hot`` rows."""
    names = ["tab", "key", "a", "b"]

    def links(found) -> pa.RecordBatch:
        a = np.concatenate([x for x, _ in found] or [np.empty(0, np.uint64)]).view(np.int64)
        b = np.concatenate([x for _, x in found] or [np.empty(0, np.uint64)]).view(np.int64)
        none = pa.nulls(len(a))
        return pa.record_batch([none.cast(pa.int32()), none.cast(pa.int64()), pa.array(a), pa.array(b)], names)

    def marked(tab, key, fps) -> pa.RecordBatch:
        return pa.record_batch([pa.array(tab), pa.array(key), pa.array(fps), pa.nulls(len(fps)).cast(pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, flood = [np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)], None
        for batch in batches:
            tab, key, fps = (
                np.concatenate([h, batch[c].to_numpy(zero_copy_only=False)]) for h, c in zip(held, ("tab", "key", "fp"))
            )
            if flood is not None:
                more = (tab == flood[0]) & (key == flood[1])
                yield marked(tab[more], key[more], fps[more])
                tab, key, fps = tab[~more], key[~more], fps[~more]
            if not len(tab):
                held = [tab, key, fps]
                continue
            new = np.r_[True, (tab[1:] != tab[:-1]) | (key[1:] != key[:-1])]
            number = np.cumsum(new)
            sizes = np.bincount(number)
            if hot is not None and (sizes > hot).any():
                big = (sizes > hot)[number]
                yield marked(tab[big], key[big], fps[big])
                flood = (tab[-1], key[-1]) if big[-1] else None
                tab, key, fps, number = tab[~big], key[~big], fps[~big], number[~big]
            elif flood is not None and (tab[-1], key[-1]) != flood:
                flood = None
            last = int(np.searchsorted(number, number[-1])) if len(number) else 0
            yield links(_links_of_runs(number[:last], fps[:last].view(np.uint64), max_bits))
            held = [tab[last:], key[last:], fps[last:]]
        if len(held[0]):
            yield links(_links_of_runs(np.zeros(len(held[0]), np.int64), held[2].view(np.uint64), max_bits))

    return run


LINK_SCHEMA = "tab int, key bigint, a bigint, b bigint"


def fingerprint_links(fps: DataFrame, max_bits: int = 4, hot_key: int = HOT_KEY, blocks: int | None = None) -> DataFrame:
    """``(a, b)`` links between the distinct fingerprints of column ``fp`` that connect every
    pair within ``max_bits`` bits (directly or through other such links)."""
    spark = fps.sparkSession
    n = partitions(spark)
    masks = block_masks(max_bits, blocks or shared_blocks(fps.count(), max_bits))
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])
    dealt = fps.select("fp", F.posexplode(keys).alias("tab", "key"))
    dealt = dealt.repartition(n, "tab", "key").sortWithinPartitions("tab", "key").select("tab", "key", "fp")
    found = cut(dealt.mapInArrow(_compare(max_bits, hot_key), LINK_SCHEMA), "simhash-links")
    links, hot = found.where("tab is null").select("a", "b"), found.where("tab is not null")
    if hot.isEmpty():
        return links
    chunks = hot.groupBy("tab", "key").agg(F.ceil(2 * F.count(F.lit(1)) / hot_key).cast("int").alias("n"))
    # At most (rows x masks / HOT_KEY) hot keys; the join is by key and left to adaptive execution.
    own = hot.join(chunks, ["tab", "key"]).withColumn("c", F.pmod(F.xxhash64("a"), F.col("n")).cast("int"))
    pairs = own.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("o"))
    group = F.xxhash64("tab", "key", F.least("c", "o"), F.greatest("c", "o"))
    pairs = pairs.select(F.lit(0).alias("tab"), group.alias("key"), F.col("a").alias("fp"))
    pairs = pairs.repartition(n, "key").sortWithinPartitions("tab", "key")
    more = cut(pairs.mapInArrow(_compare(max_bits, None), LINK_SCHEMA), "simhash-hot-links")
    return links.union(more.select("a", "b"))


def near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id, text_hash, keep``.

    ``fingerprint`` is 16 hex digits. ``component_id`` is the smallest id reachable over links
    of at most ``max_bits`` differing bits (null if no row of the component has an id).
    ``keep`` is true for the one document of the component that a filter keeps: the smallest id,
    then the smallest hash of the text (rows without an id come last). It is true for all repeats
    of that document. Null texts count as empty and have fingerprint zero; repeated rows fall into
    one component; an empty table gives no rows; other columns are not read.
    """
    rows = cut(fingerprints(docs, shingle, id_col, text_col), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    nodes = rows.groupBy("fp").agg(first).checkpoint()
    linked = components(fingerprint_links(nodes, max_bits), "a", "b")
    of = nodes.join(linked.toDF("fp", "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = of.groupBy("root").agg(F.min("first").alias("first"))
    of = of.select("fp", "root").join(best, "root").select("fp", "first")
    # Rows of one fingerprint may be a large part of all rows; the other side is unique, so a
    # split of the hot partition is safe and adaptive execution makes it.
    out = rows.join(of, "fp")
    keep = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return out.select("doc_id", fingerprint, F.col("first.doc_id").alias("component_id"), "text_hash", keep.alias("keep"))


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row left of each component: the one with the smallest id.

    Of different texts with that id the one with the smallest hash stays, of repeated rows one.
    Columns and their order are those of ``docs``.
    """
    keep = near_duplicates(docs, shingle, max_bits, id_col, text_col).where("keep")
    keep = keep.select(F.col("doc_id").alias("_k"), F.col("text_hash").alias("_h")).distinct()
    keyed = docs.select(whole_row(docs), F.col(id_col).cast("bigint").alias("_id"), F.xxhash64(text_col).alias("_hash"))
    same = F.col("_id").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h"))
    return keyed.join(keep, same, "left_semi").dropDuplicates(["_id", "_hash"]).select("_row.*")
