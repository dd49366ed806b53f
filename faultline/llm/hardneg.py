"""Operator 11: hard negatives by Fagin's threshold algorithm.

A row's score for an anchor is the inner product of their integer vectors. Rows come in chunks.
For each dimension of a chunk its rows are sorted by component; an anchor walks these lists all
at once, from the top where its own component is positive and from the bottom where it is
negative. Rows met for the first time are scored by random access to their whole vector. A row
not yet met scores at most the threshold: the inner product of the anchor with the components that
are next in the lists. The walk stops once the threshold lies strictly below every score that a new
row would have to reach (strictly, as a tie may still win by its id).

There are two such searches: the best ``positives`` rows of the anchor's own label, where chunks
hold rows of one label, and then, per positive, the best ``negatives`` rows of other labels within
the positive's window of scores. A task holds a block of anchors with their best rows so far and
sees the rows of one group, chunk after chunk; bests of earlier chunks make later walks short.
Blocks and groups are of bounded size and equal by hash, whatever labels and vectors repeat, and
the bests of all groups are merged by ranked windows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import cut

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# Anchors of a block and rows of a chunk: held by a task. A group has at most about GROUP rows, and
# a block at least GROUPS groups, so that few anchors still make many tasks.
BLOCK = 16_384
CHUNK = 8192
GROUP = 1 << 20
GROUPS = 12
# Looks at the threshold: before the walk, after so many steps, then each time the depth has grown so.
FIRST = 8
STEP = 1.5
EXACT = 1 << 53
NONE = -(1 << 62)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """``id, label, vector`` of the rows that take part; of rows with one id the least stays."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        label.cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("id is not null and label is not null and vector is not null").where(~bad)
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*")
    return rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * SCALE).cast("double")))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width; missing components are 0, and there are at least ``width`` columns."""
    edges = vectors.offsets.to_numpy()
    sizes = np.diff(edges)
    flat = vectors.values.to_numpy(zero_copy_only=False)[edges[0] : edges[-1]]
    width = max(width, int(sizes.max(initial=0)))
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(edges[:-1] - edges[0], sizes)] = flat
    return out


class Chunk:
    """Rows with their sorted lists, one per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        self.ids, self.labels, self.matrix = ids, labels, matrix
        n = len(ids)
        self.rising = np.ascontiguousarray(np.argsort(matrix, axis=0, kind="stable").T.astype(np.int32))
        # Depths at which the threshold is looked at; at the last nothing is left unseen.
        depths = [0, min(n, FIRST)]
        while depths[-1] < n:
            depths.append(min(n, int(depths[-1] * STEP)))
        self.depths = depths
        at = np.minimum(np.array(depths), n - 1)
        values = np.take_along_axis(matrix, self.rising.T, axis=0)
        self.low, self.high = values[at], values[n - 1 - at]
        self.reach = np.abs(matrix).max(axis=0, initial=0.0)

    def thresholds(self, anchors: np.ndarray) -> np.ndarray:
        """Per anchor and depth: the inner product with the entries next in line. No row that is
        met only beyond that depth scores more."""
        out = np.maximum(anchors, 0) @ self.high.T + np.minimum(anchors, 0) @ self.low.T
        out[:, -1] = NONE
        return out

    def product(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return (self.matrix[rows] @ anchor).astype(np.int64)

    def walk(self, anchor: np.ndarray, limits: np.ndarray, start: int) -> Iterator[tuple[np.ndarray, int]]:
        """Rows first met and the threshold after them, from the look ``start`` on."""
        n, depth = len(self.ids), 0
        seen = np.zeros(n, bool)
        up, down = self.rising[anchor > 0], self.rising[anchor < 0]
        for look in range(start, len(self.depths)):
            to = self.depths[look]
            if to == n:
                new = ~seen
            else:
                new = np.zeros(n, bool)
                new[up[:, n - to : n - depth]] = True
                new[down[:, depth:to]] = True
                new &= ~seen
            seen |= new
            depth = to
            yield np.flatnonzero(new), limits[look]


def _check_exact(anchors: np.ndarray, chunk: Chunk) -> None:
    """Scores must be exact in doubles: else the components are too large for this operator."""
    if len(anchors) and float((np.abs(anchors) @ chunk.reach).max()) >= EXACT:
        raise ValueError("components are too large for exact integer scores")


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score))[:k]
    return score[order], ids[order]


class _Positives:
    """The best rows of an anchor's own label."""

    def __init__(self, k: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, scores: list):
        self.k, self.ids, self.labels, self.vectors = k, ids, labels, vectors
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]

    def see(self, chunk: Chunk) -> None:
        mine = np.flatnonzero(self.labels == chunk.labels[0])
        _check_exact(self.vectors[mine], chunk)
        for a, limits in zip(mine.tolist(), chunk.thresholds(self.vectors[mine])):
            anchor, (score, ids) = self.vectors[a], self.best[a]
            for rows, limit in chunk.walk(anchor, limits, 0):
                rows = rows[chunk.ids[rows] != self.ids[a]]
                score, ids = _best(np.r_[score, chunk.product(anchor, rows)], np.r_[ids, chunk.ids[rows]], self.k)
                if len(score) == self.k and limit < score[-1]:
                    break
            self.best[a] = score, ids

    def rows(self) -> Iterator[tuple]:
        for a, (score, ids) in zip(self.ids.tolist(), self.best):
            yield from ((a, 0, s, i) for s, i in zip(score.tolist(), ids.tolist()))


class _Negatives:
    """Per anchor and window of scores the best rows of other labels inside it."""

    def __init__(self, k: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, scores: list):
        self.k, self.ids, self.labels, self.vectors = k, ids, labels, vectors
        # A positive score p admits scores from ceil(50 p / 100) to floor(95 p / 100), if that is no less.
        self.windows = [[(p, -(-p // 2), 95 * p // 100) for p in sorted(set(s or [])) if -(-p // 2) <= 95 * p // 100] for s in scores]
        self.best = [[(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in w] for w in self.windows]

    def see(self, chunk: Chunk) -> None:
        _check_exact(self.vectors, chunk)
        for a, limits in enumerate(chunk.thresholds(self.vectors)):
            windows, best = self.windows[a], self.best[a]
            if not windows:
                continue
            # What a new row must reach to matter: the window's foot, or its kth score once it has k.
            need = [low if len(b[0]) < self.k else b[0][-1] for (_, low, _), b in zip(windows, best)]
            # No look can stop the walk while the threshold is at or above some window's top.
            start = int(np.argmax(limits < min(high for _, _, high in windows)))
            anchor = self.vectors[a]
            for rows, limit in chunk.walk(anchor, limits, start):
                rows = rows[chunk.labels[rows] != self.labels[a]]
                score, ids = chunk.product(anchor, rows), chunk.ids[rows]
                for w, (_, low, high) in enumerate(windows):
                    inside = (score >= need[w]) & (score <= high)
                    if inside.any():
                        best[w] = _best(np.r_[best[w][0], score[inside]], np.r_[best[w][1], ids[inside]], self.k)
                        need[w] = low if len(best[w][0]) < self.k else best[w][0][-1]
                if limit < min(need):
                    break

    def rows(self) -> Iterator[tuple]:
        for a, windows, best in zip(self.ids.tolist(), self.windows, self.best):
            for (p, _, _), (score, ids) in zip(windows, best):
                yield from ((a, p, s, i) for s, i in zip(score.tolist(), ids.tolist()))


OUT_SCHEMA = "anchor bigint, of bigint, score bigint, id bigint"


def _search(state, k: int, by_label: bool):
    """A task's rows come by block; in a block anchors (kind 0) first, then rows (kind 1), by label
    if chunks must hold one label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # anchors of the block, or rows of the chunk to come
        anchors, now = None, None

        def close() -> Iterator[pa.RecordBatch]:
            """The rows held so far are complete: anchors of a block, or a chunk."""
            nonlocal anchors, held
            if not held:
                return
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
            ids, labels = (table[c].to_numpy(zero_copy_only=False) for c in ("id", "label"))
            if now[1] == 0:
                anchors = state(k, ids, labels, _matrix(table["vector"], 0), table["scores"].to_pylist())
                return
            if anchors is None:
                return
            matrix = _matrix(table["vector"], anchors.vectors.shape[1])
            wide = matrix.shape[1] - anchors.vectors.shape[1]
            if wide:
                anchors.vectors = np.pad(anchors.vectors, ((0, 0), (0, wide)))
            for s in range(0, len(ids), CHUNK):
                anchors.see(Chunk(ids[s : s + CHUNK], labels[s : s + CHUNK], matrix[s : s + CHUNK]))

        def finish() -> Iterator[pa.RecordBatch]:
            nonlocal anchors
            if anchors is not None:
                found = list(anchors.rows())
                columns = [pa.array([r[c] for r in found], pa.int64()) for c in range(4)]
                yield pa.record_batch(columns, ["anchor", "of", "score", "id"])
            anchors = None

        for batch in batches:
            block, kind, label = (batch[c].to_numpy(zero_copy_only=False) for c in ("block", "kind", "label"))
            third = np.where(kind == 1, label, 0) if by_label else np.zeros_like(label)
            change = (block[1:] != block[:-1]) | (kind[1:] != kind[:-1]) | (third[1:] != third[:-1])
            starts = np.r_[0, np.flatnonzero(change) + 1, len(block)]
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                here = (int(block[s]), int(kind[s]), int(third[s]))
                if here != now:
                    close()
                    if now is not None and here[0] != now[0]:
                        yield from finish()
                    now = here
                held.append(batch.slice(s, e - s))
                if here[1] == 1 and sum(map(len, held)) >= CHUNK:
                    close()
        close()
        yield from finish()

    return run


def _dealt(rows: DataFrame, anchors: DataFrame, blocks: int, groups: int, by_label: bool) -> DataFrame:
    """Every block of anchors beside every row, block by group: anchors go to all groups of their
    block, rows to their group of every block."""
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks))).select("*", spread(groups).alias("g"))
    r = rows.withColumn("g", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(groups))).select("*", spread(blocks).alias("b"))
    names = [(F.col("b") * groups + F.col("g")).cast("int").alias("block")]
    a = a.select(*names, F.lit(0).alias("kind"), "id", "label", "vector", "scores")
    r = r.select(*names, F.lit(1).alias("kind"), "id", "label", "vector", F.lit(None).cast("array<bigint>").alias("scores"))
    order = ["block", "kind", "label"] if by_label else ["block", "kind"]
    return a.union(r).repartitionById(blocks * groups, "block").sortWithinPartitions(*order)


def hard_negatives(
    vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    label: Column | str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows of which ``anchor`` (over a column ``id``) is true. Rows with a null id, a
    null label, a null vector, or a null or non-finite component take no part. Of repeated rows
    under one id one takes part (the least label, then vector). Shorter vectors count as ended by
    zeros. Equal scores rank by smaller id. An anchor with fewer other rows of its label has fewer
    positives, a window with fewer rows fewer negatives; an empty table or one without anchors gives
    no rows; other columns are not read. Scores that would not be exact raise ``ValueError``.
    """
    rows = cut(usable(vectors, id_col, vector_col, F.col(label) if isinstance(label, str) else label), "vectors")
    chosen = rows.where(anchor)
    n_rows, n_anchors = rows.count(), chosen.count()
    blocks, groups = max(1, math.ceil(n_anchors / BLOCK)), max(GROUPS, math.ceil(n_rows / GROUP))
    plain = chosen.withColumn("scores", F.lit(None).cast("array<bigint>"))
    near = _dealt(rows, plain, blocks, groups, True).mapInArrow(_search(_Positives, positives, True), OUT_SCHEMA)
    order = [F.desc("score"), F.asc("id")]
    first = near.withColumn("r", F.row_number().over(Window.partitionBy("anchor").orderBy(*order)))
    first = cut(first.where(F.col("r") <= positives).select("anchor", F.col("id").alias("positive"), "score"), "positives")
    # At most ``positives`` scores per anchor.
    known = first.groupBy("anchor").agg(F.sort_array(F.collect_set("score")).alias("scores"))
    asking = chosen.join(known.withColumnRenamed("anchor", "id"), "id").select("id", "label", "vector", "scores")
    far = _dealt(rows, asking, blocks, groups, False).mapInArrow(_search(_Negatives, negatives, False), OUT_SCHEMA)
    best = far.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "of").orderBy(*order)))
    best = best.where(F.col("rank") <= negatives).select("anchor", "of", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    found = first.withColumnRenamed("score", "of").join(best, ["anchor", "of"])
    return found.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", "negative_id",
        F.col("of").alias("positive_score"), "negative_score",
    )


