"""Operator 10: mixing sources to target weights by Pareto order sampling.

Sources get targets in words by weight, each at most a multiple of its size; what exceeds that is
shared out again by weight. A source that must give ``f`` times its words takes every document
``floor(f)`` times for certain. The rest is a fixed-size sample with unequal probabilities: a
document's inclusion probability is proportional to its words, ``min(1, c * words)``, with c set per
source so that the expected words are those still needed; documents whose probability reaches 1 are
certain. Documents are ranked by ``[u / (1 - u)] / [p / (1 - p)]`` with u a hash of the row, the
smallest first, until the words still needed are reached; the last document goes in if that comes
closer to the target.

c follows from counts per source and size: with sizes in descending order, the certain ones are a
prefix. The threshold of each source is computed from an order in three steps: word sums of the rank
in ``BINS`` bins (partial sums per task, whatever the source's size), the same inside the one bin
where the target is reached, then sums per rank inside that one's bin. Whether a document is taken
depends on its own row and its source's c and threshold, so texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import cut, running, whole_row, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BINS = 4096
SEED = 20
SMALL_ROWS = 100_000


def uniform(*columns: Column, seed: int = SEED) -> Column:
    """A number between 0 and 1, both excluded, from a hash: the same on every run."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12)
    return (h.cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from rows of ``source, size``.

    Sources in code-point order, null last, get the weights in turn. Targets share ``share`` times
    all words by weight, none above ``most`` times its source's words: the level L with
    ``sum(min(L * weight, cap))`` equal to the total is found among the sources sorted by
    cap / weight, from running sums.
    """
    of = cut(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    placed = running(of, [F.col("source").asc_nulls_last()], [], "mix-order")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    caps = placed.select("source", "source_size", turn.alias("weight"), (F.col("source_size") * F.lit(most)).alias("cap"))
    caps = cut(caps.withColumn("ratio", F.col("cap") / F.col("weight")), "mix-caps")
    total = caps.agg(F.sum("source_size"), F.sum("weight")).first()
    words, weight = float(total[0] or 0) * share, float(total[1] or 1)
    order = [F.col("ratio"), F.col("source").asc_nulls_last()]
    summed = running(caps, order, ["cap", "weight"], "mix-levels")
    level = (F.lit(words) - F.col("before_cap")) / (F.lit(weight) - F.col("before_weight"))
    found = summed.where(level <= F.col("ratio")).agg(F.min_by(level, F.col("pos"))).first()[0]
    level = float("inf") if found is None else found
    return caps.select("source", "source_size", F.least(F.lit(level) * F.col("weight"), F.col("cap")).alias("target"))


def _rank(factor: Column, size: Column, u: Column) -> Column:
    """Random odds over inclusion odds, mapped to 0..1 without changing the order: 0 for a certain
    document, 1 for one that cannot be taken."""
    p = factor * size
    odds = (u / (1 - u)) / (p / (1 - p))
    return F.when(p >= 1, 0.0).when(p > 0, odds / (1 + odds)).otherwise(1.0)


def factors(sizes: DataFrame, goal: DataFrame, small: bool) -> DataFrame:
    """``s, factor``: c of every source that needs more than its whole copies.

    ``sizes`` has ``source, size``, ``goal`` has ``source, need``. With the sizes above some size
    certain, c is the words still needed over the sum of squares of the others; the first size in
    descending order that c leaves below certainty ends the prefix. The window sees a row per
    distinct size.
    """
    counts = sizes.where("size > 0").groupBy(F.col("source").alias("s"), "size").agg(F.count(F.lit(1)).alias("n"))
    side = goal.where("need > 0").select("source", "need")
    rows = counts.join(F.broadcast(side) if small else side, F.col("s").eqNullSafe(F.col("source")))
    words, squares = F.col("n") * F.col("size").cast("double"), F.col("n") * F.col("size").cast("double") ** 2
    down = Window.partitionBy("s").orderBy(F.desc("size"))
    rows = rows.select("s", "size", "need", F.sum(words).over(down).alias("upto"), words.alias("own"),
                       F.sum(squares).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("rest"))
    factor = (F.col("need") - (F.col("upto") - F.col("own"))) / F.col("rest")
    # Rounding aside there is such a size, as the need is less than all words; else the largest c will do.
    ends = F.max_by(factor, F.when(factor * F.col("size") < 1, F.col("size")))
    return rows.groupBy("s").agg(F.coalesce(ends, 1 / F.min("size")).alias("factor"))


def _edges(rows: DataFrame, known: DataFrame | None, bins: int, small: bool, name: str) -> DataFrame:
    """``s, begin, bin`` per source: the bin (of ``bins`` over all ranks) in which the need is reached,
    and the words ranked below it. Only rows in the bin found before (``known``) are looked at."""
    binned = rows.withColumn("bin", F.least(F.floor(F.col("rank") * bins), F.lit(bins - 1)).cast("bigint"))
    if known is not None:
        before = known.select("s", "begin", F.col("bin").alias("outer"))
        same = F.col("source").eqNullSafe(F.col("s")) & (F.floor(F.col("bin") / BINS) == F.col("outer"))
        binned = binned.join(F.broadcast(before) if small else before, same).drop("s")
    else:
        binned = binned.withColumn("begin", F.lit(0).cast("bigint"))
    sums = binned.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.max("need").alias("need"), F.max("begin").alias("base"))
    end = F.col("base") + F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    sums = sums.withColumn("end", end).withColumn("begin", F.col("end") - F.col("words"))
    edge = sums.where((F.col("begin") < F.col("need")) & (F.col("end") >= F.col("need")))
    return cut(edge.select(F.col("source").alias("s"), "begin", "bin"), name)


def thresholds(sizes: DataFrame, goal: DataFrame) -> DataFrame:
    """``goal`` with ``whole`` copies, ``factor`` and ``limit``, the rank up to which documents are
    taken once more (null: none). ``sizes`` has ``source, size, u``."""
    f = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goal.withColumn("f", f).withColumn("whole", F.floor(F.col("f") + 1e-12).cast("int"))
    need = F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))
    # What rounding leaves of a need is none.
    need = F.when(F.col("f") - F.col("whole") > 1e-12, need).otherwise(0.0)
    goal = cut(goal.withColumn("need", need), "mix-goal")
    small = goal.count() <= SMALL_ROWS
    factor = cut(factors(sizes, goal, small), "mix-factors")
    side = goal.where("need > 0").select("source", "need").join(factor, F.col("source").eqNullSafe(F.col("s"))).drop("source")
    # Past the bound both sides are dealt by source; adaptive execution splits a hot one.
    rows = sizes.where("size > 0").join(F.broadcast(side) if small else side, F.col("source").eqNullSafe(F.col("s")))
    rows = rows.select("source", "size", "need", _rank(F.col("factor"), F.col("size"), F.col("u")).alias("rank"))
    edge = _edges(rows, None, BINS, small, "mix-edges")
    edge = _edges(rows, edge, BINS * BINS, small, "mix-inner-edges")
    inner = edge.select("s", "begin", F.col("bin").alias("b"))
    here = F.least(F.floor(F.col("rank") * (BINS * BINS)), F.lit(BINS * BINS - 1)).cast("bigint")
    near = rows.join(F.broadcast(inner) if small else inner, F.col("source").eqNullSafe(F.col("s")) & (here == F.col("b")))
    # Rows of one rank, repeated ones and all certain ones, are taken or left together.
    near = near.groupBy("source", "rank").agg(F.sum("size").alias("size"), F.max("need").alias("need"), F.max("begin").alias("begin"))
    near = near.withColumn("end", F.col("begin") + F.sum("size").over(Window.partitionBy("source").orderBy("rank")))
    near = near.where(F.col("end") - F.col("need") <= F.col("need") - (F.col("end") - F.col("size")))
    inside = near.groupBy(F.col("source").alias("s2")).agg(F.max("rank").alias("inside"))
    last = inner.join(inside, F.col("s").eqNullSafe(F.col("s2")), "left").select(
        "s", F.coalesce("inside", F.col("b") / F.lit(float(BINS * BINS)) - F.lit(1e-300)).alias("limit")
    )
    # No edge although words are needed: rounding left the sum of all words just below the need.
    of = factor.select(F.col("s").alias("s3"), "factor")
    out = goal.join(of, F.col("source").eqNullSafe(F.col("s3")), "left").join(last, F.col("source").eqNullSafe(F.col("s")), "left")
    out = out.withColumn("limit", F.when(F.col("factor").isNotNull(), F.coalesce("limit", F.lit(1.0))))
    return out.drop("s", "s3")


def _sized(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    return word_count(F.col(text_col)), uniform(F.col(id_col), F.col(text_col))


def _copies(rows: DataFrame, limits: DataFrame, source: Column, size: Column, u: Column, small: bool) -> tuple[DataFrame, Column]:
    side = limits.select(F.col("source").alias("_s"), *[F.col(c).alias(f"_{c}") for c in ("source_size", "target", "whole", "factor", "limit")])
    joined = rows.join(F.broadcast(side) if small else side, source.eqNullSafe(F.col("_s")))
    extra = F.coalesce((size > 0) & (_rank(F.col("_factor"), size, u) <= F.col("_limit")), F.lit(False))
    return joined, F.col("_whole") + extra.cast("int")


def _limits(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, DataFrame, bool]:
    size, u = _sized(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), u.alias("u"))
    sizes = cut(rows, "mix-sizes")
    limits = cut(thresholds(sizes, targets(sizes)), "mix-limits")
    return sizes, limits, limits.count() <= SMALL_ROWS


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` per row of ``docs``.

    A null source is a source; null texts have size 0 and are taken with their source's whole
    copies (0 words); repeated rows are ranked alike, so they are taken or left together; an empty
    table gives no rows; other columns are not read.
    """
    sizes, limits, small = _limits(docs, id_col, text_col, source_col)
    joined, copies = _copies(sizes, limits, F.col("source"), F.col("size"), F.col("u"), small)
    taken = (F.col("size") * copies).cast("bigint")
    return joined.select(
        "doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        taken.alias("taken"), copies.alias("copies"),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken; columns as they were.

    Documents without words come with their source's whole copies, repeated rows all alike; an
    empty table gives no rows.
    """
    _, limits, small = _limits(docs, id_col, text_col, source_col)
    size, u = _sized(docs, id_col, text_col)
    rows = docs.select(whole_row(docs), size.alias("size"), u.alias("u"), F.col(source_col).alias("source"))
    joined, copies = _copies(rows, limits, F.col("source"), F.col("size"), F.col("u"), small)
    return joined.select("_row", F.explode(F.array_repeat(F.lit(0), copies))).select("_row.*")
