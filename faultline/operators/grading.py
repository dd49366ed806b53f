"""Score answers against ground truth, per round, and the lift between rounds.

Matching is deliberately loose, as in the published benchmark: an answer
passes when the truth occurs anywhere in its text or its first result row,
ignoring case, so a short truth can pass inside a longer word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.scalar import contains_ignore_case, excerpt
from faultline.operators import metrics as M
from faultline.operators.joins import DEFAULT_BROADCAST_MAX_BYTES, bounded_broadcast

# The five graded questions (case id, question).
BENCHMARK_QUESTIONS = [
    (1, "show me the worst performing sites"),
    (2, "which region has the most critical alarms?"),
    (3, "which vendor has the worst (highest) mean time to repair?"),
    (4, "for the single worst site by fault score, what is its most frequent probable cause?"),
    (5, "which region has the highest share of active alarms relative to its total alarms?"),
]


def benchmark_truths(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """``(case_id, question, truth)`` for the five graded questions, from the data.

    Each truth is the single cell of a one-row ranking over Silver or Gold
    (worst site, region with most critical alarms, vendor with the highest
    alarm-level MTTR, the worst site's most frequent cause, region with the
    highest active share). The five one-row frames are stacked, so nothing
    is collected to the driver.
    """
    answers = [
        M.worst_site(gold),
        M.top_critical_region(gold),
        M.slowest(silver, "vendor"),
        M.worst_site_top_cause(silver, gold),
        M.top_active_region(gold),
    ]
    parts = [
        frame.select(
            F.lit(case_id).cast("bigint").alias("case_id"),
            F.lit(question).alias("question"),
            F.col(frame.columns[0]).cast("string").alias("truth"),
        )
        for (case_id, question), frame in zip(BENCHMARK_QUESTIONS, answers, strict=True)
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def score_answers(
    truths: DataFrame,
    answers: DataFrame,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """One row per (case, round): the truth, the pass flag and a short excerpt.

    ``truths(case_id, truth)``; ``answers(case_id, round, answer_text,
    first_row_text)``. The haystack is the text and the first result row
    joined by a space (nulls skipped). Where the reference would stop on a
    case without a truth, here the answer is kept with a null truth and
    ``passed = false``, so no answer silently disappears.
    """
    hay = F.concat_ws(" ", F.col("answer_text"), F.col("first_row_text"))
    joined = answers.join(bounded_broadcast(truths, max_broadcast_bytes), "case_id", "left")
    return joined.select(
        "case_id",
        "round",
        "truth",
        F.coalesce(contains_ignore_case(hay, F.col("truth")), F.lit(False)).alias("passed"),
        excerpt(F.coalesce(F.col("answer_text"), F.lit("(no answer)")), 160).alias("answer_excerpt"),
    )


def round_score(scored: DataFrame) -> DataFrame:
    """Correct and total answers per round."""
    return scored.groupBy("round").agg(
        F.count_if(F.col("passed")).alias("correct"),
        F.count(F.lit(1)).alias("total"),
    )


def answer_lift(scored: DataFrame, before: int = 1, after: int = 2) -> DataFrame:
    """Per case: pass flag in each round and whether it improved.

    A conditional aggregate per case (a pivot over two known rounds) instead
    of a self-join, so each case is one group with map-side combine.
    """
    r = F.col("round")
    return scored.where(r.isin(before, after)).groupBy("case_id", "truth").agg(
        F.max(F.when(r == before, F.col("passed"))).alias("passed_before"),
        F.max(F.when(r == after, F.col("passed"))).alias("passed_after"),
    ).withColumn(
        "improved", F.coalesce(F.col("passed_after") & ~F.col("passed_before"), F.lit(False))
    )


def lift_summary(scored: DataFrame, before: int = 1, after: int = 2) -> DataFrame:
    """One row: score before, score after, total cases and net lift."""
    r = F.col("round")
    return scored.agg(
        F.count_if((r == before) & F.col("passed")).alias("score_before"),
        F.count_if((r == after) & F.col("passed")).alias("score_after"),
        F.count_if(r == before).alias("cases"),
    ).withColumn("lift", F.col("score_after") - F.col("score_before"))
