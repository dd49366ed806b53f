"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import cut


def components(links: DataFrame, a: str, b: str, steps: list[str] | None = None) -> DataFrame:
    """``(node, root)`` for every node of ``links``; ``root`` is a node of the same component.

    A round points every node at its smallest neighbour (a node smaller than all its neighbours
    points at itself), doubles the pointers until each ends at such a node, and replaces the ends
    of the links by what they point at; links that became loops go, copies merge. A path of n
    pointers takes log2 n doublings whatever its length, and a round leaves at most half the
    nodes, since every node that stays has a neighbour that goes. Only pointers that have not
    ended are looked up again, by node id, where adaptive execution splits hot ids. Each doubling
    and each round is written as files and read again (``checkpoint`` would carry the inferred
    constraints of all rounds along, and planning time doubles with them). ``steps`` (for tests) is given a name for each of them. A link
    from a node to itself or with a null end is none; no links: an empty result.
    """
    steps = [] if steps is None else steps
    edges = cut(_normal(links.select(F.col(a).alias("x"), F.col(b).alias("y"))), "links")
    labels = edges.select(F.col("x").alias("node")).union(edges.select("y")).distinct()
    labels = labels.withColumn("root", F.col("node"))
    while not edges.isEmpty():
        steps.append("round")
        both = edges.union(edges.select("y", "x"))
        lowest = both.groupBy("x").agg(F.min("y").alias("y"))
        pointer = _settled(cut(lowest.select("x", F.least("x", "y").alias("y")), "pointers"), steps)
        to = pointer.select(F.col("x").alias("root"), F.col("y").alias("to"))
        labels = cut(labels.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")
        left, right = pointer.toDF("x", "x2"), pointer.toDF("y", "y2")
        edges = _normal(edges.join(left, "x").join(right, "y").select(F.col("x2").alias("x"), F.col("y2").alias("y")))
        edges = cut(edges, "links")
    return labels


def _settled(pointer: DataFrame, steps: list[str]) -> DataFrame:
    """``(x, y)`` with every ``y`` replaced by the last node on its path."""
    pointer = pointer.withColumn("done", F.col("x") == F.col("y"))
    while True:
        steps.append("doubling")
        # Rows that have ended look nothing up; their own node keeps them spread over the tasks.
        asks = pointer.withColumn("k", F.when(F.col("done"), F.col("x")).otherwise(F.col("y"))).withColumn("old", F.col("done"))
        told = pointer.select(F.col("x").alias("k"), F.lit(False).alias("old"), F.col("y").alias("z"), F.col("done").alias("last"))
        after = asks.join(told, ["old", "k"], "left")
        pointer = after.select("x", F.coalesce("z", "y").alias("y"), (F.col("done") | F.coalesce("last", F.lit(False))).alias("done"))
        pointer = cut(pointer, "pointers")
        if pointer.where("not done").isEmpty():
            return pointer.select("x", "y")


def _normal(edges: DataFrame) -> DataFrame:
    low, high = F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")
    return edges.where("x is not null and y is not null").select(low, high).where(F.col("x") < F.col("y")).distinct()
