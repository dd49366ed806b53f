"""Everything that depends on a table, over any number of steps.

``impact`` answers "if I change this table, what breaks?" and, upstream, "what does this table rest
on?". A table that only one other table feeds is reached through that one alone, so chains of such
tables are shortened first: each points at its feeder, and the pointers are doubled until they end at
a *junction* (the start, or a table with several feeders). A chain of n tables takes log2 n steps.
Junctions are then relaxed from the start along the shortened edges until nothing improves; a round
covers one junction more on every route. Cycles end by themselves, as a longer route never improves a
table.

Only *inner* tables, which have feeders and feed others, take part in the rounds: no route passes
through another. One last step from the start and the inner tables along all edges reaches the rest.

Every step is a keyed join or aggregate over written files: a lost executor costs the tasks of one
step, and no list of tables passes through the driver. A round reads the shortened edges once and
shuffles what it reaches; the tables that the round before reached are broadcast while they are
measured to be small.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.operators.joins import DEFAULT_BROADCAST_MAX_BYTES, measured_bytes
from faultline.sources.scratch import written

SOURCE, TARGET = "source_table_full_name", "target_table_full_name"


def _best(df: DataFrame, key: str | list[str], *also: str) -> DataFrame:
    """Per key the shortest route, and of those the one whose oldest step is the most recent.

    A route without any time counts as the most recent. ``also`` names columns of the route to
    keep; of equal routes the one with the lowest values there is taken.
    """
    keys = [key] if isinstance(key, str) else key
    # The shortest length first, then the latest time: a reversed time orders as wanted under min.
    age = -F.unix_micros(F.col("seen").cast("timestamp"))
    picked = df.groupBy(*keys).agg(F.min(F.struct("steps", age.alias("age"), *also, "seen")).alias("r"))
    return picked.select(*keys, *(F.col(f"r.{c}").alias(c) for c in ("steps", "seen", *also)))


def _earlier(a: Column, b: Column) -> Column:
    """The older of two times; a null (no step yet) does not count."""
    return F.least(a, b)


def _shortened(single: DataFrame) -> DataFrame:
    """``node, junction, steps, seen``: single-feeder tables with the junction above them.

    Tables that only feed each other in a circle have none and go.
    """
    pointer = single
    for _ in range(ceil(log2(max(2, single.count()))) + 1):
        above = pointer.select(
            F.col("node").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"), F.col("seen").alias("seen2")
        )
        pointer = pointer.join(above, "up", "left").select(
            "node",
            F.coalesce("up2", "up").alias("up"),
            (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"),
            _earlier(F.col("seen"), F.col("seen2")).alias("seen"),
            F.col("up2").isNotNull().alias("moved"),
        )
        pointer = written(pointer, "impact-pointers")
        if pointer.where("moved").isEmpty():
            break
        pointer = pointer.drop("moved")
    # What still points at a single-feeder table goes round in a circle.
    ended = pointer.select("node", "up", "steps", "seen")
    return ended.join(single.select(F.col("node").alias("up")), "up", "left_anti").withColumnRenamed("up", "junction")


def _onwards(steps: DataFrame, known: DataFrame) -> DataFrame:
    """``node, steps, seen`` of the routes to ``known`` tables, each with one of ``steps`` more."""
    known = known.select(F.col("node").alias("src"), F.col("steps").alias("s0"), F.col("seen").alias("t0"))
    return steps.join(known, "src").select(
        F.col("dst").alias("node"), (F.col("steps") + F.col("s0")).alias("steps"), _earlier(F.col("seen"), F.col("t0")).alias("seen")
    )


def impact(edges: DataFrame, table: str, direction: str = "downstream") -> DataFrame:
    """``table_name, depth, last_seen`` of every table reached from ``table``, without itself.

    ``depth`` is the fewest steps. ``last_seen`` is when the route was last whole: a route is as
    recent as its oldest step (a step as its latest event), and of the routes with the fewest steps
    the most recent counts. ``direction`` is ``downstream`` (what depends on ``table``) or
    ``upstream`` (what it rests on). Rows of ``edges`` with a null end, and steps from a table to
    itself, are no steps; a table without steps gives no rows.
    """
    if direction not in ("upstream", "downstream"):
        raise ValueError("direction must be 'upstream' or 'downstream'")
    src, dst = (SOURCE, TARGET) if direction == "downstream" else (TARGET, SOURCE)
    steps = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"), F.col("event_time").alias("seen"))
    steps = steps.where("src is not null and dst is not null and src <> dst").where(F.col("dst") != table)
    steps = written(steps.groupBy("src", "dst").agg(F.max("seen").alias("seen")), "impact-steps")

    # Inner tables: fed by another one, and feeding one. Nothing leads to the start here, so it is none.
    feeders = steps.groupBy("dst").agg(F.count(F.lit(1)).alias("n"), F.max("src").alias("up"), F.max("seen").alias("seen"))
    feeders = feeders.withColumnRenamed("dst", "node")
    inner = written(feeders.join(steps.select(F.col("src").alias("node")).distinct(), "node"), "impact-inner")
    single = inner.where("n = 1").select("node", "up", F.lit(1).alias("steps"), "seen")
    single = written(_shortened(single), "impact-shortened")

    # The start, before any step; its column types are those of later rows.
    none = F.lit(None).cast(dict(steps.dtypes)["seen"])
    start = edges.sparkSession.range(1).select(F.lit(table).alias("node"), F.lit(0).alias("steps"), none.alias("seen"))

    # Steps into inner junctions, each from the junction at or above its source: the start or an inner
    # one. What is below no such junction is out of reach.
    junctions = inner.where("n > 1").select("node")
    own = junctions.select("node", F.lit(0).alias("steps"), none.alias("seen")).unionByName(start)
    above = own.withColumn("junction", F.col("node")).unionByName(single)
    lifted = steps.join(junctions.withColumnRenamed("node", "dst"), "dst", "left_semi")
    lifted = lifted.join(
        above.select(F.col("node").alias("src"), "junction", F.col("steps").alias("s0"), F.col("seen").alias("t0")), "src"
    ).select(F.col("junction").alias("src"), "dst", (F.col("s0") + 1).alias("steps"), _earlier(F.col("seen"), F.col("t0")).alias("seen"))
    lifted = written(_best(lifted, ["src", "dst"]), "impact-junction-steps")

    reached = front = start
    while True:
        offers = _onwards(lifted, front)
        # Of equal routes the known one stays.
        tried = reached.select("node", "steps", "seen", F.lit(False).alias("moved")).unionByName(offers.withColumn("moved", F.lit(True)))
        reached = written(_best(tried, "node", "moved"), "impact-reached")
        front = reached.where("moved").select("node", "steps", "seen")
        size = measured_bytes(front)
        if size == 0:
            break
        if size <= DEFAULT_BROADCAST_MAX_BYTES:
            front = F.broadcast(front)
    reached = reached.select("node", "steps", "seen")

    below = single.join(reached.select(F.col("node").alias("junction"), F.col("steps").alias("s0"), F.col("seen").alias("t0")), "junction")
    below = below.select("node", (F.col("steps") + F.col("s0")).alias("steps"), _earlier(F.col("seen"), F.col("t0")).alias("seen"))
    every = _best(_onwards(steps.withColumn("steps", F.lit(1)), reached.unionByName(below)), "node")
    return every.select(F.col("node").alias("table_name"), F.col("steps").cast("bigint").alias("depth"), F.col("seen").alias("last_seen"))
