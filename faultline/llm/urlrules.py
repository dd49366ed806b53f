"""Operator 4: url rules by a sorted sweep over reversed host names and paths. DataFrame functions only.

``blog.example.net`` has the key ``net.example.blog.``; the rules that fit a host are those of its
key's leading labels, found by an equi-join of distinct hosts with rule hosts. Under one rule host a
rule is an interval of paths, from its path up to (not with) its path and a byte that no text has.
These intervals are nested or apart. A rule gives an event where its interval starts, carrying the
rule, and one where it ends, carrying the rule around it: the top of the stack after a push and after
a pop. The rest of the stack need not travel, as every end names what is below. Sorted by rule host
and path together with the paths of the urls, the last event before a path holds the longest rule of
that host that fits. Of the few rule hosts of a url the best of these wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.llm.common import cut, partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SMALL_ROWS = 100_000


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PATTERN, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, URL_PATTERN, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(verdict, host, path)`` rows from a short literal list."""
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("verdict", "host", "path"), r)]) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _usable(rules: DataFrame) -> DataFrame:
    """``key, path, rule``: one rule per host and path, a blocking one if there is any."""
    host = F.translate(F.col("host"), UPPER, LOWER)
    rule = F.struct(
        (F.length("host") + F.length("path")).alias("long"), F.length("host").alias("host_long"),
        (F.col("verdict") == "block").alias("blocks"), F.concat(host, "path").alias("rule"), F.col("verdict"),
    )
    fit = rules.where((F.col("host") != "") & F.col("path").isNotNull() & F.col("verdict").isNotNull())
    return fit.select(host_key(host).alias("key"), "path", rule.alias("r")).groupBy("key", "path").agg(F.max("r").alias("rule"))


def _events(rules: DataFrame) -> DataFrame:
    """``key, at, kind, event``: kind 0 where a rule's interval starts, 2 where it ends; ``event`` holds
    the rule on top of the stack from there on (null: none).

    The rule around another is the longest proper beginning of its path that is a rule of that host:
    beginnings meet rules by host, length and hash, then by comparison.
    """
    shorter = rules.select("key", "path", F.explode(F.sequence(F.lit(0), F.length("path") - 1)).alias("n")).where("n between 0 and length(path) - 1")
    start = F.expr("left(path, n)")
    shorter = shorter.select("key", "path", "n", F.xxhash64(start).alias("h"))
    outer = rules.select("key", F.length("path").alias("n"), F.xxhash64("path").alias("h"), F.col("path").alias("begin"), "rule")
    around = shorter.join(outer, ["key", "n", "h"]).where(F.startswith("path", "begin"))
    around = around.groupBy("key", "path").agg(F.max_by("rule", "n").alias("around"))
    held = rules.join(around, ["key", "path"], "left")
    at = F.col("path").cast("binary")
    return held.select(
        "key",
        F.inline(
            F.array(
                F.struct(at.alias("at"), F.lit(0).alias("kind"), F.struct("key", "rule").alias("event")),
                F.struct(
                    F.concat(at, F.unhex(F.lit("FF"))).alias("at"), F.lit(2).alias("kind"),
                    F.struct("key", F.col("around").alias("rule")).alias("event"),
                ),
            )
        ),
    )


def innermost(points: DataFrame, rules: DataFrame) -> DataFrame:
    """``key, path, rule``: the longest rule of the host ``key`` that fits each path: the sorted sweep.

    ``points`` has ``key, path``, ``rules`` is ``_usable``. Range shuffle deals contiguous pieces of
    the order, written with their numbers; a window sweeps each piece, and what is active where a
    piece starts comes from the last event of the pieces before it (one row per piece). Distinct
    paths are swept, so a url with a third of all rows is one row here, and a host with many paths
    or rules is dealt over pieces.
    """
    n = partitions(points.sparkSession)
    swept = points.distinct().select("key", F.col("path").cast("binary").alias("at"), F.lit(1).alias("kind"), "path")
    swept = swept.unionByName(_events(rules), allowMissingColumns=True)
    swept = cut(swept.repartitionByRange(n, "key", "at", "kind").withColumn("piece", F.spark_partition_id()), "url-sweep")
    last = swept.groupBy("piece").agg(
        F.max_by("event", F.when(F.col("event").isNotNull(), F.struct("key", "at", "kind"))).alias("event")
    )
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("piece", F.last("event", ignorenulls=True).over(before).alias("carried"))
    upto = Window.partitionBy("piece").orderBy("key", "at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    active = swept.withColumn("event", F.last("event", ignorenulls=True).over(upto)).where("kind = 1")
    # One row per shuffle partition.
    active = active.join(F.broadcast(carried), "piece").withColumn("event", F.coalesce("event", "carried"))
    return active.where((F.col("event.key") == F.col("key")) & F.col("event.rule").isNotNull()).select("key", "path", "event.rule")


def _bounded(df: DataFrame) -> DataFrame:
    """Past the bound both sides of a join are dealt by its key; adaptive execution splits hot keys."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def judge_urls(rows: DataFrame, rules: DataFrame, url_col: str, default: str = "allow") -> DataFrame:
    """``rows`` with ``host, path, rule, verdict``; columns of these names are replaced.

    ``rules`` has ``verdict, host, path``. The rule with the most characters of host and path
    wins, then the longer host, then a blocking one. A url no rule fits has a null ``rule`` and
    the verdict ``default``. Null urls and urls without ``://`` have an empty host and path.
    Rules with an empty or null host fit nothing. Repeated rows and rules change nothing; empty
    tables are fine.
    """
    kept = [c for c in rows.columns if c not in ("host", "path", "rule", "verdict")]
    url = F.col(url_col)
    # One column for all others, so names used here cannot clash with theirs.
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")
    parts = rows.select(row, url_host(url).alias("host"), url_path(url).alias("path"))
    usable = cut(_usable(rules), "url-usable")
    urls = cut(parts.select("host", "path").distinct(), "urls")
    labels = F.split(F.col("host"), r"\.")
    around = urls.select("host").distinct().select("host", F.reverse(labels).alias("labels"))
    around = around.select("host", "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("n"))
    around = around.select("host", F.concat(F.array_join(F.expr("slice(labels, 1, n)"), "."), F.lit(".")).alias("key"))
    covered = cut(around.join(_bounded(usable.select("key").distinct()), "key"), "url-hosts")
    points = urls.join(_bounded(covered), "host").select("key", "host", "path")
    found = points.join(_bounded(cut(innermost(points.select("key", "path"), usable), "url-found")), ["key", "path"])
    best = cut(found.groupBy("host", "path").agg(F.max("rule").alias("best")), "url-best")
    joined = parts.join(_bounded(best), ["host", "path"], "left")
    return joined.select(
        "_row.*", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
