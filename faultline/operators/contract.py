"""One declaration of what a feed must hold: rules about rows, keys, references and the whole.

A contract is a list of rules given as data. ``rejects`` and ``report`` compile it:

* row rules are predicates, evaluated where the row is;
* key rules (first copy, unique, known elsewhere) are keyed aggregates that find the *offending
  keys*: map tasks send out distinct keys with counts, never rows. Rows then only ask whether their
  key offends. Offending keys are written once and broadcast up to a measured size; beyond it the
  question is a join on the key;
* set rules are aggregates over the whole feed; they have no offending rows.

Only rows of keys with several copies are ordered among themselves, and only offending rows leave.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators.dedupe import ordering
from faultline.operators.joins import DEFAULT_BROADCAST_MAX_BYTES, bounded_broadcast
from faultline.sources.scratch import written

REASONS = "reasons"


@dataclass(frozen=True)
class RowRule:
    """Every row must meet ``holds``; null counts as not met."""

    name: str
    holds: Column


@dataclass(frozen=True)
class FirstCopy:
    """Of the rows of one key only the first by ``order`` passes (other columns break ties); null is a key."""

    name: str
    key: str
    order: tuple[str, ...]


@dataclass(frozen=True)
class UniqueKey:
    """No two rows share a key; all rows of a shared key break the rule. Null keys are not judged."""

    name: str
    key: str


@dataclass(frozen=True)
class KnownKey:
    """Every key occurs in ``column`` of ``reference``. Null keys are not judged."""

    name: str
    key: str
    reference: DataFrame
    column: str


@dataclass(frozen=True)
class SetRule:
    """``holds``, an aggregate over the whole feed, must be true; null counts as not met."""

    name: str
    holds: Column


Rule = RowRule | FirstCopy | UniqueKey | KnownKey | SetRule


def _broken(rule: RowRule | SetRule) -> Column:
    return ~F.coalesce(rule.holds, F.lit(False))


def _key_counts(df: DataFrame, rule: FirstCopy | UniqueKey | KnownKey) -> DataFrame:
    """``key, n`` per offending key of the rule."""
    counts = df.groupBy(F.col(rule.key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    if isinstance(rule, FirstCopy):
        return counts.where("n > 1")
    if isinstance(rule, UniqueKey):
        return counts.where("n > 1 and key is not null")
    known = rule.reference.select(F.col(rule.column).alias("key"))
    return counts.where("key is not null").join(known, "key", "left_anti")


def rejects(df: DataFrame, rules: Sequence[Rule], max_broadcast_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """The rows of ``df`` that break a rule, with ``reasons``: the names of the rules, in order.

    Set rules are not about rows and name none. Every column may be null, rows may repeat; an empty
    feed has no rejects.
    """
    of_rows = [r for r in rules if not isinstance(r, SetRule)]
    firsts = [r for r in of_rows if isinstance(r, FirstCopy)]
    if len({(r.key, r.order) for r in firsts}) > 1:
        raise ValueError("a contract orders the copies of one key only")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    tagged = df.select(row, *[_broken(r).alias(f"b{i}") for i, r in enumerate(of_rows) if isinstance(r, RowRule)])
    for i, rule in enumerate(of_rows):
        if isinstance(rule, RowRule):
            continue
        offending = written(_key_counts(df, rule).select("key"), "offending-keys")
        offending = bounded_broadcast(offending.withColumn("hit", F.lit(True)), max_broadcast_bytes)
        # The marker's null-ness tells a null key that offends from a row without a match.
        tagged = tagged.join(offending, F.col(f"row.`{rule.key}`").eqNullSafe(F.col("key")), "left")
        tagged = tagged.withColumn(f"b{i}", F.col("hit").isNotNull()).drop("key", "hit")
    flags = [f"b{i}" for i in range(len(of_rows))]
    any_flag = reduce(lambda a, b: a | b, [F.col(f) for f in flags], F.lit(False))
    # From here on only rows with a flag go on; a flag of FirstCopy says as yet that there are copies.
    tagged = tagged.where(any_flag)
    if firsts:
        copies = [f"b{i}" for i, r in enumerate(of_rows) if isinstance(r, FirstCopy)]
        of = firsts[0]
        of_row = lambda c: F.col(f"row.`{c}`")
        order = Window.partitionBy(of_row(of.key)).orderBy(*ordering(df, [of.key], list(of.order), of=of_row))
        split = tagged.where(F.col(copies[0])).withColumn("late", F.row_number().over(order) > 1)
        split = split.withColumns({c: F.col("late") for c in copies}).select("row", *flags).where(any_flag)
        tagged = tagged.where(~F.col(copies[0])).unionByName(split)
    names = F.array(*[F.when(F.col(f), F.lit(r.name)) for f, r in zip(flags, of_rows)]) if flags else F.array().cast("array<string>")
    return tagged.select("row.*", F.filter(names, lambda x: x.isNotNull()).alias(REASONS))


def report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule, failed_rows, total_rows, passed`` per rule, from counts alone.

    Row and set rules share one aggregate over the feed; a key rule adds the aggregate of its keys.
    A set rule has no failed rows. An empty feed passes all rules but set rules that say otherwise.
    """
    count = F.count(F.lit(1))
    own: dict[str, Column] = {}
    for i, rule in enumerate(rules):
        if isinstance(rule, RowRule):
            own[f"r{i}"] = F.count_if(_broken(rule))
        elif isinstance(rule, SetRule):
            own[f"r{i}"] = _broken(rule).cast("bigint")
        elif isinstance(rule, FirstCopy):
            null_key = F.coalesce(F.max(F.col(rule.key).isNull().cast("bigint")), F.lit(0))
            own[f"r{i}"] = count - F.countDistinct(rule.key) - null_key
    parts = [df.agg(count.alias("total"), *[c.alias(n) for n, c in own.items()])]
    for i, rule in enumerate(rules):
        if isinstance(rule, (UniqueKey, KnownKey)):
            parts.append(_key_counts(df, rule).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias(f"r{i}")))
    # One row per part; every column is set in one of them.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    row = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    each = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.when(F.lit(isinstance(rule, SetRule)), F.lit(0).cast("bigint")).otherwise(F.col(f"r{i}")).alias("failed_rows"),
            F.col("total").alias("total_rows"),
            (F.col(f"r{i}") == 0).alias("passed"),
        )
        for i, rule in enumerate(rules)
    ]
    return row.select(F.inline(F.array(*each)))
