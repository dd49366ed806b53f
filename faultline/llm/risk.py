"""Operator 5: quality rules whose cutoffs are risk-controlled. DataFrame functions only.

Each rule is a measure of badness between 0 and 1; a document fails it at or above a cutoff. Labelled
documents that passed the base rules are split by a hash of their id:

* on a quarter of them (``SELECT``) every stratum picks its rules: per rule the cutoff half-way between
  the worst of the quarter's good documents and the next bad one beyond. Rules without a bad document
  beyond all good ones are dropped; the others are put in order, most bad documents caught first;
* on the rest the first rule, the first two together, and so on are tested as unions: with n good
  documents of which the union rejects k, "the union rejects more than a share r of good documents"
  has the exact binomial p-value P(Bin(n, r) <= k). Unions only grow, so they are tested in that
  fixed order and the first that fails ends the sequence, which needs no correction inside a
  stratum; over the strata the error level is divided by their number (Bonferroni).

The longest certified union is used. So with confidence ``1 - error`` every stratum loses at most
``risk`` of its good documents to these rules, all together; a stratum without a certified union
rejects nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import BLANK_CLASS, BLANKS, cut, materialised, without, word_array

SYMBOLS = "[#*$%&|<>]"
RULES = ("symbols", "dup_lines", "repeats", "marks", "capitals")
STEPS = 50
RISK = 0.02
ERROR = 0.05
# One labelled document in so many selects the rules, the others certify them.
SELECT = 4
SPLIT_SEED = 5
TAIL = 12
SMALL_ROWS = 100_000


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Per row: ``doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_marks, n_capitals``. A null text has none of anything."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), text.alias("t"))
    # Windows of three words as 64-bit hashes, in order; none if there are fewer words.
    rows = materialised(rows, "w", word_array(F.col("t")))
    n = F.size("w")
    pairs = F.zip_with("w", F.expr("slice(w, 2, greatest(size(w), 1))"), lambda a, b: F.xxhash64(a, b))
    triples = F.zip_with(pairs, F.expr("slice(w, 3, greatest(size(w), 1))"), lambda ab, c: F.xxhash64(ab, c))
    windows = F.when(n >= 3, F.slice(triples, F.lit(1), F.greatest(n - 2, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))
    rows = materialised(rows, "h", windows)
    rows = materialised(rows, "lines", F.filter(F.split("t", "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != ""))
    t, length = F.col("t"), F.length("t")
    return rows.select(
        "doc_id", "stratum", n.cast("bigint").alias("n_words"), without(t, f"[{BLANK_CLASS}]").cast("bigint").alias("word_chars"),
        (length - without(t, SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _covered("h").cast("bigint").alias("n_repeat_words"), F.size("lines").alias("n_lines"),
        (length - without(t, "!")).alias("n_marks"),
        (length - without(t, r"\p{Lu}")).alias("n_capitals"),
    )


def _covered(h: str) -> Column:
    """Words in windows that occur twice or more. Windows sorted by hash, then place, put equal
    ones side by side; the places of those, sorted, cover three words each, less overlaps."""
    with_place = F.transform(F.col(h), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    ordered = F.sort_array(with_place)
    before = F.concat(F.array(F.lit(None).cast("struct<x:bigint,i:int>")), ordered)
    after = F.concat(F.slice(ordered, F.lit(2), F.size(h)), F.array(F.lit(None).cast("struct<x:bigint,i:int>")))
    marked = F.zip_with(
        F.zip_with(ordered, before, lambda e, p: F.struct(e.alias("e"), (e["x"] == p["x"]).alias("p"))),
        after,
        lambda ep, a: F.when(ep["p"] | (ep["e"]["x"] == a["x"]), ep["e"]["i"]),
    )
    places = F.sort_array(F.filter(marked, lambda i: i.isNotNull()))
    total = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("words")),
        lambda acc, i: F.struct(
            i.alias("last"), (acc["words"] + F.least(F.lit(3), i - acc["last"])).alias("words")
        ),
        lambda acc: acc["words"],
    )
    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(total)


def base_failed(n_words: Column, n_repeat: Column, min_words: int = 50, max_repeat: int = 50) -> Column:
    return (n_words < min_words) | (100 * n_repeat > max_repeat * n_words)


def _levels() -> Column:
    """The badness of a document under each rule, in steps from 0 to ``STEPS``."""
    share = {
        "symbols": F.col("n_symbols") / F.greatest(F.col("n_words"), F.lit(1)),
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
        "marks": F.col("n_marks") / F.greatest(F.col("n_words"), F.lit(1)),
        "capitals": F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
    }
    return F.array(*[F.floor(F.least(share[r], F.lit(1.0)) * STEPS).cast("int") for r in RULES])


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series at x + 8."""
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    main = (z - 0.5) * F.log(z) - z + F.lit(0.5 * math.log(2 * math.pi)) + series
    for i in range(8):
        main = main - F.log(x + i)
    return main


def binomial_p(k: Column, n: Column, r: float) -> Column:
    """P(Bin(n, r) <= k) for k below n * r, else 1: the sum of the terms from k down.

    Below the mean each term is less than the one above it, and ``TAIL`` root k terms further down
    they are under 1e-16 of the first: from there on they do not show in a double.
    """
    k, n = k.cast("double"), n.cast("double")
    top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(r) + (n - k) * math.log1p(-r)
    ratio = lambda i: i * ((1 - r) / r) / (n - i + 1)
    least = F.greatest(F.lit(1.0), k - F.ceil(F.sqrt(k) * TAIL + 200))
    down = F.when(k >= 1, F.sequence(k.cast("bigint"), least.cast("bigint"), F.lit(-1).cast("bigint")))
    down = F.coalesce(down, F.array().cast("array<bigint>"))
    total = F.aggregate(
        down,
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda acc, i: F.struct(
            (acc["term"] * ratio(i)).alias("term"), (acc["sum"] + acc["term"] * ratio(i)).alias("sum")
        ),
    )
    return F.when(k < n * r, F.least(F.lit(1.0), F.exp(top) * total["sum"])).otherwise(1.0)


def _labelled(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, stratum, good, levels, selects`` of the labelled rows that passed the base rules."""
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    passed = measured.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    selects = F.pmod(F.xxhash64(F.lit(SPLIT_SEED), "doc_id"), F.lit(SELECT)) == 0
    return passed.join(good, "doc_id").select(
        "doc_id", "stratum", (F.col("q") == 1).alias("good"), _levels().alias("levels"), selects.alias("selects")
    )


def sequences(labelled: DataFrame) -> DataFrame:
    """``stratum, steps``: the rules of each stratum in order, as ``rule`` (its number) and ``cutoff``,
    from the selecting rows alone. The aggregates have strata x rules x levels rows."""
    each = labelled.where("selects").select("stratum", "good", F.posexplode("levels").alias("rule", "level"))
    cells = each.groupBy("stratum", "rule", "level").agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
    # From one above the highest level of a good document, half-way to the lowest bad one beyond.
    best = cells.groupBy("stratum", "rule").agg((F.coalesce(F.max(F.when(F.col("g") > 0, F.col("level"))), F.lit(0)) + 1).alias("cutoff"))
    side = best.select(F.col("stratum").alias("s"), F.col("rule").alias("r"), "cutoff")
    caught = cells.join(side, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("rule") == F.col("r")))
    beyond = caught.where((F.col("level") >= F.col("cutoff")) & (F.col("b") > 0))
    half_way = F.ceil((F.col("cutoff") + F.min("level")) / 2).cast("int")
    caught = beyond.groupBy("stratum", "rule", "cutoff").agg(F.sum("b").alias("b"), half_way.alias("half_way"))
    caught = caught.select("stratum", "rule", "b", F.col("half_way").alias("cutoff"))
    # At most as many steps as rules.
    steps = F.sort_array(F.collect_list(F.struct((-F.col("b")).alias("b"), "rule", "cutoff")))
    return caught.groupBy("stratum").agg(F.transform(steps, lambda x: F.struct(x["rule"].alias("rule"), x["cutoff"].alias("cutoff"))).alias("steps"))


def _first_step(levels: Column, steps: Column) -> Column:
    """The place (from 1) of the first step that rejects a document; null for none."""
    hits = F.transform(steps, lambda x, i: F.when(F.element_at(levels, x["rule"] + 1) >= x["cutoff"], i + 1))
    return F.array_min(hits)


def certified(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``stratum, steps, n, k, bad, bad_caught, p``: the certified union per stratum, if it has one.

    ``steps`` lists its rules and cutoffs; n, k and p are of the certifying rows' good documents,
    ``bad_caught`` of ``bad`` of their bad ones. ``labels`` has ``doc_id, quality`` (1 good, 0 bad); a
    document with several labels is good if none is 0.
    """
    labelled = cut(_labelled(measured, labels), "risk-labelled")
    chosen = cut(sequences(labelled), "risk-sequences")
    side = chosen.select(F.col("stratum").alias("s"), "steps")
    # One small row per stratum; past the bound both sides are dealt by stratum.
    side = F.broadcast(side) if chosen.count() <= SMALL_ROWS else side
    rows = labelled.where("not selects").join(side, F.col("stratum").eqNullSafe(F.col("s")))
    rows = rows.select("stratum", "good", "steps", _first_step(F.col("levels"), F.col("steps")).alias("first"))
    counts = rows.groupBy("stratum", "first").agg(
        F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"), F.first("steps").alias("steps")
    )
    # Every step has a row, also one that rejects nothing beyond the steps before it.
    whole = counts.groupBy("stratum").agg(
        F.sum("g").alias("n"), F.sum("b").alias("bad"), F.first("steps").alias("steps"),
        F.map_from_entries(F.collect_list(F.when(F.col("first").isNotNull(), F.struct("first", F.struct("g", "b"))))).alias("of"),
    )
    steps = whole.select("stratum", "n", "bad", "steps", "of", F.explode(F.sequence(F.lit(1), F.size("steps"))).alias("step"))
    upto = Window.partitionBy("stratum").orderBy("step")
    cell = F.try_element_at("of", F.col("step"))
    steps = steps.select(
        "stratum", "n", "bad", "steps", "step", F.sum(F.coalesce(cell["g"], F.lit(0))).over(upto).alias("k"),
        F.sum(F.coalesce(cell["b"], F.lit(0))).over(upto).alias("bad_caught"),
    )
    strata = max(1, chosen.count())
    tested = steps.withColumn("p", binomial_p(F.col("k"), F.col("n"), risk))
    tested = tested.withColumn("sure", F.min((F.col("p") <= error / strata).cast("int")).over(upto) == 1).where("sure")
    last = tested.groupBy("stratum").agg(F.max_by(F.struct("steps", "step", "n", "k", "bad", "bad_caught", "p"), "step").alias("c"))
    return last.select("stratum", F.slice("c.steps", F.lit(1), F.col("c.step")).alias("steps"), "c.n", "c.k", "c.bad", "c.bad_caught", "c.p")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The measures of every row with ``base_failed``, ``failed_rules`` and ``kept``.

    Rows that fail the base rules are not kept; the others are kept unless a certified rule of
    their stratum (null is a stratum of its own) rejects them. ``failed_rules`` names certified
    rules, in the order of ``RULES``. Without labels no rule is certified. Repeated rows are judged alike; an empty table gives no rows; other columns are
    not read.
    """
    measured = cut(measures(docs, id_col, text_col, stratum_col), "risk-measures")
    chosen = cut(certified(measured, labels, risk, error), "risk-certified")
    side = chosen.select(F.col("stratum").alias("s"), "steps")
    if chosen.count() <= SMALL_ROWS:
        side = F.broadcast(side)
    # Past the bound both sides are dealt by stratum; adaptive execution splits a hot one.
    judged = measured.join(side, F.col("stratum").eqNullSafe(F.col("s")), "left").withColumn("levels", _levels())
    names = F.array(*[F.lit(r) for r in RULES])
    hit = F.filter("steps", lambda x: F.element_at(F.col("levels"), x["rule"] + 1) >= x["cutoff"])
    failed = F.transform(F.array_sort(F.transform(hit, lambda x: x["rule"])), lambda i: F.element_at(names, i + 1))
    judged = judged.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    judged = judged.withColumn("failed_rules", F.coalesce(failed, F.array().cast("array<string>")))
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    return judged.drop("s", "steps", "levels")
