"""Column expressions shared by the operators.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity weights of the fault score. Critical 10, Major 5,
# Minor 2; every other severity (Warning, unknown labels, other casing) is 1.
SEVERITY_WEIGHTS = {"Critical": 10, "Major": 5, "Minor": 2}
DEFAULT_SEVERITY_WEIGHT = 1
CRITICAL = "Critical"

# Hexadecimal digits of the digest behind one reproducible draw (52 bits fill a double).
DRAW_DIGITS = 13


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def severity_weight(
    severity: str | Column,
    weights: dict[str, int] | None = None,
    default: int = DEFAULT_SEVERITY_WEIGHT,
) -> Column:
    """Weight of one alarm: exact, case-sensitive match, anything else ``default``."""
    weights = SEVERITY_WEIGHTS if weights is None else weights
    sev = col_of(severity)
    expr = None
    for label, weight in weights.items():
        expr = F.when(sev == label, F.lit(weight)) if expr is None else expr.when(sev == label, F.lit(weight))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def elapsed_minutes(start: str | Column, end: str | Column) -> Column:
    """Whole minutes elapsed from ``start`` to ``end`` (10:00:59 -> 10:01:01 is 0)."""
    return F.timestamp_diff("MINUTE", col_of(start), col_of(end))


def time_to_clear(raised: str | Column, cleared: str | Column) -> Column:
    """Minutes to clear, null while the alarm is still open."""
    cleared_c = col_of(cleared)
    return F.when(cleared_c.isNotNull(), elapsed_minutes(raised, cleared_c))


def hashed_uniform(idx: str | Column, stream: int) -> Column:
    """Reproducible uniform number in [0, 1) for a row index and a stream id.

    The leading digits of ``md5('<idx>:<stream>')`` as a fraction, so any SQL engine gives the
    same value, draws of different streams are unrelated and the sequence does not repeat.
    """
    digest = F.md5(F.concat(col_of(idx).cast("bigint").cast("string"), F.lit(f":{stream}")).cast("binary"))
    digits = F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("bigint")
    return digits.cast("double") / F.lit(float(16**DRAW_DIGITS))


def pick(values: list, u: Column) -> Column:
    """Uniform choice from a literal list driven by a uniform column ``u``."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (u * F.lit(len(values)) + F.lit(1)).cast("int"))


def zero_pad(value: str | Column, width: int, prefix: str = "") -> Column:
    """``prefix`` + ``value`` left-padded with zeros to ``width`` digits.

    Same text as ``format_string(prefix + '%0<width>d', value)`` but without
    the per-row formatter: a cast and a pad. Values that would not fit in
    ``width`` (or are negative) take the formatter, so nothing is truncated.
    """
    v = col_of(value).cast("bigint")
    fits = (v >= F.lit(0)) & (v < F.lit(10**width))
    padded = F.concat(F.lit(prefix), F.lpad(v.cast("string"), width, "0"))
    return F.when(fits, padded).otherwise(F.format_string(f"{prefix}%0{width}d", v))


def contains_ignore_case(haystack: str | Column, needle: str | Column) -> Column:
    """True when ``needle`` occurs in ``haystack`` ignoring case (loose on purpose)."""
    return F.contains(F.lower(col_of(haystack)), F.lower(col_of(needle)))


def excerpt(text: str | Column, length: int = 160) -> Column:
    """Text cut to ``length`` characters after trailing blanks, then trailing ``;``, are removed."""
    no_blanks = F.regexp_replace(col_of(text), r"\s+$", "")
    return F.substring(F.regexp_replace(no_blanks, r";+$", ""), 1, length)
