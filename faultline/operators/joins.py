"""Join helpers: broadcast only behind a measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The most bytes of a side that may be shipped to every executor, as measured by ``measured_bytes``.
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024
FIXED_BYTES = 8


def _value_bytes(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(c)
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(c)))
    else:
        return F.lit(FIXED_BYTES).cast("bigint")
    return F.coalesce(size, F.lit(0)).cast("bigint") + F.lit(FIXED_BYTES)


def measured_bytes(df: DataFrame) -> int:
    """About how many bytes the rows of ``df`` take in memory: eight per value and the lengths
    of its texts, summed in one aggregate (one partial sum leaves each task)."""
    row = sum((_value_bytes(f) for f in df.schema.fields), F.lit(FIXED_BYTES).cast("bigint"))
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when it was just measured to be small.

    Measured anew at each call: a table may have been replaced since. Past the bound the frame is
    returned unchanged; the join then shuffles both sides on the key (sort-merge), and adaptive
    execution may still pick a broadcast from the measured shuffle size or split a skewed
    partition.
    """
    if max_bytes > 0 and measured_bytes(df) <= max_bytes:
        return F.broadcast(df)
    return df


def enrich(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    how: str = "inner",
    max_broadcast_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Equi-join a fact frame to a dimension on ``key`` (``USING`` semantics).

    Only the dimension is ever broadcast, never the fact side.
    """
    return facts.join(bounded_broadcast(dimension, max_broadcast_bytes), key, how)
