"""Keep the first row per key, or flag the rows that are not first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(dtype: T.DataType) -> bool:
    """Maps cannot be ordered (nor arrays or structs that hold one)."""
    if isinstance(dtype, T.MapType):
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def ordering(
    df: DataFrame, keys: list[str], order: list[str | Column], tiebreak: bool = True, of: Callable[[str], Column] = F.col
) -> list[Column]:
    """``order``, then every other column that can be ordered, so that the order is the same on every
    run. ``of`` says where a column of ``df`` is found."""
    cols = [of(c) if isinstance(c, str) else c for c in order]
    if tiebreak:
        named = {c for c in order if isinstance(c, str)} | set(keys)
        cols += [
            of(f.name).asc_nulls_first()
            for f in df.schema.fields
            if f.name not in named and _orderable(f.dataType)
        ]
    return cols


def dedupe_first(
    df: DataFrame,
    key: str | list[str],
    order: list[str | Column],
    tiebreak: bool = True,
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY key ORDER BY order) = 1``.

    ``tiebreak`` appends every other column (ascending, nulls first) to the
    ordering so that copies with equal ``order`` values resolve the same way
    on every run. The ``rank = 1`` filter directly above the window lets
    Catalyst plan a partial ``WindowGroupLimit`` before the shuffle, so a key
    repeated a billion times leaves each map task as a single row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*ordering(df, keys, order, tiebreak))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def flag_first(df: DataFrame, key: str, order: list[str | Column], flag: str = "is_first") -> DataFrame:
    """Every row of ``df``, with ``flag`` true on the row ``dedupe_first`` keeps.

    The other rows are ``df`` minus the first ones, as multisets (``exceptAll``): a count per
    distinct whole row, combined in the map tasks. Verbatim copies of a hot key leave a task as one
    row, and its differing rows spread over the tasks. No row ids are needed, so any input
    will do; its columns must be comparable (no maps).
    """
    first = dedupe_first(df, key, order)
    rest = df.exceptAll(first)
    return first.withColumn(flag, F.lit(True)).unionByName(rest.withColumn(flag, F.lit(False)))
