"""Intermediate results of iterative operators, as files all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from faultline.session import ensure_checkpoint_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back.

    Later steps start from the files, also after an executor is lost; the plan starts anew, so
    planning does not slow down with the number of steps. The schema is given, not read from the
    files, so an empty result reads back as one.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/faultline/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
