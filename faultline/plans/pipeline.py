"""Wiring of the layers for one input folder, and their publication.

``Layers`` builds each layer once as a lazy DataFrame; the only jobs run
while building are the size checks behind a broadcast.
``publish_layer`` writes a catalog table in the warehouse and ``materialize``
plain Parquet in the shared checkpoint folder; ``Layers.use`` then points later queries at the
published copies.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from faultline.operators.medallion import build_gold, build_silver
from faultline.session import ensure_checkpoint_dir
from faultline.sources.fixtures import Feeds
from faultline.sources.sinks import publish


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.feeds = Feeds(spark, sf_dir)
        self._silver: DataFrame | None = None
        self._gold: DataFrame | None = None
        self._alarms: DataFrame | None = None
        self._sites: DataFrame | None = None

    def alarms(self) -> DataFrame:
        return self.feeds.alarms() if self._alarms is None else self._alarms

    def sites(self) -> DataFrame:
        return self.feeds.sites() if self._sites is None else self._sites

    def silver(self) -> DataFrame:
        if self._silver is None:
            self._silver = build_silver(self.alarms(), self.sites())
        return self._silver

    def gold(self) -> DataFrame:
        if self._gold is None:
            self._gold = build_gold(self.silver())
        return self._gold

    def use(
        self,
        silver: DataFrame | None = None,
        gold: DataFrame | None = None,
        alarms: DataFrame | None = None,
        sites: DataFrame | None = None,
    ) -> "Layers":
        """Point later queries at published copies of the layers, or at other feeds."""
        if alarms is not None:
            self._alarms = alarms
        if sites is not None:
            self._sites = sites
        if silver is not None:
            self._silver = silver
        if gold is not None:
            self._gold = gold
        return self


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor recomputes from the written files,
    not from the raw feed) and gives later jobs exact statistics.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/faultline/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def publish_layer(
    df: DataFrame,
    table: str,
    bucket_by: tuple[int, str] | None = None,
    partition_by: list[str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Publish a layer as a catalog table in the session's warehouse, or under ``path``.

    Silver is published bucketed by ``alarm_id``, so later aggregations or joins on it read
    the buckets without an exchange. ``alarm_id`` is unique in Silver, so the buckets stay even;
    a skewed key such as ``site_id`` would make one bucket, and so one reading task, hold a hot
    site's rows. In the warehouse an older version's files go with it, unless the table is
    partitioned; under ``path`` each version has a folder of its own and its files stay until the
    owner removes them.
    """
    if path:
        path = f"{path.rstrip('/')}/{table.replace('.', '_')}-{uuid.uuid4().hex}"
    return publish(df, table, partition_by=partition_by, bucket_by=bucket_by, path=path)
