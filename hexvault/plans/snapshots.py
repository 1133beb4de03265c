"""Stored point-in-time and bridge tables that rebuild only what new data touches.

Snapshots are stored in partitions of their date. A refresh takes the rows that arrived,
finds the earliest partition they touch, carries over what each key had before it (one
stored row a key) and rebuilds the partitions from there on; dynamic partition overwrite
replaces these and leaves the rest. New days come last, so they rewrite one partition;
a late day rewrites the days after it as well, as their running values change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexvault.operators import features as D
from hexvault.sources import files

GRAINS = ("day", "month")


def _replace(df: DataFrame, path: str, *partitions: str) -> None:
    """Overwrite the partitions that ``df`` has rows of; one task writes a partition's range of rows."""
    (df.repartitionByRange(*partitions, "order_key").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path))


class PitStore:
    """The point-in-time table of the order hub, by ``part`` (first day of the grain of a snapshot)."""

    def __init__(self, path: str, grain: str = "day"):
        if grain not in GRAINS:
            raise ValueError(f"unknown grain {grain!r}")
        self.path, self.grain = path, grain

    def _part(self, day):
        return F.trunc(day, "month") if self.grain == "month" else F.to_date(day)

    def read(self, spark) -> DataFrame:
        return spark.read.parquet(self.path).drop("part", "order_key")

    def refresh(self, orders: DataFrame, pings: DataFrame, arrived: DataFrame) -> list:
        """Bring the table up to ``pings`` after ``arrived`` (rows among them) came; returns the rebuilt parts.

        ``pings`` is the whole log; only the rows from the first touched part on are read
        from it if it is partitioned or sorted by time.
        """
        spark = orders.sparkSession
        day = F.to_date("event_time")
        first = arrived.filter(F.col("order_id").isNotNull()).agg(F.min(self._part(day))).first()[0]
        if first is None:
            return []
        begin = F.lit(first)
        seed = None
        if files.children(spark, self.path):
            stored = spark.read.parquet(self.path).filter(F.col("part") < begin)
            last = stored.groupBy("order_key").agg(F.max_by(
                F.struct("snapshot_date", "delivery_load_date", "pings_to_date"), "snapshot_date").alias("s"))
            seed = last.select("order_key", F.col("s.snapshot_date").cast("timestamp_ntz").alias("ts"),
                               F.col("s.delivery_load_date").alias("ping_ts"), F.col("s.pings_to_date").cast("int").alias("n"))
        else:
            seed = spark.createDataFrame([], "order_key long, ts timestamp_ntz, ping_ts timestamp_ntz, n int")
        later = pings.filter(day >= begin)
        rows = D.order_pit(orders, later, seed).withColumn("part", self._part(F.col("snapshot_date")))
        _replace(rows, self.path, "part")
        return [r[0] for r in spark.read.parquet(self.path).filter(F.col("part") >= begin)
                .select("part").distinct().orderBy("part").collect()]


class BridgeStore:
    """A bridge, stored in hash buckets of a key; a refresh rewrites the buckets it touches."""

    def __init__(self, path: str, key: str, buckets: int = 32):
        self.path, self.key, self.buckets = path, key, buckets

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets))

    def read(self, spark) -> DataFrame:
        return spark.read.parquet(self.path).drop("bucket")

    def refresh(self, spark, build, tables: list[DataFrame], touched: DataFrame) -> list[int]:
        """Rebuild the buckets of the ``touched`` keys: ``build`` is called on ``tables``, of which the
        first holds the key and is cut to those buckets before any join."""
        mine = [r[0] for r in touched.select(self._bucket().alias("b")).distinct().collect()]  # at most ``buckets``
        first, *others = tables
        rows = build(first.filter(self._bucket().isin(mine)), *others).withColumn("bucket", self._bucket())
        # Rows of a bucket are dealt over several tasks, so a hot key is no single one.
        (rows.repartitionByRange("bucket", *[c for c in rows.columns if c != "bucket"]).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path))
        return sorted(mine)
