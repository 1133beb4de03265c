"""Hash-distributed model tables: bucketed and sorted by key, hot keys kept apart.

Tables that are joined on one key are written with the same number of buckets of that
key, so the join reads bucket by bucket without an exchange, as often as the release is
queried. A bucket holds whole keys; a key with more rows than ``hot_rows`` would make
its bucket a hot spot, so its rows are written to a plain table beside, in many files,
and meet the few rows of the other side through a broadcast. There are at most
``rows / hot_rows`` hot keys, which bounds what is broadcast.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a bucket, and rows from which a key is hot.
BUCKET_ROWS, HOT_ROWS = 4_000_000, 4_000_000


@dataclass
class Distributed:
    """A stored table: ``even`` in buckets of ``key``, ``hot`` rows spread, ``hot_keys`` one row each."""

    key: str
    even: DataFrame
    hot: DataFrame
    hot_keys: DataFrame

    def all_rows(self) -> DataFrame:
        return self.even.unionByName(self.hot)


def buckets_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """A power of two, so that tables of different size keep buckets that fit each other."""
    return 1 << max(2, (-(-rows // bucket_rows) - 1).bit_length())


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def distribute(df: DataFrame, key: str, root: str, name: str, buckets: int, hot_rows: int = HOT_ROWS) -> Distributed:
    """Write ``df`` under ``root/name`` and return the stored table (see the module's text)."""
    spark = df.sparkSession
    path = os.path.join(root, name)
    hot_keys = (df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
                .select(F.col(key).alias("_hot")))
    hot_keys.write.mode("overwrite").parquet(f"{path}/hot_keys")
    hot_keys = spark.read.parquet(f"{path}/hot_keys")
    on_key = _same(F.col(key), F.col("_hot"))
    few = F.broadcast(hot_keys)  # at most rows / hot_rows of them
    table = f"{name}_{uuid.uuid4().hex}"
    (df.join(few, on_key, "left_anti").repartition(buckets, key).write.mode("overwrite")
     .bucketBy(buckets, key).sortBy(key).option("path", f"{path}/even").saveAsTable(table))
    df.join(few, on_key, "left_semi").write.mode("overwrite").parquet(f"{path}/hot")
    return Distributed(key, spark.table(table), spark.read.schema(df.schema).parquet(f"{path}/hot"), hot_keys)


def join_distributed(many: Distributed, one: Distributed, how: str = "inner") -> DataFrame:
    """Join on the key; ``one`` has one row (or few) per key, and both have equal buckets.

    The even rows join without an exchange; hot rows of ``many`` join the broadcast rows
    that ``one`` has for their keys.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins keep the hot rows apart")
    key = many.key
    right = one.all_rows().withColumnRenamed(one.key, "_one")
    even_right = one.even.withColumnRenamed(one.key, "_one")
    even = many.even.join(even_right.hint("merge"), F.col(key) == F.col("_one"), how)
    on_hot = right.join(F.broadcast(many.hot_keys), _same(F.col("_one"), F.col("_hot")), "left_semi")
    hot = many.hot.join(F.broadcast(on_hot), F.col(key) == F.col("_one"), how)
    return even.unionByName(hot).drop("_one")
