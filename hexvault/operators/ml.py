"""Model-based designed operators on pyspark.ml (iterative; checked by rows and invariants).

* ``courier_clusters`` – KMeans over per-courier aggregates (mean speed, pings,
  distinct cells), features standardised; cluster id per courier.
* ``als_factors`` – implicit-feedback ALS on user × item interaction counts
  (the candidate model is re-aimed from two-tower to ALS); returns item factors.
Both train on distributed aggregates; ids are numbered on the cluster.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexvault.session import cut_lineage

SEED = 7


def courier_profiles(telemetry: DataFrame) -> DataFrame:
    return telemetry.groupBy("hk_courier_id").agg(
        F.avg("speed_kmh").alias("mean_speed"), F.count(F.lit(1)).cast("double").alias("pings"),
        F.approx_count_distinct("h3_res9").cast("double").alias("cells"))


def courier_clusters(telemetry: DataFrame, k: int = 3) -> DataFrame:
    prof = cut_lineage(courier_profiles(telemetry))  # one row a courier, read by every step of the fit
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["mean_speed", "pings", "cells"], outputCol="raw"),
                            StandardScaler(inputCol="raw", outputCol="features", withMean=True),
                            KMeans(k=k, seed=SEED, featuresCol="features", predictionCol="cluster")])
    model = pipe.fit(prof)
    return model.transform(prof).select("hk_courier_id", "mean_speed", "pings", "cells", "cluster")


def numbered(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``key, name``: the distinct keys with consecutive integers from 0, given on the cluster.

    A key's number is its place in its partition plus the sizes of the partitions before.
    Place and partition are checkpointed first, so the numbers stay the same wherever they
    are read; the sizes are one row per partition.
    """
    placed = cut_lineage(rows.select(key).filter(F.col(key).isNotNull()).distinct().select(
        key, F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_place")))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return cut_lineage(placed.join(F.broadcast(starts), "_part")
                       .select(key, (F.col("_start") + F.col("_place")).cast("int").alias(name)))


def als_factors(clicks: DataFrame, rank: int = 8, max_iter: int = 5) -> DataFrame:
    counts = clicks.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).cast("float").alias("n"))
    users, items = numbered(counts, "user_id", "u"), numbered(counts, "item_id", "i")
    data = counts.join(users, "user_id").join(items, "item_id").select("u", "i", "n")
    als = ALS(userCol="u", itemCol="i", ratingCol="n", implicitPrefs=True, rank=rank, maxIter=max_iter,
              seed=SEED, coldStartStrategy="drop")
    model = als.fit(data)
    factors = model.itemFactors.select(F.col("id").alias("i"), F.col("features").alias("factors"))
    return factors.join(items, "i").select("item_id", "factors")
