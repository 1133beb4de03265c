"""Quantile sketches of a column, one per period and key, stored and merged.

A period (a day) is read once; its sketches are a few kilobytes a key. Percentiles and
drift over any window of periods merge stored sketches and read no rows again. The
sketches are Spark's own KLL aggregates, so they combine before the shuffle and a key
with a third of the rows costs one partial sketch per task.

A quantile of a sketch has a rank within ``rank_error(k)`` of the asked one (99 %
confidence; exact while a sketch holds at most ``k`` values). Nulls are not counted; a
key of nulls only has no quantiles (null).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of a sketch; its rank error is about 0.6 %.
SKETCH_K = 800
#: Smallest share of a bin in a drift index, as in ``features.psi_drift``.
MIN_SHARE = 1e-4


def rank_error(k: int = SKETCH_K) -> float:
    """Normalised rank error of a sketch of size ``k`` at 99 % confidence."""
    return 2.296 / k ** 0.9021


def period_sketches(rows: DataFrame, period: Column, keys: list[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """``period, *keys, sketch``: one sketch of ``value`` per period and key."""
    return rows.groupBy(period.alias("period"), *keys).agg(
        F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def write_periods(sketches: DataFrame, path: str) -> None:
    """Store sketches by period; periods that are written again replace their old ones."""
    (sketches.repartition("period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("period").parquet(path))


def read_periods(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def window_sketches(stored: DataFrame, keys: list[str], first, last) -> DataFrame:
    """``*keys, sketch``: the merged sketches of the periods from ``first`` to ``last``, both included."""
    inside = stored.filter(F.col("period").between(F.lit(first), F.lit(last)))
    return inside.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def held(sketch: str = "sketch") -> Column:
    """Number of values in a sketch."""
    return F.kll_sketch_get_n_double(sketch)


def quantile(p: float, sketch: str = "sketch") -> Column:
    return F.when(held(sketch) > 0, F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(float(p))))


def shares(sketch: str, edges: list[float]) -> list[Column]:
    """Share of the values up to the first edge, between edges (upper one included) and above the last."""
    ranks = [F.kll_sketch_get_rank_double(F.col(sketch), F.lit(float(e))) for e in edges]
    return [hi - lo for lo, hi in zip([F.lit(0.0), *ranks], [*ranks, F.lit(1.0)])]


def drift(reference: DataFrame, current: DataFrame, keys: list[str], edges: list[float]) -> DataFrame:
    """``*keys, ref_n, cur_n, psi``: population stability index of two windows from their sketches.

    Keys that stand in one window only, or hold nulls only there, have a null index.
    """
    j = (reference.select(*keys, F.col("sketch").alias("_r"))
         .join(current.select(*keys, F.col("sketch").alias("_c")), keys, "full"))
    terms = F.lit(0.0)
    for r, c in zip(shares("_r", edges), shares("_c", edges)):
        r, c = F.greatest(r, F.lit(MIN_SHARE)), F.greatest(c, F.lit(MIN_SHARE))
        terms = terms + (c - r) * F.log(c / r)
    both = (F.coalesce(held("_r"), F.lit(0)) > 0) & (F.coalesce(held("_c"), F.lit(0)) > 0)
    return j.select(*keys, F.coalesce(held("_r"), F.lit(0)).alias("ref_n"),
                    F.coalesce(held("_c"), F.lit(0)).alias("cur_n"), F.when(both, terms).alias("psi"))


def ranks_of(rows: DataFrame, keys: list[str], value: str, asked: DataFrame) -> DataFrame:
    """``*keys, name, below, upto``: exact shares of the rows below and up to values that sketches gave.

    ``asked`` holds ``*keys, name, at``, a few rows a key; rows are counted by value first.
    """
    counted = rows.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(
        F.count("*").alias("_n"))
    j = counted.join(asked, keys)
    less, same = F.col("_v") < F.col("at"), F.col("_v") <= F.col("at")
    return j.groupBy(*keys, "name").agg((F.sum(F.when(less, F.col("_n")).otherwise(0)) / F.sum("_n")).alias("below"),
                                        (F.sum(F.when(same, F.col("_n")).otherwise(0)) / F.sum("_n")).alias("upto"))


def exact_drift(rows: DataFrame, early: Column, keys: list[str], value: str, edges: list[float]) -> DataFrame:
    """``*keys, exact_psi``: the index of ``drift`` from all rows, to judge the sketches by."""
    known = rows.filter(F.col(value).isNotNull())
    place = F.lit(0)
    for e in edges:
        place = place + (F.col(value).cast("double") > e).cast("int")
    counts = known.groupBy(*keys).agg(*[
        F.sum(F.when((place == i) & when, 1).otherwise(0)).alias(f"{name}{i}")
        for i in range(len(edges) + 1) for name, when in (("r", early), ("c", ~early))])
    total = {n: sum((F.col(f"{n}{i}") for i in range(len(edges) + 1)), F.lit(0)) for n in "rc"}
    index = F.lit(0.0)
    for i in range(len(edges) + 1):
        r, c = (F.greatest(F.col(f"{n}{i}") / total[n], F.lit(MIN_SHARE)) for n in "rc")
        index = index + (c - r) * F.log(c / r)
    return counts.select(*keys, F.when((total["r"] > 0) & (total["c"] > 0), index).alias("exact_psi"))
