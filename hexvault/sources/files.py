"""Folders and small files on whatever store a path names, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; a missing folder has none."""
    store, place = _at(spark, path)
    if not store.exists(place):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(place))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder; raises if it is still there afterwards."""
    store, place = _at(spark, path)
    store.delete(place, True)
    if store.exists(place):
        raise OSError(f"could not delete {path}")


def committed(spark: SparkSession, path: str) -> bool:
    """Whether Spark finished writing the folder (an interrupted write has no marker)."""
    return exists(spark, f"{path}/_SUCCESS")


def committed_children(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names ``prefix...`` of finished folders under ``path``, sorted."""
    return [n for n in children(spark, path) if n.startswith(prefix) and committed(spark, f"{path}/{n}")]


def read_folders(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    """The rows of the given folders; none give an empty frame of the schema."""
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)
