"""One lazily-built world over a test-data folder: streams → vault → models → serving."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexvault.operators import staging
from hexvault.operators.sequence import dealt
from hexvault.operators.serving import ServingSource
from hexvault.operators.vault import Vault, with_event_time
from hexvault.plans.models import Models
from hexvault.sources import tables


class Context:
    """Surrogate event streams, vault, models and both serving sources for one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, self.sf_dir, name)

    @cached_property
    def clicks(self) -> DataFrame:
        return with_event_time(tables.clickstream(self.spark, self.sf_dir))

    @cached_property
    def clicks_once(self) -> DataFrame:
        """Clickstream without the at-least-once replays (one row per event)."""
        return with_event_time(tables.clickstream(self.spark, self.sf_dir, replay=False))

    @cached_property
    def clicks_with_category(self) -> DataFrame:
        """Events with their item category (item k ↔ part k + 1, category = part type)."""
        part = self.table("part").select((F.col("p_partkey") - 1).alias("_k"), F.col("p_type").alias("category"))
        c = self.clicks_once
        return c.join(part, tables.id_number("item_id", "ITM_") == F.col("_k"), "left").drop("_k")

    @cached_property
    def pings(self) -> DataFrame:
        return with_event_time(tables.telemetry(self.spark, self.sf_dir))

    @cached_property
    def vault(self) -> Vault:
        return Vault.from_events(lambda: self.clicks, lambda: self.pings)

    @cached_property
    def models(self) -> Models:
        return Models(self.vault)

    @cached_property
    def telemetry_in_order(self) -> DataFrame:
        """Staged telemetry, dealt out by courier (and time chunk of a large one) before its DISTINCT."""
        sat = self.vault["sat_courier_telemetry_spatial"].select(*staging.TELEMETRY_COLUMNS)
        return staging.stg_courier_telemetry(dealt(sat, "hk_courier_id", "load_date"))

    def build_models(self) -> Models:
        """Write the vault and every model into a fresh folder under the shared checkpoint dir.

        Used where many checks read the same tables (the quality gate): the vault
        and each model are computed once per call, and lineage is cut by the files.
        """
        import os
        import uuid
        from hexvault.plans.models import materialize_vault
        from hexvault.session import checkpoint_path
        root = checkpoint_path(self.spark, "builds", uuid.uuid4().hex)
        vault = materialize_vault(self.vault, os.path.join(root, "vault"))
        return Models(vault).build(os.path.join(root, "models"))

    @cached_property
    def raw(self) -> ServingSource:
        return ServingSource(self.vault, self.models, mode="raw")

    @cached_property
    def mart(self) -> ServingSource:
        return ServingSource(self.vault, self.models, mode="mart")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column half-up to ``digits`` (stable comparison of float sums)."""
    from hexvault.functions.spatial import round_half_up
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_half_up(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
