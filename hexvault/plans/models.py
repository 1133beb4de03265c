"""The model graph: staging → business vault → marts, in dependency order.

A ``Models`` object is a lazy, memoised mapping from model name to DataFrame built
over one ``Vault``. ``build`` materialises every model into a versioned folder
(one sub-folder per model), which is what a release publishes.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from hexvault.functions.hashing import with_hashes, with_packed_hashes
from hexvault.operators import marts, staging
from hexvault.operators.sequence import dealt
from hexvault.operators.vault import Vault

# name → (dependencies, builder); dependencies are vault tables or other models.
MODEL_GRAPH: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "stg_users": (("hub_user",), staging.stg_users),
    "stg_merchants": (("hub_merchant",), staging.stg_merchants),
    "stg_couriers": (("hub_courier",), staging.stg_couriers),
    "stg_interaction_links": (("link_user_merchant_interaction",), staging.stg_interaction_links),
    "stg_interactions": (("sat_interaction_context_spatial",), staging.stg_interactions),
    "stg_courier_telemetry": (("sat_courier_telemetry_spatial",), staging.stg_courier_telemetry),
    # Latest row per courier read straight from the satellite: exact replays cannot
    # change a minimum, so the staging DISTINCT (a full shuffle) is not needed here.
    "current_courier_positions": (("sat_courier_telemetry_spatial", "stg_couriers"),
                                  marts.current_courier_positions),
    "fct_interactions": (("stg_interactions", "stg_interaction_links", "stg_users", "stg_merchants"),
                         marts.fct_interactions),
    "mart_h3_demand_hourly": (("fct_interactions",), marts.mart_h3_demand_hourly),
    "mart_user_merchant_affinity": (("fct_interactions",), marts.mart_user_merchant_affinity),
}

# Models whose rows are built by key (and time chunk of a large one): columns, key and time. Rows of a
# key then share its bytes in the shuffle and its tasks in every grouping of the written table.
DEALT_BY = {"stg_courier_telemetry": (staging.TELEMETRY_COLUMNS, "hk_courier_id", "load_date")}

#: Of built tables: hash texts are most of their bytes, and take little more than half of those of the default.
COMPRESSION = "zstd"

# Output clustering key per model (rows are sorted on it within each written file).
DISTRIBUTED_BY = {
    "stg_users": "hk_user_id", "stg_merchants": "hk_merchant_id", "stg_couriers": "hk_courier_id",
    "stg_interaction_links": "hk_interaction_id", "stg_interactions": "hk_interaction_id",
    "stg_courier_telemetry": "hk_courier_id", "current_courier_positions": "hk_courier_id",
    "fct_interactions": "hk_interaction_id", "mart_h3_demand_hourly": "h3_cell",
    "mart_user_merchant_affinity": "hk_user_id",
}


def topological_order() -> list[str]:
    done: list[str] = []

    def visit(name: str, stack: tuple[str, ...] = ()):
        if name in done or name not in MODEL_GRAPH:
            return
        if name in stack:
            raise ValueError(f"Cycle in model graph at {name}")
        for dep in MODEL_GRAPH[name][0]:
            visit(dep, stack + (name,))
        done.append(name)

    for n in MODEL_GRAPH:
        visit(n)
    return done


class Models:
    """Lazy model DataFrames over one vault snapshot."""

    def __init__(self, vault: Vault, overrides: dict[str, DataFrame] | None = None):
        self.vault = vault
        self._cache: dict[str, DataFrame] = dict(overrides or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        if name in Vault.NAMES:
            return self.vault[name]
        if name not in MODEL_GRAPH:
            raise KeyError(name)
        deps, fn = MODEL_GRAPH[name]
        df = fn(*[self[d] for d in deps])
        self._cache[name] = df
        return df

    def names(self) -> list[str]:
        return topological_order()

    @classmethod
    def from_folder(cls, spark, vault: Vault, root: str) -> "Models":
        """Models already written under ``root/<model>`` (a published release)."""
        return cls(vault, {n: spark.read.parquet(os.path.join(root, n)) for n in MODEL_GRAPH})

    def build(self, root: str, names: list[str] | None = None, parallel: int = 6) -> "Models":
        """Write each model and return Models that read the files.

        Models are written level by level in dependency order; the models of one
        level are independent and are submitted as concurrent Spark jobs. Each model
        is read back from its files before its dependants are built, so a failure
        re-runs from written tables rather than from the raw vault.
        """
        spark = self.vault["hub_user"].sparkSession
        built: dict[str, DataFrame] = {}
        todo = [n for n in self.names() if n in (names or self.names())]

        def write(name: str) -> None:
            deps, fn = MODEL_GRAPH[name]
            # Hash keys are half as long while the models are grouped and joined.
            inputs = [with_packed_hashes(built[d] if d in built else self[d]) for d in deps]
            if name in DEALT_BY:
                columns, key, time = DEALT_BY[name]
                inputs = [dealt(i.select(*columns), key, time) for i in inputs]
            df = with_hashes(fn(*inputs).drop("_chunk"))
            # Cluster rows by the distribution key inside each file (row-group min/max
            # pruning) without a hash repartition: a hot key must not become one task.
            (df.sortWithinPartitions(DISTRIBUTED_BY[name]).write.mode("overwrite")
             .option("compression", COMPRESSION).parquet(os.path.join(root, name)))

        for level in levels(todo):
            with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(level)))) as pool:
                list(pool.map(write, level))
            for name in level:
                built[name] = spark.read.parquet(os.path.join(root, name))
        return Models(self.vault, built)


def materialize_vault(vault: Vault, root: str, drop: tuple[str, ...] = ("geom_wkb",),
                      parallel: int = 6) -> Vault:
    """Write the six vault tables once (concurrent jobs) and return a Vault over the files.

    Columns in ``drop`` are left out (the WKB point is not read by any model or
    test), so every downstream model and source test reads stored tables instead
    of re-deriving the vault from the raw events.
    """
    spark = vault["hub_user"].sparkSession

    def write(name: str) -> None:
        df = vault[name]
        (df.drop(*[c for c in drop if c in df.columns]).write.mode("overwrite")
         .option("compression", COMPRESSION).parquet(os.path.join(root, name)))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(write, Vault.NAMES))
    return Vault({n: spark.read.parquet(os.path.join(root, n)) for n in Vault.NAMES})


def levels(names: list[str]) -> list[list[str]]:
    """Group models into dependency levels (a model's dependencies are in earlier levels)."""
    depth: dict[str, int] = {}
    for n in topological_order():
        deps = [d for d in MODEL_GRAPH[n][0] if d in MODEL_GRAPH]
        depth[n] = 1 + max((depth[d] for d in deps), default=-1)
    out: dict[int, list[str]] = {}
    for n in names:
        out.setdefault(depth[n], []).append(n)
    return [out[k] for k in sorted(out)]
