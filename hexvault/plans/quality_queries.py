"""Registered data-quality queries (violations over the whole model build)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexvault import oracle as O
from hexvault.operators import quality as Q
from hexvault.plans.context import Context
from hexvault.plans.registry import register

T = Q.DECLARED_TESTS
_NN = [t for t in T if t.kind == "not_null"]
_UN = [t for t in T if t.kind == "unique"]
_AV = [t for t in T if t.kind == "accepted_values"]
_RL = [t for t in T if t.kind == "relationships"]
_UC = [t for t in T if t.kind == "unique_combination"]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@register("dq_gate_summary", O.gate_sql(T))
def _q(c: Context):
    """All 97 declared tests with their violation counts, over a materialised build."""
    return Q.gate_results(c.build_models())


@register("dq_not_null", O.with_chain(" UNION ALL ".join(
    f"SELECT '{t.model}' AS model, '{t.column}' AS column_name, count(*) AS null_count "
    f"FROM ({O.violation_rows_sql(t)})" for t in _NN)))
def _q(c: Context):
    """Null counts of the 66 not-null declarations (one pass per table)."""
    by_model: dict[str, list[str]] = {}
    for t in _NN:
        by_model.setdefault(t.model, []).append(t.column)
    return _union([Q.null_counts(c.models[m], cols).select(F.lit(m).alias("model"), "column_name", "null_count")
                   for m, cols in by_model.items()])


@register("dq_unique", O.with_chain(" UNION ALL ".join(
    f"SELECT '{t.name}' AS test_name, CAST(unique_field AS VARCHAR) AS unique_field, n_records "
    f"FROM ({O.violation_rows_sql(t)})" for t in _UN)))
def _q(c: Context):
    """Duplicated keys of the 11 uniqueness declarations."""
    return _union([Q.violations(t, c.models).select(
        F.lit(t.name).alias("test_name"), F.col("unique_field").cast("string").alias("unique_field"),
        "n_records") for t in _UN])


_TIMES = ("load_date", "event_hour")


def _key_sql(columns: list[str]) -> str:
    parts = [f"coalesce(CAST({f'epoch_us({x})' if x in _TIMES else x} AS VARCHAR), 'null')" for x in columns]
    return "concat_ws('|', " + ", ".join(parts) + ")"


def _key(columns: list[str]):
    text = lambda x: (F.unix_micros(F.col(x).cast("timestamp")) if x in _TIMES else F.col(x)).cast("string")
    return F.concat_ws("|", *[F.coalesce(text(x), F.lit("null")) for x in columns])


@register("dq_unique_combination", O.with_chain(" UNION ALL ".join(
    f"SELECT '{t.model}' AS model, {_key_sql(t.args['columns'])} AS key, row_count FROM ({O.violation_rows_sql(t)})"
    for t in _UC)))
def _q(c: Context):
    """Key sets that occur more than once, for each of the three declared combinations."""
    return _union([Q.violations(t, c.models).select(
        F.lit(t.model).alias("model"), _key(t.args["columns"]).alias("key"), "row_count") for t in _UC])


@register("dq_accepted_values", O.with_chain(" UNION ALL ".join(
    f"SELECT '{t.name}' AS test_name, CAST(value_field AS VARCHAR) AS value_field, n_records "
    f"FROM ({O.violation_rows_sql(t)})" for t in _AV)))
def _q(c: Context):
    """Values outside the declared domains (e.g. the 'error' event type)."""
    return _union([Q.violations(t, c.models).select(
        F.lit(t.name).alias("test_name"), F.col("value_field").cast("string").alias("value_field"),
        "n_records") for t in _AV])


@register("dq_relationships", O.with_chain(" UNION ALL ".join(
    f"SELECT '{t.name}' AS test_name, from_field, n_records FROM ({O.violation_rows_sql(t)})" for t in _RL)))
def _q(c: Context):
    """Orphan child keys (with their row counts) of the 4 referential declarations."""
    return _union([Q.violations(t, c.models).select(F.lit(t.name).alias("test_name"), "from_field", "n_records")
                   for t in _RL])


@register("dq_coordinates", O.with_chain(
    f"SELECT 'valid_interaction_coordinates' AS test_name, hk_interaction_id AS key "
    f"FROM ({O.SINGULAR_SQL['valid_interaction_coordinates']}) UNION ALL "
    f"SELECT 'valid_courier_coordinates', hk_courier_id FROM ({O.SINGULAR_SQL['valid_courier_coordinates']})"))
def _q(c: Context):
    a = Q.invalid_interaction_coordinates(c.models["stg_interactions"]).select(
        F.lit("valid_interaction_coordinates").alias("test_name"), F.col("hk_interaction_id").alias("key"))
    b = Q.invalid_courier_coordinates(c.models["stg_courier_telemetry"]).select(
        F.lit("valid_courier_coordinates").alias("test_name"), F.col("hk_courier_id").alias("key"))
    return a.unionByName(b)


@register("dq_fact_preserved", O.with_chain(O.SINGULAR_SQL["fact_preserves_interactions"]))
def _q(c: Context):
    return Q.fact_missing_interactions(c.models["stg_interactions"], c.models["fct_interactions"])


@register("dq_rollup_conserved", O.with_chain(O.SINGULAR_SQL["h3_rollup_conserves_counts"]))
def _q(c: Context):
    return Q.rollup_not_conserved(c.models["fct_interactions"], c.models["mart_h3_demand_hourly"])
