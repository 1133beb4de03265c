"""Data-quality checks as DataFrames of violations, and the build gate.

Every check returns the *violating rows* (empty = pass), so a failure can be
inspected, counted or written. ``DECLARED_TESTS`` lists the tests the model
build must pass; ``gate_results`` evaluates all of them into one frame of
``(test_name, kind, model, violations)`` and ``assert_gate`` raises on failure.

Scale notes: all ``not_null`` tests of one table run as a single aggregate pass;
uniqueness and key-set checks are hash aggregates with map-side combine (hot keys
are pre-aggregated); referential checks are left-anti joins against the distinct
parent keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexvault.functions.hashing import packed_hash, with_packed_hashes
from hexvault.schemas import (COURIER_STATUSES, EVENT_TYPES, RESOLUTIONS, SOURCE_TYPE_RULES,
                              sql_type_name)


# --- generic checks -------------------------------------------------------------------

def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One pass: ``(column, null_count)`` for each listed column."""
    aggs = [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c) for c in columns]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, null_count)") \
               .withColumn("null_count", F.coalesce(F.col("null_count"), F.lit(0).cast("bigint")))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Duplicated non-null values: ``(unique_field, n_records)``; nulls are ignored."""
    return (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
              .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Duplicated key sets (nulls group together): ``(*columns, row_count)``."""
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
              .filter(F.col("row_count") > 1))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Distinct values outside the domain with their counts; null passes."""
    return (df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("value_field").isNotNull() & ~F.col("value_field").isin(values)))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Orphan child keys: ``(from_field, n_records)`` for non-null keys absent from the parent.

    Child rows are counted per key before the anti join (map-side combine), so a
    key that holds a third of the child rows reaches the join as one row.
    """
    keys = parent.select(F.col(parent_column).alias("_to")).distinct()
    counted = (child.select(F.col(column).alias("from_field")).filter(F.col("from_field").isNotNull())
                    .groupBy("from_field").agg(F.count(F.lit(1)).alias("n_records")))
    return counted.join(keys, F.col("from_field") == F.col("_to"), "left_anti")


def invalid_columns(df: DataFrame, types: dict[str, list[str]]) -> list[str]:
    """``name:TYPE`` of the missing or mis-typed columns."""
    actual = {f.name: sql_type_name(f.dataType) for f in df.schema.fields}
    return [f"{name}:{actual.get(name, 'MISSING')}" for name, allowed in types.items()
            if actual.get(name, "MISSING") not in allowed]


def schema_conforms(spark: SparkSession, df: DataFrame, types: dict[str, list[str]]) -> DataFrame:
    """One row listing ``name:TYPE`` of missing/mis-typed columns; empty when conforming."""
    invalid = invalid_columns(df, types)
    return spark.createDataFrame([(", ".join(invalid),)] if invalid else [], "invalid_columns string")


def _bad_coordinates() -> Column:
    lat, lon = F.col("latitude"), F.col("longitude")
    return (lat.isNull() | lon.isNull() | ~lat.between(-90, 90) | ~lon.between(-180, 180))


def _bad_interaction() -> Column:
    return _bad_coordinates() | (F.col("dwell_time_ms") < 0)


def _bad_ping() -> Column:
    b = F.col("bearing_deg")
    return _bad_coordinates() | (F.col("speed_kmh") < 0) | (b < 0) | (b >= 360)


def invalid_interaction_coordinates(stg_interactions: DataFrame) -> DataFrame:
    """Null or out-of-range coordinates, or negative dwell (a null dwell passes here)."""
    return stg_interactions.filter(F.coalesce(_bad_interaction(), F.lit(False))).select("hk_interaction_id")


def invalid_courier_coordinates(stg_courier_telemetry: DataFrame) -> DataFrame:
    """Null or out-of-range coordinates, negative speed, bearing outside [0, 360)."""
    return stg_courier_telemetry.filter(F.coalesce(_bad_ping(), F.lit(False))).select("hk_courier_id")


def fact_missing_interactions(stg_interactions: DataFrame, fct: DataFrame) -> DataFrame:
    """Staged interactions absent from the fact (left-anti)."""
    return (stg_interactions.select("hk_interaction_id")
            .join(fct.select("hk_interaction_id"), "hk_interaction_id", "left_anti"))


def rollup_not_conserved(fct: DataFrame, mart: DataFrame) -> DataFrame:
    """Resolutions whose mart total differs from the fact's non-null cell count."""
    expected = fct.agg(F.count("h3_res7").alias("r7"), F.count("h3_res9").alias("r9")).selectExpr(
        "stack(2, 7, r7, 9, r9) AS (resolution, events)")
    actual = mart.groupBy("resolution").agg(F.sum("event_count").alias("actual"))
    return (expected.join(actual, "resolution", "left")
                    .filter(F.col("events") != F.coalesce(F.col("actual"), F.lit(0)))
                    .select("resolution"))


# --- declared tests ---------------------------------------------------------------------

@dataclass(frozen=True)
class Test:
    kind: str
    model: str
    column: str | None = None
    args: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def name(self) -> str:
        parts = [self.kind, self.model]
        if self.column:
            parts.append(self.column)
        if self.kind == "relationships":
            parts.append(self.args["to"])
        if self.kind == "unique_combination":
            parts.append("_".join(self.args["columns"]))
        return "__".join(parts)


def _declare() -> list[Test]:
    t: list[Test] = []
    nn = lambda m, *cs: t.extend(Test("not_null", m, c) for c in cs)
    un = lambda m, *cs: t.extend(Test("unique", m, c) for c in cs)
    for m, k, b in (("stg_users", "hk_user_id", "user_id"), ("stg_merchants", "hk_merchant_id", "merchant_id"),
                    ("stg_couriers", "hk_courier_id", "courier_id")):
        nn(m, k, b, "first_seen_at")
        un(m, k, b)
    nn("stg_interaction_links", "hk_interaction_id", "hk_user_id", "hk_merchant_id")
    un("stg_interaction_links", "hk_interaction_id")
    t.append(Test("relationships", "stg_interaction_links", "hk_user_id",
                  {"to": "stg_users", "field": "hk_user_id"}))
    t.append(Test("relationships", "stg_interaction_links", "hk_merchant_id",
                  {"to": "stg_merchants", "field": "hk_merchant_id"}))
    nn("stg_interactions", "hk_interaction_id", "load_date", "event_type")
    un("stg_interactions", "hk_interaction_id")
    t.append(Test("relationships", "stg_interactions", "hk_interaction_id",
                  {"to": "stg_interaction_links", "field": "hk_interaction_id"}))
    t.append(Test("accepted_values", "stg_interactions", "event_type", {"values": EVENT_TYPES}))
    nn("stg_courier_telemetry", "hk_courier_id", "load_date", "status")
    t.append(Test("relationships", "stg_courier_telemetry", "hk_courier_id",
                  {"to": "stg_couriers", "field": "hk_courier_id"}))
    t.append(Test("accepted_values", "stg_courier_telemetry", "status", {"values": COURIER_STATUSES}))
    t.append(Test("unique_combination", "stg_courier_telemetry", None,
                  {"columns": ["hk_courier_id", "load_date"]}))
    nn("current_courier_positions", "hk_courier_id", "courier_id")
    un("current_courier_positions", "hk_courier_id", "courier_id")
    nn("fct_interactions", "hk_interaction_id", "hk_user_id", "hk_merchant_id")
    un("fct_interactions", "hk_interaction_id")
    nn("mart_h3_demand_hourly", "h3_cell", "resolution", "event_hour", "event_count")
    t.append(Test("accepted_values", "mart_h3_demand_hourly", "resolution", {"values": RESOLUTIONS}))
    t.append(Test("unique_combination", "mart_h3_demand_hourly", None,
                  {"columns": ["h3_cell", "resolution", "event_hour", "event_type"]}))
    nn("mart_user_merchant_affinity", "hk_user_id", "hk_merchant_id")
    t.append(Test("unique_combination", "mart_user_merchant_affinity", None,
                  {"columns": ["hk_user_id", "hk_merchant_id"]}))
    # source tests
    nn("hub_user", "hk_user_id", "user_id", "load_date", "record_source")
    nn("hub_merchant", "hk_merchant_id", "merchant_id", "load_date", "record_source")
    nn("hub_courier", "hk_courier_id", "courier_id", "load_date", "record_source")
    nn("link_user_merchant_interaction", "hk_interaction_id", "hk_user_id", "hk_merchant_id",
       "load_date", "record_source")
    nn("sat_interaction_context_spatial", "hk_interaction_id", "load_date", "event_type",
       "device_type", "dwell_time_ms", "latitude", "longitude", "h3_res7", "h3_res9", "record_source")
    nn("sat_courier_telemetry_spatial", "hk_courier_id", "load_date", "latitude", "longitude",
       "speed_kmh", "bearing_deg", "status", "h3_res7", "h3_res9", "record_source")
    for src, rules in SOURCE_TYPE_RULES.items():
        t.append(Test("schema_conforms", src, None, {"types": rules}))
    # singular tests
    t.append(Test("singular", "valid_interaction_coordinates"))
    t.append(Test("singular", "valid_courier_coordinates"))
    t.append(Test("singular", "fact_preserves_interactions"))
    t.append(Test("singular", "h3_rollup_conserves_counts"))
    return t


DECLARED_TESTS: list[Test] = _declare()


def violations(test: Test, models) -> DataFrame:
    """Violating rows of one declared test; ``models`` maps names to DataFrames."""
    if test.kind == "not_null":
        return not_null(models[test.model], test.column)
    if test.kind == "unique":
        return unique(models[test.model], test.column)
    if test.kind == "unique_combination":
        return unique_combination(models[test.model], test.args["columns"])
    if test.kind == "accepted_values":
        return accepted_values(models[test.model], test.column, test.args["values"])
    if test.kind == "relationships":
        return relationships(models[test.model], test.column, models[test.args["to"]],
                             test.args["field"])
    if test.kind == "schema_conforms":
        df = models[test.model]
        return schema_conforms(df.sparkSession, df, test.args["types"])
    if test.kind == "singular":
        if test.model == "valid_interaction_coordinates":
            return invalid_interaction_coordinates(models["stg_interactions"])
        if test.model == "valid_courier_coordinates":
            return invalid_courier_coordinates(models["stg_courier_telemetry"])
        if test.model == "fact_preserves_interactions":
            return fact_missing_interactions(models["stg_interactions"], models["fct_interactions"])
        if test.model == "h3_rollup_conserves_counts":
            return rollup_not_conserved(models["fct_interactions"], models["mart_h3_demand_hourly"])
    raise ValueError(f"Unknown test: {test}")


_COORDINATE_TABLES = {"valid_interaction_coordinates": "stg_interactions",
                      "valid_courier_coordinates": "stg_courier_telemetry"}


def _row_count_of(test: Test) -> Column | None:
    """The test's violations as an aggregate of its own table, or None if it needs more than one pass."""
    if test.kind == "not_null":
        return F.sum(F.col(test.column).isNull().cast("bigint"))
    if test.kind == "accepted_values":  # distinct foreign values; null passes
        return F.countDistinct(F.when(~F.col(test.column).isin(test.args["values"]), F.col(test.column)))
    if test.model == "valid_interaction_coordinates":
        return F.sum(F.coalesce(_bad_interaction(), F.lit(False)).cast("bigint"))
    if test.model == "valid_courier_coordinates":
        return F.sum(F.coalesce(_bad_ping(), F.lit(False)).cast("bigint"))
    return None


def _key_domains(slots: list[tuple[str, str]], tests: list[Test]) -> dict[tuple[str, str], int]:
    """Number of the key domain of each (table, column): a child column shares its parent's."""
    domain = {slot: i for i, slot in enumerate(slots)}
    for t in tests:
        if t.kind == "relationships":
            mine, other = domain[t.model, t.column], domain[t.args["to"], t.args["field"]]
            domain = {s: other if d == mine else d for s, d in domain.items()}
    return domain


def key_results(models, tests: list[Test]) -> DataFrame:
    """One row ``v0, v1, ...``: violations of single-column ``unique`` and ``relationships`` tests.

    Every table is read once for all its key columns. Keys of all tables are counted in
    one grouping by (domain, key), with one count per table and column: a key that stands
    twice in a column is a duplicate, one that the parent column lacks is an orphan. Keys
    combine before the shuffle, so a hot key arrives as one row per task, and hashes go
    through it packed. Null keys pass.
    """
    slots = sorted({(t.model, t.column) for t in tests}
                   | {(t.args["to"], t.args["field"]) for t in tests if t.kind == "relationships"})
    domain = _key_domains(slots, tests)
    reads = []
    for table in dict.fromkeys(m for m, _ in slots):
        keys = [F.struct(F.lit(domain[s]).alias("domain"), F.lit(i).alias("slot"),
                         packed_hash(F.col(s[1]).cast("string")).alias("key")) for i, s in enumerate(slots) if s[0] == table]
        reads.append(models[table].select(F.explode(F.array(*keys)).alias("k")).select("k.*"))
    counted = (reduce(DataFrame.unionAll, reads).filter(F.col("key").isNotNull()).groupBy("domain", "key")
               .agg(*[F.count(F.when(F.col("slot") == i, 1)).alias(f"n{i}") for i in range(len(slots))]))
    place = {s: F.col(f"n{i}") for i, s in enumerate(slots)}
    found = []
    for t in tests:
        n = place[t.model, t.column]
        if t.kind == "unique":  # duplicated keys
            found.append(F.sum((n > 1).cast("bigint")))
        else:  # orphan rows
            found.append(F.sum(F.when(place[t.args["to"], t.args["field"]] == 0, n).otherwise(0)))
    return counted.agg(*[F.coalesce(v, F.lit(0)).cast("bigint").alias(f"v{i}") for i, v in enumerate(found)])


def _test_rows(wide: DataFrame, tests: list[Test]) -> DataFrame:
    """``test_name, kind, model, violations`` from one row ``v0, v1, ...``."""
    rows = F.explode(F.array(*[F.struct(
        F.lit(t.name).alias("test_name"), F.lit(t.kind).alias("kind"), F.lit(t.model).alias("model"),
        F.col(f"v{i}").alias("violations")) for i, t in enumerate(tests)]))
    return wide.select(rows.alias("r")).select("r.*")


class _Packed:
    """Tables with short hash keys, for violations that are only counted."""

    def __init__(self, models):
        self.models = models

    def __getitem__(self, name: str) -> DataFrame:
        return with_packed_hashes(self.models[name])


def gate_results(models, tests: list[Test] | None = None) -> DataFrame:
    """All declared tests → ``(test_name, kind, model, violations)``.

    Null, domain and coordinate tests of a table share one pass over it (one domain
    test a table, so that the pass needs no row expansion); uniqueness of single columns
    and relationships share one grouping of keys (``key_results``); schema tests read
    schemas only; the rest are one aggregate each. All branches form one plan.
    """
    tests = DECLARED_TESTS if tests is None else tests
    shared: dict[str, list[Test]] = {}
    alone: list[Test] = []
    keyed = [t for t in tests if t.kind in ("unique", "relationships")]
    typed = [t for t in tests if t.kind == "schema_conforms"]
    for t in tests:
        if t in keyed or t in typed:
            continue
        table = _COORDINATE_TABLES.get(t.model, t.model)
        taken = any(x.kind == "accepted_values" for x in shared.get(table, []))
        if _row_count_of(t) is None or (t.kind == "accepted_values" and taken):
            alone.append(t)
        else:
            shared.setdefault(table, []).append(t)
    parts: list[DataFrame] = []
    for table, ts in shared.items():
        parts.append(_test_rows(models[table].agg(*[
            F.coalesce(_row_count_of(t), F.lit(0)).cast("bigint").alias(f"v{i}") for i, t in enumerate(ts)]), ts))
    if keyed:
        parts.append(_test_rows(key_results(models, keyed), keyed))
    if typed:
        spark = models[typed[0].model].sparkSession
        counts = [F.lit(int(bool(invalid_columns(models[t.model], t.args["types"])))).cast("bigint").alias(f"v{i}")
                  for i, t in enumerate(typed)]
        parts.append(_test_rows(spark.range(0, 1, 1, 1).select(*counts), typed))
    for t in alone:
        v = violations(t, _Packed(models)).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(v.select(F.lit(t.name).alias("test_name"), F.lit(t.kind).alias("kind"),
                              F.lit(t.model).alias("model"), "violations"))
    return reduce(DataFrame.unionByName, parts)


class QualityGateError(RuntimeError):
    def __init__(self, failed: list[tuple[str, int]]):
        self.failed = failed
        super().__init__("Quality gate failed: " + ", ".join(f"{n}={v}" for n, v in failed))


def assert_gate(models, tests: list[Test] | None = None) -> list[tuple[str, int]]:
    """Run the gate; raise ``QualityGateError`` listing failing tests. Returns all results.

    Only the small result frame (one row per test) reaches the driver.
    """
    rows = [(r["test_name"], int(r["violations"])) for r in gate_results(models, tests).collect()]
    failed = [(n, v) for n, v in rows if v > 0]
    if failed:
        raise QualityGateError(failed)
    return rows


def require_test_failure(models, test_name: str) -> int:
    """Assert that the named declared test fails (for fault-injection checks); returns its count.

    Raises ``AssertionError`` when the test passes or does not exist, so a
    corruption is only accepted as caught by the test that should catch it.
    """
    tests = [t for t in DECLARED_TESTS if t.name == test_name]
    if not tests:
        raise AssertionError(f"Unknown test {test_name}")
    n = gate_results(models, tests).first()["violations"]
    if not n:
        raise AssertionError(f"{test_name} did not fail")
    return int(n)
