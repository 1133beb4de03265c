"""Golden fixtures: exact model values, corruption detection, serving edge cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import fixtures as FX
from hexvault import schemas as S
from hexvault.operators import monitor as MON
from hexvault.operators import quality as Q
from hexvault.operators.serving import ServingSource
from hexvault.plans.models import Models


def test_fixture_marts(spark):
    models = Models(FX.vault(spark))
    fact = models["fct_interactions"]
    assert fact.count() == 3
    mart = models["mart_h3_demand_hourly"]
    per_res = {r["resolution"]: (r["n"], r["dwell"]) for r in mart.groupBy("resolution").agg(
        F.sum("event_count").alias("n"), F.sum("total_dwell_time_ms").alias("dwell")).collect()}
    assert per_res == {7: (3, 600), 9: (3, 600)}
    pos = {r["courier_id"]: r["status"] for r in models["current_courier_positions"].collect()}
    assert pos == {"c1": "delivering", "c2": "idle"}
    aff = models["mart_user_merchant_affinity"].agg(
        F.sum("interaction_count").alias("i"), F.sum("purchase_count").alias("p")).first()
    assert (aff["i"], aff["p"]) == (3, 1)
    wm = {r["stream"]: r["watermark"] for r in MON.event_watermarks(models).collect()}
    assert wm == {"interactions": dt.datetime(2026, 10, 15, 11), "couriers": dt.datetime(2026, 10, 15, 10, 30)}


def test_gate_passes_on_clean_fixture(spark):
    rows = Q.assert_gate(Models(FX.vault(spark)))
    assert len(rows) == 97


def _failed(spark, rows=None, schemas=None) -> set[str]:
    models = Models(FX.vault(spark, rows=rows, schemas=schemas))
    return {r["test_name"] for r in Q.gate_results(models).collect() if r["violations"] > 0}


def test_conflicting_hub_key_caught_by_unique(spark):
    rows = FX.vault_rows()
    u1 = FX.md5u("u1")
    rows["hub_user"].append((u1, "conflicting_user", FX.at(10), FX.CLICK))
    failed = _failed(spark, rows)
    assert "unique__stg_users__hk_user_id" in failed


def test_orphan_link_caught_by_relationships(spark):
    rows = FX.vault_rows()
    rows["link_user_merchant_interaction"].append(
        (FX.md5u("i9"), FX.md5u("unknown"), FX.md5u("m1"), FX.at(12), FX.CLICK))
    failed = _failed(spark, rows)
    assert "relationships__stg_interaction_links__hk_user_id__stg_users" in failed


def test_ambiguous_courier_time_caught_by_unique_combination(spark):
    rows = FX.vault_rows()
    rows["sat_courier_telemetry_spatial"].append(
        (FX.md5u("c1"), FX.at(10, 30), 10.775, 106.7, 20.0, 90, "to_merchant", FX.CELL7, FX.CELL9, None, FX.TELE))
    failed = _failed(spark, rows)
    assert "unique_combination__stg_courier_telemetry__hk_courier_id_load_date" in failed


def test_wrong_column_type_caught_by_schema_conforms(spark):
    rows = FX.vault_rows()
    rows["hub_user"] = [(h, 1 if u == "u1" else 2, d, s) for h, u, d, s in rows["hub_user"]]
    schema = T.StructType([T.StructField("hk_user_id", T.StringType()), T.StructField("user_id", T.LongType()),
                           T.StructField("load_date", T.TimestampNTZType()),
                           T.StructField("record_source", T.StringType())])
    models = Models(FX.vault(spark, rows=rows, schemas={"hub_user": schema}))
    test = next(t for t in Q.DECLARED_TESTS if t.kind == "schema_conforms" and t.model == "hub_user")
    out = Q.violations(test, models).collect()
    assert [r["invalid_columns"] for r in out] == ["user_id:BIGINT"]


@pytest.mark.parametrize("mode", ["raw", "mart"])
def test_edge_serving(spark, mode):
    v = FX.vault(spark, edge=True)
    src = ServingSource(v, Models(v), mode=mode)
    assert src.live_couriers().count() == 2
    assert [r["courier_id"] for r in src.live_couriers("idle").collect()] == ["c2"]
    assert [r["courier_id"] for r in src.live_couriers("delivering").collect()] == ["c1"]
    for res in (7, 9):
        rows = src.hexagons("interactions", res, 100).collect()
        assert sum(r["metric_count"] for r in rows) == 9
        near = next(r for r in rows if r["metric_count"] == 4)
        assert abs(near["avg_dwell_ms"] - 275) < 1e-3
        assert abs(near["centroid_lat"] - 10.77575) < 1e-6
        rows = src.hexagons("couriers", res, 100).collect()
        assert sum(r["metric_count"] for r in rows) == 2
        assert sum(r["active_couriers"] for r in rows) == 2
    top = src.recommendations(10.77575, 106.7, 1).first()
    assert (top["merchant_id"], top["interaction_count"], top["dist_meters"], top["score"]) == ("m1", 4, 0.0, 4.0)
    assert src.recommend_near_with_fallback(0.0, 0.0, 10).count() == 2
    stats = {r["table_name"]: r["row_count"] for r in src.stats().collect()}
    assert stats["hub_user"] == (2 if mode == "mart" else 3)
    with pytest.raises(ValueError):
        src.hexagons("interactions", 8, 10)


def test_raw_and_mart_modes_agree_on_edge(spark):
    v = FX.vault(spark, edge=True)
    raw, mart = ServingSource(v, Models(v), "raw"), ServingSource(v, Models(v), "mart")
    def rows(df):
        return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect())
    assert rows(raw.recommendations(10.77575, 106.7, 10)) == rows(mart.recommendations(10.77575, 106.7, 10))
    assert rows(raw.hexagons("interactions", 7, 100)) == rows(mart.hexagons("interactions", 7, 100))
    assert rows(raw.live_couriers()) == rows(mart.live_couriers())


def test_schema_names_cover_vault():
    assert set(S.VAULT_TABLES) == set(S.SOURCE_TYPE_RULES)


def test_hexagon_feature_shape(spark):
    from hexvault.operators.serving import courier_response, hexagon_features
    v = FX.vault(spark, edge=True)
    src = ServingSource(v, Models(v), "mart")
    feats = hexagon_features(src.hexagons("interactions", 7, 100)).collect()
    near = next(f for f in feats if f["count"] == 4)
    assert abs(near["centroid"][1] - 10.77575) < 1e-6 and abs(near["properties"]["avg_dwell_ms"] - 275) < 1e-3
    rows = courier_response(src.live_couriers()).collect()
    assert all(r["speed_kmh"] is not None and r["bearing_deg"] is not None for r in rows)


def test_readiness_probe_reads_schemas_only(spark):
    v = FX.vault(spark)
    raw = {r["table_name"]: r["column_count"] for r in ServingSource(v, Models(v), "raw").readiness().collect()}
    mart = {r["table_name"]: r["column_count"] for r in ServingSource(v, Models(v), "mart").readiness().collect()}
    assert len(raw) == 6 and raw["hub_user"] == 4 and raw["sat_interaction_context_spatial"] == 12
    assert len(mart) == 9 and mart["hub_user"] == 3 and mart["fct_interactions"] == 14
