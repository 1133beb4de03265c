"""Designed operators checked by invariants: re-rank, boost, shredding, compaction, partitions,
post-failure assertions and the model-based jobs."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from hexvault.operators import features as D
from hexvault import schemas as S
from hexvault.operators import ml as ML
from hexvault.operators import vault as V
from hexvault.plans import maintenance as MT
from hexvault.plans.context import Context
from hexvault.sources import contracts as C
from hexvault.streaming import ingest as I

SRC = "/root/testdata/sf0.001"


def test_rerank_diversity_limits_runs(spark):
    rows = [("u1", f"i{k}", "a" if k < 6 else "b", 10.0 - k * 0.1) for k in range(8)]
    rows += [("u2", f"j{k}", "a", 5.0 - k * 0.1) for k in range(4)]
    df = spark.createDataFrame(rows, "user_id string, item_id string, category string, score double")
    out = {u: [r["category"] for r in sorted(g, key=lambda r: r["position"])]
           for u, g in _group(D.rerank_diversity(df).collect())}
    assert out["u1"] == ["a", "a", "a", "b", "a", "a", "a", "b"]
    assert out["u2"] == ["a", "a", "a", "a"]  # no alternative: order kept


def _group(rows):
    g = {}
    for r in rows:
        g.setdefault(r["user_id"], []).append(r)
    return g.items()


def test_boost_and_stock_filter(spark):
    scored = spark.createDataFrame([("i1", 1.0), ("i2", 1.0), ("i3", 1.0)], "item_id string, score double")
    seen = spark.createDataFrame([("i1", dt.datetime(2024, 1, 29)), ("i2", dt.datetime(2024, 1, 1))],
                                 "item_id string, first_seen_at timestamp_ntz")
    stock = spark.createDataFrame([("i1",), ("i2",)], "item_id string")
    out = {r["item_id"]: r["boosted_score"] for r in
           D.boost_and_filter(scored, seen, stock, F.lit(dt.datetime(2024, 1, 30)).cast("timestamp_ntz")).collect()}
    assert out == {"i1": 1.2, "i2": 1.0}


def test_crypto_shredding(spark, workdir):
    users = spark.createDataFrame([("u1", "Ann"), ("u2", "Bob")], "user_id string, name string")
    keys = D.subject_keys(users, "user_id", os.path.join(workdir, "keys"))
    enc = D.shred_encrypt(users, keys, "user_id", ["name"]).cache()
    assert sorted(r["name"] for r in D.shred_decrypt(enc, keys, "user_id", ["name"]).collect()) == ["Ann", "Bob"]
    erased = keys.filter("user_id <> 'u1'")
    got = {r["user_id"]: r["name"] for r in D.shred_decrypt(enc, erased, "user_id", ["name"]).collect()}
    assert got == {"u1": None, "u2": "Bob"}


def test_compaction_and_day_partitions(spark, workdir):
    ctx = Context(spark, SRC)
    src, dst, parts = (os.path.join(workdir, x) for x in ("src", "dst", "parts"))
    sat = ctx.vault["sat_interaction_context_spatial"].drop("geom_wkb")
    sat.repartition(7).write.parquet(src)
    MT.compact(spark, src, dst, target_mb=256)
    a, b = spark.read.parquet(src), spark.read.parquet(dst)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert len([f for f in os.listdir(dst) if f.endswith(".parquet")]) == 1
    MT.write_day_partitioned(sat, parts)
    q = spark.read.parquet(parts).filter(F.col("load_day") == dt.date(2024, 1, 5))
    assert "PartitionFilters: [isnotnull(load_day" in q._jdf.queryExecution().executedPlan().toString()
    assert q.count() == sat.filter(F.to_date("load_date") == dt.date(2024, 1, 5)).count()


def test_post_failure_checks_after_restart(spark, workdir):
    ctx = Context(spark, SRC)
    msgs = C.to_messages(ctx.clicks, "events.clickstream")
    src, root, ck = (os.path.join(workdir, x) for x in ("m", "v", "ck"))
    parts = msgs.randomSplit([0.5, 0.5], seed=1)
    parts[0].write.mode("append").text(src)
    I.start_vault_stream(spark, I.file_source(spark, src), "events.clickstream", root, ck,
                         available_now=True).awaitTermination()
    parts[1].write.mode("append").text(src)  # more data arrives; the query restarts from its checkpoint
    I.start_vault_stream(spark, I.file_source(spark, src), "events.clickstream", root, ck,
                         available_now=True).awaitTermination()
    clicks = I.read_vault(spark, root, (I.CLICKS,))
    # couriers are not part of this stream: give the vault an empty courier side
    vault = V.Vault({n: clicks[n] if n in V.CLICK_SINKS else spark.createDataFrame([], S.VAULT_TABLES[n])
                     for n in V.Vault.NAMES})
    checks = MT.post_failure_checks(vault, I.read_log(spark, root), msgs.count())
    bad = [r for r in checks.collect() if r["violations"] and "couriers" not in r["check"]
           and "courier" not in r["check"]]
    assert bad == []


def test_model_jobs_rows(spark):
    ctx = Context(spark, SRC)
    tel = ctx.models["stg_courier_telemetry"]
    cl = ML.courier_clusters(tel)
    assert cl.count() == tel.select("hk_courier_id").distinct().count()
    assert {r["cluster"] for r in cl.collect()} <= {0, 1, 2}
    fac = ML.als_factors(ctx.clicks_once)
    assert fac.count() == ctx.clicks_once.select("item_id").distinct().count()
    assert len(fac.first()["factors"]) == 8


def test_keys_are_numbered_without_gaps(spark):
    from hexvault.operators.ml import numbered
    rows = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL "
                                        "ELSE concat('k', id % 700) END AS k", "id AS v")
    out = numbered(rows, "k", "i")
    first = {r["k"]: r["i"] for r in out.collect()}
    assert sorted(first.values()) == list(range(rows.filter("k IS NOT NULL").select("k").distinct().count()))
    assert {r["k"]: r["i"] for r in out.collect()} == first
    assert numbered(rows.limit(0), "k", "i").count() == 0
