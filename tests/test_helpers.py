"""SQL-registered functions, table creation, fixture loading, gauges, refresh stream."""

from __future__ import annotations

import datetime as dt
import os
import time

from pyspark.sql import functions as F

import fixtures as FX
from hexvault import schemas as S
from hexvault.functions.spatial import hexcell
from hexvault.functions.sql import register_sql_functions
from hexvault.plans import release as REL
from hexvault.sources import contracts as C
from hexvault.sources import files
from hexvault.streaming import ingest as I
from hexvault.streaming import sinks


def test_sql_functions_match_columns(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT py_md5(' u1 ') a, py_composite_hk('u1', 'm1', '5') b, py_composite_hk('u1', '', '5') c, "
                  "py_h3_res7(10.775D, 106.7D) d, py_h3_res9(10.775D, 106.7D) e, py_point_to_wkb(NULL, 1D) f").first()
    exp = spark.range(1).select(hexcell(F.lit(10.775), F.lit(106.7), 7).alias("d"),
                                hexcell(F.lit(10.775), F.lit(106.7), 9).alias("e")).first()
    assert r["a"] == FX.md5u("u1") and r["b"] == FX.md5u("u1;m1;5") and r["c"] is None
    assert (r["d"], r["e"]) == (exp["d"], exp["e"]) and r["f"] is None


def test_ensure_table_and_point_read(spark, workdir):
    path = sinks.ensure_table(spark, workdir, "hub_user", S.HUB_USER)
    assert spark.read.schema(S.HUB_USER).parquet(path).count() == 0
    sinks.ensure_table(spark, workdir, "hub_user", S.HUB_USER)  # idempotent
    rows = spark.createDataFrame([("h", "c1", 1.0, 2.0, 3.0, 4, "idle", 7, 9, 1000)], S.COURIER_LIVE)
    sinks.upsert_live(spark, workdir, rows, 0, S.COURIER_LIVE)
    got = sinks.live_point_read(spark, workdir, S.COURIER_LIVE).collect()
    assert [(r["courier_id"], r["status"]) for r in got] == [("c1", "idle")]


def test_fixture_loading(spark):
    doc = {"hub_user": {"columns": ["hk_user_id", "user_id", "load_date", "record_source"],
                        "types": ["VARCHAR(32)", "VARCHAR", "DATETIME", "VARCHAR"],
                        "rows": [[FX.md5u("u1"), "u1", "2026-10-15 10:00:00", "events.clickstream"]]}}
    df = C.load_fixture_tables(spark, doc)["hub_user"]
    assert df.schema == S.HUB_USER
    assert df.first()["load_date"] == dt.datetime(2026, 10, 15, 10)


def test_gauges(spark):
    now = dt.datetime(2026, 10, 15, 12)
    log = spark.createDataFrame([(0, "activated", "old", now, now, "s", None, None),
                                 (1, "activated", "new", now, now, "s", now, None)], REL.LOG_SCHEMA)
    quality = spark.createDataFrame([(dt.date(2026, 10, 14), "ok"), (dt.date(2026, 10, 13), "anomaly")],
                                    "target_day date, status string")
    rows = {(r["name"], r["label"]): r["value"] for r in REL.gauges(log, quality).collect()}
    seconds = now.replace(tzinfo=dt.timezone.utc).timestamp()
    assert rows == {("release_built_timestamp_seconds", "new"): seconds,
                    ("release_event_timestamp_seconds", "interactions"): seconds,
                    ("release_event_timestamp_seconds", "couriers"): None,
                    ("quality_healthy", "2026-10-14"): 1.0, ("quality_healthy", "2026-10-13"): 0.0}


def test_mart_refresh_stream_publishes(spark, workdir):
    vault_root, rel_root = os.path.join(workdir, "vault"), os.path.join(workdir, "rel")
    v = FX.vault(spark)
    for name in v.NAMES:
        sinks.append_batch(v[name], vault_root, name, 0)
    for topic in I.SOURCE_TOPICS:
        sinks.commit_batch(spark, vault_root, topic, 0)
    errors = []
    q = I.mart_refresh_stream(spark, vault_root, rel_root, "30 seconds",
                              checkpoint=os.path.join(workdir, "ck"), on_error=errors.append)
    deadline = time.time() + 120
    while (not files.committed_children(spark, f"{rel_root}/{REL.LOG}", "event=")
           and time.time() < deadline and not errors):
        time.sleep(1)
    q.stop()
    assert errors == []
    found = REL.read_log(spark, rel_root).collect()
    assert [r.event for r in found] == ["activated"]
    assert found[0].source == "events.clickstream@batch=000000000000,events.telemetry@batch=000000000000"


def test_file_stats_and_metric_lines(spark, workdir):
    path = os.path.join(workdir, "t")
    spark.range(1000).repartition(3).write.parquet(path)
    stats = REL.file_stats(spark, {"t": path})
    row = stats.first()
    assert row["data_file_count"] == 3 and row["total_data_size_mb"] >= 0
    lines = sorted(r["value"] for r in REL.metrics_lines(stats).collect())
    assert lines[0] == 'table_data_files{table="t"} 3'


def test_cut_lineage_uses_reliable_checkpoint(spark):
    from hexvault.session import cut_lineage
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    cut = cut_lineage(df)
    assert cut.count() == 100
    assert "LogicalRDD" in cut._jdf.queryExecution().analyzed().toString()
