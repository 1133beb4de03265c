"""Streaming vault ingest: availableNow equals batch, replays are idempotent, strict vs quarantine."""

from __future__ import annotations

import json
import os

import pytest

from hexvault.plans.context import Context
from hexvault.operators.vault import Vault
from hexvault.sources import contracts as C
from hexvault.streaming import ingest as I
from hexvault.streaming import sinks

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _write_messages(df, topic, path, parts=3):
    C.to_messages(df, topic).repartition(parts).write.mode("overwrite").text(path)


def test_available_now_equals_batch(spark, workdir):
    ctx = Context(spark, SF)
    clicks_path, pings_path = os.path.join(workdir, "clicks"), os.path.join(workdir, "pings")
    _write_messages(ctx.clicks, "events.clickstream", clicks_path)
    _write_messages(ctx.pings, "events.telemetry", pings_path)
    root = os.path.join(workdir, "vault")
    for topic, path in (("events.clickstream", clicks_path), ("events.telemetry", pings_path)):
        q = I.start_vault_stream(spark, I.file_source(spark, path, 1), topic, root,
                                 checkpoint=os.path.join(workdir, "ckpt", topic), available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    streamed = I.read_vault(spark, root)
    batch = ctx.vault
    for name in Vault.NAMES:
        cols = [c for c in batch[name].columns if c != "geom_wkb"]
        assert _rows(streamed[name].select(*cols)) == _rows(batch[name].select(*cols)), name
    live = sinks.read_live(spark, root, __import__("hexvault").schemas.COURIER_LIVE)
    from hexvault.streaming.sinks import latest_live_rows
    from hexvault.operators.vault import courier_live_rows
    assert _rows(live) == _rows(latest_live_rows(courier_live_rows(ctx.pings)))
    assert I.read_log(spark, root).count() == ctx.clicks.count()


def test_replayed_batch_adds_nothing(spark, workdir):
    ctx = Context(spark, SF)
    root = os.path.join(workdir, "vault")
    msgs = C.to_messages(ctx.clicks, "events.clickstream")
    batch = I.typed_stream(msgs, "events.clickstream")
    sink = I.VaultSink(root, "events.clickstream")
    sink(batch, 0)
    clicks = lambda: I.read_vault(spark, root, (I.CLICKS,))["hub_user"].count()
    first = clicks()
    sink(batch, 0)  # the same batch id again (restart after a failure)
    assert clicks() == first == ctx.clicks.count()
    with pytest.raises(FileNotFoundError):
        I.read_vault(spark, root)  # no telemetry was ever committed


def test_reads_are_pinned_to_committed_batches_on_any_path(spark, workdir):
    """A URI root reads the same; an interrupted batch and a later one stay out of a pinned read."""
    ctx = Context(spark, SF)
    root = "file://" + os.path.join(workdir, "vault")
    batch = I.typed_stream(C.to_messages(ctx.clicks, I.CLICKS), I.CLICKS)
    sink = I.VaultSink(root, I.CLICKS)
    sink(batch, 0)
    n = ctx.clicks.count()
    pinned = I.snapshot(spark, root, (I.CLICKS,))
    # the next batch wrote one table and was lost before its commit
    sinks.append_batch(I.read_vault(spark, root, (I.CLICKS,))["hub_user"], root, "hub_user", 1)
    assert I.read_vault(spark, root, (I.CLICKS,))["hub_user"].count() == n
    sink(batch, 1)
    assert I.read_vault(spark, root, (I.CLICKS,))["hub_user"].count() == 2 * n
    old = I.read_vault(spark, root, (I.CLICKS,), pinned)
    assert old["hub_user"].count() == old["sat_interaction_context_spatial"].count() == n
    assert I.read_log(spark, root).count() == 2 * n


def test_unfinished_live_version_is_not_read(spark, workdir):
    from hexvault import schemas as S
    row = lambda status, ts: spark.createDataFrame(
        [("h", "c1", 1.0, 2.0, 3.0, 4, status, 7, 9, ts)], S.COURIER_LIVE)
    with pytest.raises(FileNotFoundError):
        sinks.read_live(spark, workdir, S.COURIER_LIVE)
    for i in range(5):
        sinks.upsert_live(spark, "file://" + workdir, row(f"s{i}", i), i, S.COURIER_LIVE)
    os.makedirs(os.path.join(workdir, sinks.LIVE_TABLE, "v=000000000009", "_temporary"))
    assert sinks.read_live(spark, workdir, S.COURIER_LIVE).first()["status"] == "s4"
    assert len(os.listdir(os.path.join(workdir, sinks.LIVE_TABLE))) <= sinks.KEPT_VERSIONS + 1


def test_a_live_batch_rewrites_the_buckets_of_its_keys_only(spark, workdir):
    from hexvault import schemas as S
    table = os.path.join(workdir, sinks.LIVE_TABLE)

    def rows(names, ts, status):
        return spark.createDataFrame([(f"h{n}", f"c{n}", 1.0, 2.0, 3.0, 4, status, 7, 9, ts) for n in names],
                                     S.COURIER_LIVE)

    def held():
        return {r["courier_id"]: (r["status"], r["event_ts_ms"])
                for r in sinks.read_live(spark, workdir, S.COURIER_LIVE).collect()}

    sinks.upsert_live(spark, workdir, rows(range(50), 10, "idle"), 0, S.COURIER_LIVE, buckets=8)
    sinks.upsert_live(spark, workdir, rows([3], 20, "busy"), 1, S.COURIER_LIVE, buckets=8)
    sinks.upsert_live(spark, workdir, rows([3, 4], 5, "late"), 2, S.COURIER_LIVE, buckets=8)
    sinks.upsert_live(spark, workdir, rows([3, 4], 5, "late"), 2, S.COURIER_LIVE, buckets=8)  # replay
    assert held() == {f"c{n}": ("busy", 20) if n == 3 else ("idle", 10) for n in range(50)}
    written = {v: [d for d in os.listdir(os.path.join(table, v)) if d.startswith("_b=")] for v in os.listdir(table)}
    assert len(written["v=000000000000"]) == 8 and len(written["v=000000000001"]) == 1
    sinks.upsert_live(spark, workdir, rows([], 0, "x"), 3, S.COURIER_LIVE, buckets=8)  # an empty batch
    for i in range(4, 10):
        sinks.upsert_live(spark, workdir, rows([3], 20 + i, f"s{i}"), i, S.COURIER_LIVE, buckets=8)
    assert held()["c3"] == ("s9", 29) and len(held()) == 50
    versions = sinks.held_buckets(spark, table)
    assert len(versions) == 8 and all(len(v) <= sinks.KEPT_VERSIONS for v in versions.values())
    assert "v=000000000003" not in os.listdir(table)  # folders without a bucket go


def test_bounded_read_fails_on_an_invalid_message(spark, workdir):
    ctx = Context(spark, SF)
    path = os.path.join(workdir, "m")
    _write_messages(ctx.clicks, I.CLICKS, path)
    assert I.bounded_read(spark, path, I.CLICKS).count() == ctx.clicks.count()
    spark.createDataFrame([('{"event_id": 5}',)], "value string").write.mode("append").text(path)
    with pytest.raises(Exception, match="missing:user_id"):
        I.bounded_read(spark, path, I.CLICKS).collect()


def test_framed_messages_need_the_right_header(spark):
    from pyspark.sql import functions as F
    frames = spark.createDataFrame([(7, "a"), (7, "b")], "sid long, body string").select(
        C.wire_frame(F.col("body"), F.col("sid")).alias("frame"))
    assert sorted(bytes(r.body) for r in I.strict_bodies(frames, 7).collect()) == [b"a", b"b"]
    with pytest.raises(Exception, match="found 7"):
        I.strict_bodies(frames, 8).collect()
    bad = spark.createDataFrame([(bytearray(b"\x01\x00"),)], "frame binary")
    with pytest.raises(Exception, match="without the header"):
        I.strict_bodies(bad, 7).collect()


def test_strict_mode_fails_and_quarantine_routes(spark, workdir):
    good = {"event_id": "e1", "user_id": "u1", "item_id": "i1", "merchant_id": "m1", "event_type": "click",
            "device_type": "ios", "dwell_time_ms": 1, "referrer_page": "home_feed", "latitude": 1.0,
            "longitude": 2.0, "event_ts_ms": 1000}
    bad = {**good, "event_ts_ms": "yesterday"}
    msgs = spark.createDataFrame([(json.dumps(good),), (json.dumps(bad),)], "value string")
    batch = I.typed_stream(msgs, "events.clickstream")
    with pytest.raises(I.ContractViolation):
        I.VaultSink(os.path.join(workdir, "strict"), "events.clickstream")(batch, 0)
    root = os.path.join(workdir, "q")
    I.VaultSink(root, "events.clickstream", quarantine=True)(batch, 0)
    assert I.read_vault(spark, root, (I.CLICKS,))["hub_user"].count() == 1
    dlq = I.read_dead_letters(spark, root).collect()
    assert [r["reasons"] for r in dlq] == [["wrong_type:event_ts_ms"]]


def test_kafka_options_route_topics():
    assert I.kafka_options("events.clickstream", "b:9092")["subscribe"] == "events.clickstream"
    assert I.kafka_options("events.telemetry", "b:9092", "avro")["subscribe"] == "events.telemetry.avro.v1"
    with pytest.raises(ValueError):
        I.kafka_options("events.unknown", "b:9092")
