"""Streaming feature jobs: dedup, windowed counts, stream-stream join, idempotent upserts."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from hexvault.operators import features as D
from hexvault.plans.context import Context
from hexvault.streaming import features as SF

SRC = "/root/testdata/sf0.001"


def _stream_of(spark, df, path, parts=3):
    """All files in one micro-batch: the files are not in event-time order, so splitting
    them over triggers would (correctly) make later files late for the watermark."""
    df.repartition(parts).write.mode("overwrite").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def _collect(query_df, mode="append"):
    rows = []
    q = (query_df.writeStream.outputMode(mode)
         .foreachBatch(lambda b, i: rows.extend(b.collect())).trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return rows, q


def test_dedup_within_watermark(spark, workdir):
    ctx = Context(spark, SRC)
    clicks = ctx.clicks.select("event_id", "user_id", "event_ts_ms")
    stream = _stream_of(spark, clicks, os.path.join(workdir, "c"))
    rows, _ = _collect(SF.dedup_within_watermark(stream, ["event_id"]))
    assert len(rows) == len({r["event_id"] for r in rows}) == ctx.clicks_once.count()


def test_windowed_counts_match_batch(spark, workdir):
    ctx = Context(spark, SRC)
    stream = _stream_of(spark, ctx.clicks_once.select("user_id", "event_ts_ms"), os.path.join(workdir, "c"))
    rows, q = _collect(SF.windowed_counts(stream, "user_id", "1 hour"), mode="update")
    final = {}
    for r in rows:
        k = (r["user_id"], r["window_start"])
        final[k] = max(final.get(k, 0), r["events"])
    batch = (ctx.clicks_once.groupBy("user_id", F.window(F.timestamp_millis("event_ts_ms"), "1 hour").alias("w"))
             .count().collect())
    assert final == {(r["user_id"], r["w"]["start"]): r["count"] for r in batch}


def test_stream_stream_join_matches_batch_labels(spark, workdir):
    ctx = Context(spark, SRC)
    ev = ctx.clicks_once.select("event_id", "user_id", "item_id", "event_type", "event_ts_ms")
    imps = _stream_of(spark, ev.filter("event_type = 'view_item'"), os.path.join(workdir, "i"))
    clks = _stream_of(spark, ev.filter("event_type = 'click'"), os.path.join(workdir, "k"))
    rows, _ = _collect(SF.impression_click_join(imps, clks))
    matched = {r["imp_id"] for r in rows if r["label"] == 1}
    batch = {r["event_id"] for r in D.impression_click_labels(ctx.clicks_once).filter("label = 1").collect()}
    assert matched == batch


def test_impression_with_two_clicks_is_one_row(spark, workdir):
    rows = [("i1", "u", "x", 1_000_000), ("i2", "u", "y", 1_000_000), ("late", "u", "z", 90_000_000)]
    clicks = [("c1", "u", "x", 1_200_000), ("c2", "u", "x", 1_100_000), ("c3", "v", "x", 1_050_000),
              ("late", "u", "z", 90_000_000)]
    schema = "event_id string, user_id string, item_id string, event_ts_ms long"
    imps = _stream_of(spark, spark.createDataFrame(rows, schema), os.path.join(workdir, "i"))
    clks = _stream_of(spark, spark.createDataFrame(clicks, schema), os.path.join(workdir, "k"))
    got, _ = _collect(SF.impression_click_join(imps, clks))
    found = {r["imp_id"]: (r["label"], r["clk_ts"].timestamp() if r["clk_ts"] else None) for r in got}
    assert len(got) == len(found)
    assert found["i1"] == (1, 1100.0) and found["i2"] == (0, None)


def test_feature_sink_is_idempotent(spark, workdir):
    root = os.path.join(workdir, "f")
    sink = SF.FeatureSink(root, "user_id", "ts", ["clicks"])
    b0 = spark.createDataFrame([("u1", 1, 3), ("u2", 1, 1)], "user_id string, ts long, clicks long")
    b1 = spark.createDataFrame([("u1", 2, 5)], "user_id string, ts long, clicks long")
    sink(b0, 0)
    sink(b1, 1)
    first = sorted(map(tuple, sink.read(spark).select("user_id", "clicks").collect()))
    sink(b1, 1)  # replay of the last batch
    assert sorted(map(tuple, sink.read(spark).select("user_id", "clicks").collect())) == first == [("u1", 5), ("u2", 1)]
    os.makedirs(os.path.join(root, "v=000000000007", "_temporary"))  # an interrupted write
    assert sorted(map(tuple, sink.read(spark).select("user_id", "clicks").collect())) == first
    assert SF.FeatureSink("file://" + root, "user_id", "ts", ["clicks"]).read(spark).count() == 2


def test_bronze_envelope_from_files(spark, workdir):
    path = os.path.join(workdir, "raw")
    spark.createDataFrame([('{"a": 1}',), ('{"a": 2}',)], "value string").write.text(path)
    rows, _ = _collect(SF.bronze_envelope(spark.readStream.format("text").load(path), "events.clickstream"))
    assert len(rows) == 2 and len({r["envelope_id"] for r in rows}) == 2
    assert {r["topic"] for r in rows} == {"events.clickstream"}


def test_bucketed_feature_sink_rewrites_touched_buckets_only(spark, workdir):
    plain = SF.FeatureSink(os.path.join(workdir, "p"), "user_id", "ts", ["clicks"])
    bucketed = SF.BucketedFeatureSink(os.path.join(workdir, "b"), "user_id", "ts", ["clicks"], buckets=8)
    batches = [
        spark.createDataFrame([(f"u{i}", 1, i) for i in range(40)], "user_id string, ts long, clicks long"),
        spark.createDataFrame([("u3", 2, 100)], "user_id string, ts long, clicks long"),
        spark.createDataFrame([("u5", 3, 7), ("u99", 3, 1)], "user_id string, ts long, clicks long"),
    ]
    for i, b in enumerate(batches):
        plain(b, i)
        bucketed(b, i)
    bucketed(batches[2], 2)  # replay of the last batch
    rows = lambda s: sorted(map(tuple, s.read(spark).select("user_id", "clicks").collect()))
    assert rows(bucketed) == rows(plain)
    written = [d for d in os.listdir(os.path.join(workdir, "b", "v=000000000001")) if d.startswith("_b=")]
    assert len(written) == 1  # the one-key batch rewrote a single bucket
