"""Stored layouts: exchange-free joins with hot keys apart, incremental snapshots, replays, file skipping, late rows."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hexvault.operators import features as D
from hexvault.plans import maintenance as MT
from hexvault.plans import snapshots as SN
from hexvault.plans.context import Context
from hexvault.plans.distributed import buckets_for, distribute, join_distributed
from hexvault.streaming import state as ST

SRC = "/root/testdata/sf0.001"


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_distributed_join_has_no_exchange_and_keeps_hot_keys_apart(spark, workdir, how):
    many = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"), "id")
    one = spark.createDataFrame([("hot", 1), (None, 2), *[(f"k{i}", i) for i in range(90)]], "k string, v int")
    facts = distribute(many, "k", workdir, f"facts_{how}", 4, hot_rows=500)
    hub = distribute(one, "k", workdir, f"hub_{how}", 4)
    assert [r[0] for r in facts.hot_keys.collect()] == ["hot"]
    assert facts.hot.count() == many.filter("k = 'hot'").count() and facts.even.filter("k = 'hot'").count() == 0
    got = join_distributed(facts, hub, how)
    assert bag(got.select("k", "id", "v")) == bag(many.join(one, "k", how).select("k", "id", "v"))
    plan = facts.even.join(hub.even.withColumnRenamed("k", "_one").hint("merge"), F.col("k") == F.col("_one"), how)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text
    whole = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in whole


def test_buckets_are_powers_of_two_and_follow_the_rows():
    assert [buckets_for(n, 100) for n in (0, 100, 450, 1000, 100_000)] == [4, 4, 8, 16, 1024]


def _times(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_a_new_day_rewrites_one_partition_and_a_late_day_those_after_it(spark, workdir):
    ctx = Context(spark, SRC)
    day = F.to_date("event_time")
    days = [r[0] for r in ctx.pings.filter("order_id is not null").select(day.alias("d")).distinct().orderBy("d").collect()]
    pings = ctx.pings.filter(day.isin(days[:12]))
    orders = ctx.table("orders")
    store = SN.PitStore(os.path.join(workdir, "pit"))
    assert store.refresh(orders, pings.limit(0), pings.limit(0)) == []
    start = pings.filter((day < days[11]) & (day != days[7]))
    store.refresh(orders, start, start)
    assert bag(store.read(spark)) == bag(D.order_pit(orders, start))
    old = _times(store.path)
    now = pings.filter(day != days[7])
    assert store.refresh(orders, now, pings.filter(day == days[11])) == [days[11]]
    assert bag(store.read(spark)) == bag(D.order_pit(orders, now))
    new = _times(store.path)
    assert all(new[f] == t for f, t in old.items()) and len(new) > len(old)
    late = pings.filter(day == days[7])
    assert store.refresh(orders, pings, late) == days[7:12]
    assert bag(store.read(spark)) == bag(D.order_pit(orders, pings))
    store.refresh(orders, pings, late)  # a replay changes nothing
    assert bag(store.read(spark)) == bag(D.order_pit(orders, pings))


def test_bridge_rewrites_touched_buckets_only(spark, workdir):
    links = spark.createDataFrame([(f"u{i % 40}", f"i{i}") for i in range(400)], "hk_user_id string, x string")
    store = SN.BridgeStore(os.path.join(workdir, "bridge"), "hk_user_id", buckets=8)
    assert store.refresh(spark, lambda a: a, [links], links) == list(range(8))
    old = _times(store.path)
    more = links.unionByName(spark.createDataFrame([("u1", "new")], links.schema))
    touched = store.refresh(spark, lambda a: a, [more], more.filter("x = 'new'"))
    assert len(touched) == 1 and bag(store.read(spark)) == bag(more)
    kept = [f for f, t in _times(store.path).items() if old.get(f) == t]
    assert len(kept) >= 7


def test_day_partitions_survive_replays(spark, workdir):
    path = os.path.join(workdir, "days")
    at = dt.datetime(2024, 1, 1)
    rows = [(i, at + dt.timedelta(hours=i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, load_date timestamp_ntz")
    for batch, part in ((0, "id < 60"), (1, "id >= 60"), (1, "id >= 60"), (0, "id < 60")):
        MT.write_day_partitioned(df.filter(part), path, batch, clustered_by=["id", "load_date"], files_per_batch=2)
    assert bag(spark.read.parquet(path).select("id", "load_date")) == bag(df)


def test_curve_skips_files_for_a_cell_and_a_time(spark, workdir):
    """By file statistics: a box filter reads a fraction of the files, whichever column it is narrow in."""
    df = spark.range(64 * 64).select((F.col("id") % 64).alias("cell"), F.expr("cast(id / 64 as long)").alias("t"))
    df = df.withColumn("cell", F.when(F.col("cell") < 63, F.col("cell")))  # nulls too

    def files(name, frame):
        path = os.path.join(workdir, name)
        frame.write.parquet(path)
        out = []
        for f in os.listdir(path):
            if f.endswith(".parquet"):
                meta = pq.read_metadata(os.path.join(path, f)).row_group(0)
                out.append([meta.column(i).statistics for i in range(2)])
        return out

    def read(found, cell, t):
        return sum((c.min is None or c.min <= cell[1] and cell[0] <= c.max) and x.min <= t[1] and t[0] <= x.max
                   for c, x in found)

    curve = files("z", MT.cluster(df, ["cell", "t"], 16))
    by_cell = files("c", df.repartitionByRange(16, "cell").sortWithinPartitions("cell"))
    assert sum(1 for _ in curve) == 16
    assert read(curve, (5, 6), (0, 63)) <= 6 and read(curve, (0, 63), (5, 6)) <= 6 and read(curve, (5, 6), (5, 6)) <= 3
    assert read(by_cell, (0, 63), (5, 6)) >= 15  # one sort column cannot skip by the other
    assert bag(MT.cluster(df, ["cell", "t"], 16)) == bag(df)


# --- stateful streams --------------------------------------------------------------------

def _stream(spark, slices, schema, path):
    for rows in slices:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(path)


def _run(spark, df, workdir, mode="append"):
    out = []
    with ST.OnState(spark):
        q = (df.writeStream.outputMode(mode).foreachBatch(lambda b, i: out.extend((i, *r) for r in b.collect()))
             .option("checkpointLocation", os.path.join(workdir, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return out


def test_history_orders_late_rows_and_forgets_replays(spark, workdir):
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    schema = "k string, at timestamp, status string"
    slices = [[("a", day(0), "x"), ("a", day(4), "x"), ("b", day(1), None)],
              [("a", day(2), "y"), ("a", day(0), "x")],  # out of order, and a replay
              [("a", day(20), "z"), ("b", day(20), None)], [("b", day(21), None)],
              [("a", day(1), "late"), ("a", day(4), "x")],  # passed by the watermark
              [("~", day(90), "x")]]
    out = ST.history_stream(_stream(spark, slices, schema, os.path.join(workdir, "in")), "k", "at", ["status"], [], "5 days")
    got = sorted((r[1], r[2].day, r[3]) for r in _run(spark, out, workdir))
    assert got == [("a", 1, "x"), ("a", 3, "y"), ("a", 5, "x"), ("a", 21, "z"), ("b", 2, None)]


def test_last_categories_ignore_arrival_order_and_clear_when_idle(spark, workdir):
    ms = lambda d: d * 86_400_000
    schema = "user_id string, event_type string, event_ts_ms long, event_id string, category string"
    slices = [[("u", "click", ms(3), "e3", "c"), ("u", "click", ms(1), "e1", "a"), ("u", "view", ms(9), "v", "no")],
              [("u", "click", ms(2), "e2", "b"), ("u", "click", ms(3), "e3", "c")],
              [("w", "click", ms(200), "e9", "x")], [("w", "click", ms(201), "e10", "y")],
              [("u", "click", ms(202), "e11", "d")]]  # after 90 idle days the list starts anew
    out = ST.last_categories_stream(_stream(spark, slices, schema, os.path.join(workdir, "in")), k=2)
    got = _run(spark, out, workdir, "update")
    lists = [r[2] for r in got if r[1] == "u"]
    assert lists == ["c|a", "c|b", "d"]
    assert [r[2] for r in got if r[1] == "w"] == ["x", "y|x"]


def test_subject_keys_come_from_the_system_and_never_repeat(spark, workdir):
    subjects = spark.range(200).select(F.concat(F.lit("u"), "id").alias("user_id"))
    drawn = [D.subject_keys(subjects, "user_id", os.path.join(workdir, n)).collect() for n in ("a", "b")]
    keys = [bytes(r.data_key) for rows in drawn for r in rows]
    assert len(set(keys)) == 400 and {len(k) for k in keys} == {32}
    assert len({r.user_id for r in drawn[0]}) == 200
