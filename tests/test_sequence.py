"""sequence_features (chunked, skew-safe) equals plain per-key windows, with a hot key."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from hexvault.operators.sequence import HOUR_MS, sequence_features, time_bucket


def test_sequence_features_match_windows(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        key = "hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 40)}"
        v = None if rnd.random() < 0.3 else rnd.randint(-5, 9)
        rows.append((key, i, v, rnd.randint(0, 3)))
    df = spark.createDataFrame(rows, "k string, t long, v int, n int")
    got = sequence_features(df, "k", ["t"], lag=["v"], lead=["v"], ffill=["v"], cumsum=["n"], bucket_ms=250)
    w = Window.partitionBy("k").orderBy("t")
    exp = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v"),
                    F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("ffill_v"),
                    F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_n"))
    key = lambda r: (r["k"], r["t"])
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[1])) == \
        sorted(map(tuple, exp.select(*got.columns).collect()), key=lambda r: (r[0], r[1]))
    # the hot key really spans several chunks (12 buckets of 250 ticks)
    assert df.filter("k = 'hot'").select(F.floor(F.col("t") / 250)).distinct().count() > 1


def test_hot_key_operators_combine_before_the_shuffle(spark):
    """Latest-row selection aggregates map-side; top-k ranks inside salted groups first."""
    from hexvault.operators.features import top_k_per_key
    from hexvault.operators.marts import latest_by
    rows = [("hot", i, i % 7) for i in range(2000)] + [(f"k{i}", i, 1) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, t long, v int").withColumn("ts", F.timestamp_seconds("t"))
    latest = latest_by(df, "k", "ts", ["v"], ["k", "t", "v"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert latest.filter("k = 'hot'").first()["t"] == 1999
    top = top_k_per_key(df, "k", [F.col("t").desc()], 3, salt_col="t")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
    assert [r["t"] for r in top.filter("k = 'hot'").orderBy("rank").collect()] == [1999, 1998, 1997]


def test_key_hot_inside_one_day_and_null_keys(spark):
    """One key fills one day: its rows lie in many chunks; a null key carries its state like any other."""
    import datetime as dt
    start = dt.datetime(2024, 1, 1)
    rows = [(k, start + dt.timedelta(minutes=3 * i), i) for k in ("hot", None) for i in range(480)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, n int")
    out = sequence_features(df, "k", ["t"], lag=["n"], lead=["n"], ffill=["n"], cumsum=["n"])
    chunks = df.select(time_bucket(df, "t", HOUR_MS).alias("c")).distinct().count()
    assert chunks == 24
    for r in out.collect():
        i = r["n"]
        assert r["prev_n"] == (i - 1 if i else None) and r["next_n"] == (i + 1 if i < 479 else None)
        assert r["ffill_n"] == i and r["cum_n"] == i * (i + 1) // 2


def test_chunk_width_follows_the_rows_of_a_hot_hour(spark):
    """A bot, a null key and a burst inside one hour get narrower chunks; other keys keep theirs."""
    from hexvault.operators.sequence import chunked, narrow_widths
    rnd = random.Random(8)
    rows = []
    for i in range(900):
        rows += [("bot", i * 3900, i, i % 5), (None, i * 3900, None if i % 3 else i, 1)]
    rows += [("burst", 1_800_000 + i, i, 2) for i in range(400)]  # all in one second
    rows += [("same", 77, i, 1) for i in range(300)]  # equal times cannot be cut
    rows += [(f"k{i % 20}", rnd.randint(0, 3_599_999), i, 3) for i in range(400)]
    df = spark.createDataFrame([(*r, j) for j, r in enumerate(rows)], "k string, t long, v int, n int, id long")
    widths = {r["_w_key"]: r["_width"] for r in narrow_widths(df, "k", "t", HOUR_MS, 100).collect()}
    assert widths == {"bot": 60_000, None: 60_000, "burst": 1, "same": 1}
    sizes = chunked(df, "k", "t", max_rows=100).groupBy("k", "_chunk").count()
    per_key = {r["k"]: (r["chunks"], r["largest"]) for r in sizes.groupBy("k").agg(
        F.count("*").alias("chunks"), F.max("count").alias("largest")).collect()}
    assert per_key["bot"][0] >= 58 and per_key["bot"][1] <= 100 and per_key[None] == per_key["bot"]
    assert per_key["burst"] == (400, 1) and per_key["same"] == (1, 300)
    assert all(per_key[f"k{i}"][0] == 1 for i in range(20))
    got = sequence_features(df, "k", ["t", "id"], lag=["v"], lead=["v"], ffill=["v"], cumsum=["n"], max_rows=100)
    w = Window.partitionBy("k").orderBy("t", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v"),
                    F.last("v", ignorenulls=True).over(upto).alias("ffill_v"), F.sum("n").over(upto).alias("cum_n"))
    by_id = lambda frame: sorted(map(tuple, frame.select(*got.columns).collect()), key=lambda r: r[4])
    assert by_id(got) == by_id(exp)
    assert narrow_widths(df.filter("k = 'k1'"), "k", "t", HOUR_MS, 100) is None
