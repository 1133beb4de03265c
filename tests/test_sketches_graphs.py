"""Stored quantile sketches, session graph ranks, line simplification and marginal relevance."""

import math
import random
from collections import Counter, defaultdict
from datetime import date

import numpy as np
from pyspark.sql import functions as F

from hexvault.operators import graphs as G
from hexvault.operators import rerank as R
from hexvault.operators import sketches as K


# --- sketches ------------------------------------------------------------------------------------

def _skewed(spark, n=40_000):
    """Three days; key 'hot' holds most rows, 'none' only nulls."""
    return spark.range(n).select(
        F.expr("date_add(DATE'2024-01-01', CAST(id % 3 AS INT))").alias("day"),
        F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "cold").otherwise("none").alias("k"),
        F.when(F.col("id") % 10 < 9, F.pmod(F.xxhash64("id"), F.lit(100_000))).alias("v"))


def test_window_percentiles_stay_within_the_error_of_the_exact_ranks(spark, workdir):
    rows = _skewed(spark)
    K.write_periods(K.period_sketches(rows, F.col("day"), ["k"], "v"), f"{workdir}/s")
    stored = K.read_periods(spark, f"{workdir}/s")
    found = {r["k"]: r for r in K.window_sketches(stored, ["k"], date(2024, 1, 2), date(2024, 1, 3)).select(
        "k", K.held().alias("n"), *[K.quantile(p).alias(f"q{i}") for i, p in enumerate((0.1, 0.5, 0.99))]).collect()}
    values = defaultdict(list)
    for r in rows.filter("day >= '2024-01-02'").collect():
        if r["v"] is not None:
            values[r["k"]].append(r["v"])
    for k in ("hot", "cold"):
        assert found[k]["n"] == len(values[k])
        for i, p in enumerate((0.1, 0.5, 0.99)):
            rank = sum(v <= found[k][f"q{i}"] for v in values[k]) / len(values[k])
            assert abs(rank - p) < 2 * K.rank_error()
    assert found["none"]["n"] == 0 and found["none"]["q1"] is None


def test_a_period_written_again_replaces_its_sketch_only(spark, workdir):
    rows = _skewed(spark, 3000)
    K.write_periods(K.period_sketches(rows, F.col("day"), ["k"], "v"), f"{workdir}/s")
    again = rows.filter("day = '2024-01-02'").limit(0).unionByName(
        spark.createDataFrame([(date(2024, 1, 2), "hot", 7)], rows.schema))
    K.write_periods(K.period_sketches(again, F.col("day"), ["k"], "v"), f"{workdir}/s")
    stored = K.read_periods(spark, f"{workdir}/s")
    one = K.window_sketches(stored, ["k"], date(2024, 1, 2), date(2024, 1, 2)).select("k", K.held().alias("n"),
                                                                                    K.quantile(0.5).alias("q"))
    assert [tuple(r) for r in one.collect()] == [("hot", 1, 7.0)]
    rest = K.window_sketches(stored, ["k"], date(2024, 1, 1), date(2024, 1, 1)).filter("k = 'hot'")
    assert rest.select(K.held()).first()[0] == 800


def test_drift_from_sketches_is_the_exact_index(spark):
    rows = _skewed(spark).withColumn("v", F.expr("CASE WHEN day = '2024-01-03' THEN v / 2 ELSE v END"))
    s = K.period_sketches(rows, F.col("day"), ["k"], "v")
    edges = [10_000.0 * i for i in range(1, 10)]
    first = K.window_sketches(s, ["k"], date(2024, 1, 1), date(2024, 1, 2))
    found = {r["k"]: r["psi"] for r in K.drift(first, K.window_sketches(s, ["k"], date(2024, 1, 3), date(2024, 1, 3)),
                                               ["k"], edges).collect()}
    exact = {r["k"]: r["exact_psi"] for r in K.exact_drift(rows, F.col("day") < date(2024, 1, 3), ["k"], "v",
                                                           edges).collect()}
    assert found["none"] is None and "none" not in exact
    for k in ("hot", "cold"):
        assert exact[k] > 0.25 and abs(found[k] - exact[k]) < 0.1 * exact[k]


def test_drift_of_a_key_in_one_window_is_null(spark):
    rows = _skewed(spark, 300).filter("NOT (k = 'cold' AND day = '2024-01-03')")
    s = K.period_sketches(rows, F.col("day"), ["k"], "v")
    both = K.drift(K.window_sketches(s, ["k"], date(2024, 1, 1), date(2024, 1, 2)),
                   K.window_sketches(s, ["k"], date(2024, 1, 3), date(2024, 1, 3)), ["k"], [50_000.0])
    cold = both.filter("k = 'cold'").first()
    assert cold["psi"] is None and cold["cur_n"] == 0 and cold["ref_n"] == 20


# --- session graph -------------------------------------------------------------------------------

def _ranks(edges, rounds):
    out = Counter()
    for (a, _), w in edges.items():
        out[a] += w
    items = sorted({x for e in edges for x in e})
    ranks = dict.fromkeys(items, G.RANK_UNIT)
    for _ in range(rounds):
        got = Counter()
        for (a, b), w in edges.items():
            got[b] += ranks[a] * w // out[a]
        unsent = len(items) * G.RANK_UNIT - sum(got.values())
        equal = 15 * G.RANK_UNIT // 100 + 85 * unsent // (100 * len(items))
        ranks = {i: equal + 85 * got[i] // 100 for i in items}
    return ranks


def test_transitions_end_with_sessions_and_ranks_equal_a_plain_loop(spark):
    rng = random.Random(3)
    clicks, t = [], 0
    for i in range(1500):
        t += rng.choice([1000, 60_000, G.SESSION_GAP_MS, G.SESSION_GAP_MS + 1])
        user = rng.choice(["hot"] * 5 + ["a", "b", None])
        clicks.append((str(i), user, rng.choice(["x", "y", "z", "w", "end", None]), t if rng.random() > 0.02 else None))
    df = spark.createDataFrame(clicks, "event_id string, user_id string, item_id string, event_ts_ms long")
    want, last = Counter(), {}
    for _, user, item, at in sorted((c for c in clicks if None not in c), key=lambda c: (c[3], c[0])):
        if user in last and at - last[user][1] <= G.SESSION_GAP_MS and last[user][0] != item:
            want[last[user][0], item] += 1
        last[user] = (item, at)
    edges = G.item_transitions(df)
    assert {(r[0], r[1]): r[2] for r in edges.collect()} == want
    sink = edges.filter("from_item <> 'end'")  # 'end' sends nothing
    kept = {e: w for e, w in want.items() if e[0] != "end"}
    assert {r["item"]: r["rank"] for r in G.rank_items(sink, 4).collect()} == _ranks(kept, 4)


def test_ranks_of_no_edges_are_no_rows(spark):
    assert G.rank_items(spark.createDataFrame([], "from_item string, to_item string, weight long")).count() == 0


# --- trajectories --------------------------------------------------------------------------------

def _off(p, a, b):
    """Distance in metres of p from segment a-b, in plain arithmetic."""
    scale = 111_194.92664455873
    shrink = math.cos(math.radians(a[0]))
    px, py, ax, ay, bx, by = [v * scale * (shrink if i % 2 == 0 else 1) for i, v in enumerate(
        (p[1], p[0], a[1], a[0], b[1], b[0]))]
    length = (bx - ax) ** 2 + (by - ay) ** 2
    t = 0 if not length else max(0, min(1, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / length))
    return math.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay))


def test_left_out_points_lie_within_the_tolerance_and_hot_lines_are_cut(spark):
    rng = random.Random(5)
    rows, lat, lon = [], 10.0, 106.0
    for i in range(1000):
        lat, lon = lat + rng.uniform(-1e-3, 1.2e-3), lon + rng.uniform(-1e-3, 1.2e-3)
        rows.append(("hot", i, lat, lon))
    rows += [("one", 0, 1.0, 2.0), ("same", 0, 1.0, 2.0), ("same", 1, 1.0, 2.0), ("same", 2, 1.0, 2.0),
             ("gap", 0, None, 2.0), ("gap", 1, 3.0, float("nan")), (None, 0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, t long, latitude double, longitude double")
    found = defaultdict(dict)
    for r in G.simplified(df, "k", ["t"], 200.0, piece=128).collect():
        assert r["position"] not in found[r["k"]]
        found[r["k"]][r["position"]] = (r["lat"], r["lon"])
    assert set(found) == {"hot", "one", "same"}
    assert set(found["one"]) == {0} and set(found["same"]) == {0, 2}
    kept, line = sorted(found["hot"]), [r[2:] for r in rows if r[0] == "hot"]
    assert kept[0] == 0 and kept[-1] == 999 and {128 * i for i in range(1, 8)} <= set(kept) and len(kept) < 500
    for a, b in zip(kept, kept[1:]):
        assert found["hot"][a] == line[a]
        assert all(_off(line[p], line[a], line[b]) <= 201 for p in range(a + 1, b))


def test_a_point_beyond_the_tolerance_stays(spark):
    rows = [("k", i, 10.0, 106.0 + i * 1e-3) for i in range(50)]
    rows[20] = ("k", 20, 10.01, 106.02)
    df = spark.createDataFrame(rows, "k string, t long, latitude double, longitude double")
    kept = {r["position"] for r in G.simplified(df, "k", ["t"], 100.0).collect()}
    assert kept == {0, 19, 20, 21, 49}


# --- marginal relevance --------------------------------------------------------------------------

def _plain_mmr(entries, weight, limit):
    """entries: (item, score, vector or None)."""
    pool = sorted(entries, key=lambda e: (-e[1], e[0]))[:limit]
    top = max((abs(e[1]) for e in pool), default=0) or 1

    def cosine(a, b):
        if not a or not b or not any(a) or not any(b):
            return 0.0
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    out = []
    while pool:
        best = max(pool, key=lambda e: (round(weight * e[1] / top - (1 - weight) * max(
            (cosine(e[2], o[2]) for o in out), default=0.0), 12), -pool.index(e)))
        out.append(best)
        pool.remove(best)
    return [e[0] for e in out]


def test_marginal_relevance_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    vectors = {f"i{n:02d}": [float(x) for x in rng.standard_normal(8)] for n in range(40)}
    vectors |= {"i01": [0.0] * 8, "i02": None, "i03": vectors["i04"]}
    users = {"hot": 40, "few": 5, "one": 1}
    rows, want = [], {}
    for user, n in users.items():
        entries = [(i, float(rng.integers(1, 20)), vectors[i]) for i in sorted(vectors)[:n]]
        rows += [(user, i, s) for i, s, _ in entries]
        want[user] = _plain_mmr(entries, 0.6, 12)
    rows += [(None, "i01", 1.0), ("few", None, 2.0), ("few", "i30", None), ("few", "i31", float("nan"))]
    found = R.mmr(spark.createDataFrame(rows, "user_id string, item_id string, score double"),
                  spark.createDataFrame([(k, v) for k, v in vectors.items() if k != "i05"] + [("i05", vectors["i05"])],
                                        "item_id string, embedding array<double>"), limit=12, weight=0.6)
    got = defaultdict(dict)
    for r in found.collect():
        got[r["user_id"]][r["position"]] = r["item_id"]
    assert {u: [p[i] for i in sorted(p)] for u, p in got.items()} == want


def test_extreme_vectors_keep_their_direction_and_weight_one_keeps_the_score_order():
    units = R.unit_rows([[1e-200, 0.0], [1e200, 1e200], [float("inf"), 1.0], [1.0], None], 2)
    assert np.allclose(units, [[1, 0], [2 ** -0.5, 2 ** -0.5], [0, 0], [0, 0], [0, 0]])
    assert R.mmr_order(np.array([3.0, 2.0, 2.0, 1.0]), np.eye(4), 1.0) == [0, 1, 2, 3]
