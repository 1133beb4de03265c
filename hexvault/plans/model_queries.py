"""Registered queries over sketches, session graphs, trajectories and re-ranked lists."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hexvault import oracle as O
from hexvault.operators import graphs as G
from hexvault.operators import rerank as R
from hexvault.operators import sketches as K
from hexvault.plans.context import Context
from hexvault.plans.registry import register
from hexvault.session import checkpoint_path
from hexvault.sources.tables import id_number

_DAY = f"CAST({O.load_date()} AS DATE)"
SPEED_QUANTILES = (0.1, 0.5, 0.9)
#: Dwell limits of the drift index: half decades of milliseconds.
DWELL_EDGES = [10 ** (i / 2) - 1 for i in range(1, 10)]


@register("d_speed_sketch", O.with_chain(f"""
    SELECT status, count(speed_kmh) AS pings, q.name, TRUE AS within_error
    FROM telemetry, (VALUES ({'), ('.join(repr(f'p{round(p * 100)}') for p in SPEED_QUANTILES)})) q(name)
    WHERE status IS NOT NULL GROUP BY status, q.name HAVING count(speed_kmh) > 0"""))
def _q(c: Context):
    """Speed percentiles per status from stored monthly sketches, checked against exact ranks."""
    path = checkpoint_path(c.spark, "sketches", uuid.uuid4().hex)
    pings = c.pings.filter(F.col("status").isNotNull())
    K.write_periods(K.period_sketches(pings, F.trunc(F.to_date("event_time"), "month"), ["status"], "speed_kmh"), path)
    stored = K.read_periods(c.spark, path)
    ends = stored.agg(F.min("period"), F.max("period")).first()
    merged = K.window_sketches(stored, ["status"], *ends).withColumn("pings", K.held())
    asked = merged.select("status", "pings", F.explode(F.array(*[
        F.struct(F.lit(f"p{round(p * 100)}").alias("name"), F.lit(p).alias("p"), K.quantile(p).alias("at"))
        for p in SPEED_QUANTILES])).alias("q")).select("status", "pings", "q.*")
    ranks = K.ranks_of(pings, ["status"], "speed_kmh", asked.select("status", "name", "at"))
    slack = 2 * K.rank_error()  # twice the 99 % bound
    within = (F.col("below") <= F.col("p") + slack) & (F.col("upto") >= F.col("p") - slack)
    return asked.join(ranks, ["status", "name"]).select("status", "pings", "name", within.alias("within_error"))


@register("d_drift_sketch", O.with_chain(f"""
    SELECT event_type, count(dwell_time_ms) FILTER (early) AS ref_n, count(dwell_time_ms) FILTER (NOT early) AS cur_n,
           TRUE AS within_error
    FROM (SELECT *, {_DAY} < (SELECT min({_DAY}) + CAST((max({_DAY}) - min({_DAY}) + 1) // 2 AS INTEGER)
                              FROM clickstream) AS early FROM clickstream)
    GROUP BY event_type HAVING ref_n > 0 AND cur_n > 0"""))
def _q(c: Context):
    """Dwell drift per event type between the first and second half of the days, from stored sketches."""
    path = checkpoint_path(c.spark, "sketches", uuid.uuid4().hex)
    clicks = c.clicks.withColumn("_day", F.to_date("event_time"))
    K.write_periods(K.period_sketches(clicks, F.col("_day"), ["event_type"], "dwell_time_ms"), path)
    stored = K.read_periods(c.spark, path)
    first, last = stored.agg(F.min("period"), F.max("period")).first()
    from datetime import timedelta
    cut = first + timedelta(days=((last - first).days + 1) // 2)
    found = K.drift(K.window_sketches(stored, ["event_type"], first, cut - timedelta(days=1)),
                    K.window_sketches(stored, ["event_type"], cut, last), ["event_type"], DWELL_EDGES)
    exact = K.exact_drift(clicks, F.col("_day") < F.lit(cut), ["event_type"], "dwell_time_ms", DWELL_EDGES)
    close = F.abs(F.col("psi") - F.col("exact_psi")) <= 0.02 + 0.1 * F.abs("exact_psi")
    return (found.filter((F.col("ref_n") > 0) & (F.col("cur_n") > 0)).join(exact, "event_type")
            .select("event_type", "ref_n", "cur_n", close.alias("within_error")))


GRAPH_ROUNDS = 5
_MOVES = [("steps", """SELECT item_id, lag(item_id) OVER w AS from_item, event_ts_ms - lag(event_ts_ms) OVER w AS gap
             FROM click_once WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND event_ts_ms IS NOT NULL
             WINDOW w AS (PARTITION BY user_id ORDER BY event_ts_ms, event_id, item_id)"""),
          ("moves", f"""SELECT from_item, item_id AS to_item, count(*) AS weight FROM steps
             WHERE gap <= {G.SESSION_GAP_MS} AND from_item <> item_id GROUP BY 1, 2""")]


def _rank_ctes() -> list[tuple[str, str]]:
    found = [*_MOVES,
             ("sent_by", "SELECT *, sum(weight) OVER (PARTITION BY from_item) AS out_weight FROM moves"),
             ("items", "SELECT from_item AS item FROM moves UNION SELECT to_item FROM moves"),
             ("rank0", f"SELECT item, CAST({G.RANK_UNIT} AS HUGEINT) AS rank FROM items")]
    for i in range(1, GRAPH_ROUNDS + 1):
        found.append((f"got{i}", f"""SELECT to_item AS item, sum(rank * weight // out_weight) AS got
                        FROM sent_by JOIN rank{i - 1} r ON r.item = from_item GROUP BY 1"""))
        found.append((f"rank{i}", f"""SELECT items.item, CAST({(100 - G.FOLLOWED) * G.RANK_UNIT // 100} AS HUGEINT)
                        + {G.FOLLOWED} * ((SELECT count(*) FROM items) * {G.RANK_UNIT}
                          - (SELECT coalesce(sum(got), 0) FROM got{i}))::HUGEINT // (100 * (SELECT count(*) FROM items))
                        + {G.FOLLOWED} * coalesce(got, 0)::HUGEINT // 100 AS rank
                        FROM items LEFT JOIN got{i} g ON g.item = items.item"""))
    return found


@register("d_session_graph", O.with_chain("SELECT * FROM moves", _MOVES))
def _q(c: Context):
    """Weighted graph of the items that follow one another inside a session."""
    return G.item_transitions(c.clicks_once)


@register("d_item_rank", O.with_chain(f"SELECT item, CAST(rank AS BIGINT) AS rank FROM rank{GRAPH_ROUNDS}",
                                      _rank_ctes()))
def _q(c: Context):
    """Rank of every item in the session graph after a fixed number of rounds."""
    return G.rank_items(G.item_transitions(c.clicks_once), GRAPH_ROUNDS)


@register("d_courier_lines")
def _q(c: Context):
    """Courier trajectories, simplified to two kilometres (rows-only check; tested against brute force)."""
    return G.simplified(c.pings, "courier_id", ["event_ts_ms", "telemetry_id"], 2000.0)


@register("d_mmr_rerank")
def _q(c: Context):
    """Each user's most seen items re-ranked by marginal relevance over the item vectors (tested against brute force)."""
    seen = c.clicks_once.groupBy("user_id", "item_id").agg(F.count("*").cast("double").alias("score"))
    vectors = c.table("embeddings").select(F.col("vec_id").alias("_k"), "embedding")
    items = seen.select("item_id").distinct().withColumn("_k", id_number("item_id", "ITM_"))
    return R.mmr(seen, items.join(vectors, "_k").select("item_id", "embedding"))
