"""Session graphs and trajectories.

* ``item_transitions`` – weighted graph of the items that follow one another in a session;
* ``rank_items`` – a fixed number of rank rounds over that graph, in whole numbers, so that
  the result does not depend on the order of any sum;
* ``simplified`` – line simplification per key in pieces of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexvault.operators.sequence import sequence_features
from hexvault.session import cut_lineage

SESSION_GAP_MS = 30 * 60 * 1000
#: Mean rank, and the part of a rank that follows edges (per cent).
RANK_UNIT, FOLLOWED = 1_000_000_000, 85
#: Points that one call of the line simplification holds.
PIECE = 4096
METRES_PER_DEGREE = 111_194.92664455873


def item_transitions(clicks: DataFrame, gap_ms: int = SESSION_GAP_MS) -> DataFrame:
    """``from_item, to_item, weight``: how often an item directly follows another in a user's session.

    A session ends where ``gap_ms`` pass without an event; an item that follows itself and
    rows without a user, item or time give no edge.
    """
    rows = clicks.filter("user_id IS NOT NULL AND item_id IS NOT NULL AND event_ts_ms IS NOT NULL")
    seq = sequence_features(rows.select("user_id", "item_id", "event_ts_ms", "event_id"), "user_id",
                            ["event_ts_ms", "event_id", "item_id"], lag=["event_ts_ms", "item_id"])
    near = F.col("event_ts_ms") - F.col("prev_event_ts_ms") <= gap_ms
    return (seq.filter(near & (F.col("prev_item_id") != F.col("item_id")))
            .groupBy(F.col("prev_item_id").alias("from_item"), F.col("item_id").alias("to_item"))
            .agg(F.count("*").alias("weight")))


def rank_items(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """``item, rank``: rank of every item after ``rounds`` rounds; the mean is about ``RANK_UNIT``.

    In a round an item sends its rank along its edges by weight (rounded down). An item gets
    ``FOLLOWED`` per cent of what reaches it, of an equal part of what was not sent (items
    without edges, roundings), and the rest of ``RANK_UNIT``. The sums combine before the
    shuffle, and every round is checkpointed, so a lost executor repeats one round at most.
    """
    totals = edges.groupBy("from_item").agg(F.sum("weight").alias("out_weight"))
    sent_by = cut_lineage(edges.join(totals, "from_item"))
    items = cut_lineage(sent_by.select(F.col("from_item").alias("item"))
                        .unionAll(sent_by.select("to_item")).distinct())
    n = items.count()
    ranks = items.withColumn("rank", F.lit(RANK_UNIT).cast("long"))
    for _ in range(rounds if n else 0):
        part = F.expr("(CAST(rank AS DECIMAL(19, 0)) * CAST(weight AS DECIMAL(19, 0))) "
                      "div CAST(out_weight AS DECIMAL(19, 0))")
        got = cut_lineage(sent_by.join(ranks.withColumnRenamed("item", "from_item"), "from_item")
                          .select(F.col("to_item").alias("item"), part.alias("part"))
                          .groupBy("item").agg(F.sum("part").alias("got")))
        unsent = n * RANK_UNIT - (got.agg(F.sum("got")).first()[0] or 0)
        equal = (100 - FOLLOWED) * RANK_UNIT // 100 + FOLLOWED * unsent // (100 * n)
        ranks = items.join(got, "item", "left").select(
            "item", (F.lit(equal).cast("long")
                     + F.expr(f"({FOLLOWED} * coalesce(got, 0L)) div 100")).alias("rank"))
    return cut_lineage(ranks)


def line_keep(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Points of a line that stay: both ends, and in every stretch the farthest one beyond the tolerance."""
    keep = np.zeros(len(x), dtype=bool)
    if len(x):
        keep[[0, -1]] = True
    open_ = [(0, len(x) - 1)]
    while open_:
        a, b = open_.pop()
        if b - a < 2:
            continue
        off = chord_distance(x[a + 1:b], y[a + 1:b], x[a], y[a], x[b], y[b])
        far = int(np.argmax(off))
        if off[far] > tolerance:
            keep[a + 1 + far] = True
            open_ += [(a, a + 1 + far), (a + 1 + far, b)]
    return keep


def chord_distance(x, y, ax, ay, bx, by):
    """Distance of points from the segment a-b."""
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    at = np.clip(((x - ax) * dx + (y - ay) * dy) / length, 0, 1) if length else np.zeros(len(x))
    return np.hypot(x - ax - at * dx, y - ay - at * dy)


def simplified(points: DataFrame, key: str, order: list[str], tolerance_m: float,
               lat: str = "latitude", lon: str = "longitude", piece: int = PIECE) -> DataFrame:
    """``key, position, lat, lon``: the points of each key's line that stay.

    Every point left out lies within ``tolerance_m`` of the segment between the kept points
    around it (flat metres at the latitude of its piece). ``order`` must be total within a
    key. Lines are cut every ``piece`` points, where the point stays, so a group never grows
    with its key. Points without key or coordinates take no part; positions count from 0.
    """
    valid = points.filter(F.col(key).isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()
                          & ~F.isnan(F.col(lat).cast("double")) & ~F.isnan(F.col(lon).cast("double")))
    rows = valid.select(key, *[c for c in order if c not in (key, lat, lon)], F.col(lat).cast("double").alias("lat"),
                        F.col(lon).cast("double").alias("lon"), F.lit(1).cast("long").alias("_one"))
    names = [{lat: "lat", lon: "lon"}.get(c, c) for c in order]
    numbered = sequence_features(rows, key, names, cumsum=["_one"]).select(
        key, (F.col("cum__one") - 1).alias("position"), "lat", "lon")
    # The first point of a piece is the last one of the piece before, too.
    own = F.floor(F.col("position") / piece).cast("long")
    ends = (F.col("position") % piece == 0) & (F.col("position") > 0)
    pieces = numbered.withColumn("piece", F.explode(F.when(ends, F.array(own - 1, own)).otherwise(F.array(own))))
    schema = T.StructType([points.schema[key], T.StructField("position", T.LongType()),
                           T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])

    def thin(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        at = table.column("position").to_numpy()
        lats, lons = table.column("lat").to_numpy(), table.column("lon").to_numpy()
        x = lons * METRES_PER_DEGREE * np.cos(np.radians(lats[0]))
        keep = line_keep(x, lats * METRES_PER_DEGREE, tolerance_m)
        keep &= at // piece == table.column("piece")[0].as_py()  # a shared end leaves once
        return table.filter(pa.array(keep)).select([key, "position", "lat", "lon"])

    return pieces.groupBy(key, "piece").applyInArrow(thin, schema)
