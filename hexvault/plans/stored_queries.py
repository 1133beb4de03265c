"""Registered queries over stored layouts: distributed models, incremental snapshots, clustered days."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hexvault import oracle as O
from hexvault.functions import hexgrid as HG
from hexvault.operators import vault_ext as VX
from hexvault.plans import maintenance as MT
from hexvault.plans import snapshots as SN
from hexvault.plans.context import Context
from hexvault.plans.distributed import buckets_for, distribute, join_distributed
from hexvault.plans.registry import ORACLES, register
from hexvault.session import checkpoint_path


def _folder(c: Context, name: str) -> str:
    return checkpoint_path(c.spark, name, uuid.uuid4().hex)


@register("fct_users_distributed", O.with_chain("""
    SELECT u.user_id, count(*) AS events, min(f.event_at) AS first_event, max(f.event_at) AS last_event
    FROM fct_interactions f JOIN stg_users u ON f.hk_user_id = u.hk_user_id GROUP BY u.user_id"""))
def _q(c: Context):
    """Events per user from the fact and the user hub, stored distributed by user: the join has no exchange."""
    root = _folder(c, "distributed")
    fact = c.models["fct_interactions"].select("hk_user_id", "event_at")
    rows = fact.count()
    buckets = buckets_for(rows)
    facts = distribute(fact, "hk_user_id", root, "fact_by_user", buckets, hot_rows=max(1000, rows // 20))
    users = distribute(c.models["stg_users"].select("hk_user_id", "user_id"), "hk_user_id", root, "users", buckets)
    return (join_distributed(facts, users).groupBy("user_id")
            .agg(F.count("*").alias("events"), F.min("event_at").alias("first_event"),
                 F.max("event_at").alias("last_event")))


@register("d_pit_stored", ORACLES["d_pit"])
def _q(c: Context):
    """Point-in-time table kept up to date: all days but the last, then the last day's pings."""
    store = SN.PitStore(_folder(c, "pit"), grain="month")
    last = c.pings.filter(F.col("order_id").isNotNull()).agg(F.max(F.to_date("event_time"))).first()[0]
    day = F.to_date("event_time")
    before, newest = c.pings.filter(day < F.lit(last)), c.pings.filter(day == F.lit(last))
    store.refresh(c.table("orders"), before, before)
    store.refresh(c.table("orders"), c.pings, newest)
    return store.read(c.spark)


@register("d_bridge_stored", ORACLES["d_bridge"])
def _q(c: Context):
    """Bridge kept in buckets of the user: old links first, then the buckets that newer links touch."""
    store = SN.BridgeStore(_folder(c, "bridge"), "hk_user_id")
    links, sat = c.vault["link_user_merchant_interaction"], c.vault["sat_interaction_context_spatial"]
    last = links.agg(F.max("load_date")).scalar()
    old = links.filter(F.col("load_date") < last - F.expr("INTERVAL 6 HOURS"))
    new = links.filter(F.col("load_date") >= last - F.expr("INTERVAL 6 HOURS"))
    store.refresh(c.spark, VX.bridge_user_merchant, [old, sat], old)
    store.refresh(c.spark, VX.bridge_user_merchant, [links, sat], new)
    return store.read(c.spark).select("hk_interaction_id", "hk_user_id", "hk_merchant_id", "event_at")


@register("d_vault_day_cell", O.with_chain("""
    SELECT CAST(load_date AS DATE) AS load_day, h3_res7, count(*) AS events FROM sat_i_v GROUP BY 1, 2"""))
def _q(c: Context):
    """Events per day and cell from the interaction satellite stored by day on a curve over cell and time; a batch is replayed."""
    path = _folder(c, "vault-days")
    sat = c.vault["sat_interaction_context_spatial"].drop("geom_wkb")
    first, last = sat.agg(F.min("load_date"), F.max("load_date")).first()
    early = F.col("load_date") < F.lit(first + (last - first) / 2)
    for batch, rows in ((0, sat.filter(early)), (1, sat.filter(~early)), (1, sat.filter(~early))):
        MT.write_day_partitioned(rows, path, batch, clustered_by=["h3_res7", "load_date"], files_per_batch=4)
    stored = c.spark.read.parquet(path)
    return stored.groupBy("load_day", "h3_res7").agg(F.count("*").alias("events"))


@register("d_nested_cells", O.with_chain(f"""
    SELECT resolution, cell, parent, count(*) AS events,
           CAST(sum((event_type = 'view_item')::INT) AS BIGINT) AS impressions,
           CAST(sum((event_type = 'click')::INT) AS BIGINT) AS clicks
    FROM (SELECT 8 AS resolution, c8 AS cell, c7 AS parent, event_type FROM cells
          UNION ALL SELECT 7, c7, {HG.sql_parent('c7')}, event_type FROM cells)
    GROUP BY ALL""", [("p8", f"SELECT event_type, {HG.sql_parent(O.hexcell('latitude', 'longitude', 9))} AS c8 "
                             "FROM stg_interactions"),
                      ("cells", f"SELECT event_type, c8, {HG.sql_parent('c8')} AS c7 FROM p8")]))
def _q(c: Context):
    """Density and clicks of nested cells: res 8 from the points, res 7 by adding up the children of each parent."""
    sat = c.models["stg_interactions"]
    fine = (HG.with_nested(sat.select("latitude", "longitude", "event_type"), "latitude", "longitude", {8: "cell"})
            .groupBy("cell").agg(F.count("*").alias("events"),
                                 F.sum((F.col("event_type") == "view_item").cast("long")).alias("impressions"),
                                 F.sum((F.col("event_type") == "click").cast("long")).alias("clicks"))
            .withColumn("parent", HG.cell_parent("cell")))
    sums = [F.sum(x).alias(x) for x in ("events", "impressions", "clicks")]
    coarse = fine.groupBy(F.col("parent").alias("cell")).agg(*sums).withColumn("parent", HG.cell_parent("cell"))
    columns = ["cell", "parent", "events", "impressions", "clicks"]
    return (fine.select(F.lit(8).alias("resolution"), *columns)
            .unionByName(coarse.select(F.lit(7).alias("resolution"), *columns)))
