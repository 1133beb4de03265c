"""Hand-written vault fixtures (golden inputs) as Spark DataFrames.

F-1: six raw tables with exact replays and out-of-order pings.
F-2: F-1 plus an extra interaction, a distant more popular merchant and moved points.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from hexvault import schemas as S
from hexvault.operators.vault import Vault


def md5u(text: str) -> str:
    return hashlib.md5(text.encode("utf-8")).hexdigest().upper()


DAY = dt.date(2026, 10, 15)
CELL7, CELL9 = 609777061401198591, 618784260652793855
CLICK, TELE = "events.clickstream", "events.telemetry"


def at(h: int, m: int = 0) -> dt.datetime:
    return dt.datetime(2026, 10, 15, h, m)


def vault_rows(edge: bool = False) -> dict[str, list[tuple]]:
    u1, u2, m1, c1, c2 = (md5u(x) for x in ("u1", "u2", "m1", "c1", "c2"))
    i1, i2, i3 = (md5u(x) for x in ("i1", "i2", "i3"))
    rows = {
        "hub_user": [(u1, "u1", at(10), CLICK), (u1, "u1", at(10), CLICK), (u2, "u2", at(11), CLICK)],
        "hub_merchant": [(m1, "m1", at(10), CLICK), (m1, "m1", at(10), CLICK)],
        "hub_courier": [(c1, "c1", at(10), TELE), (c1, "c1", at(10), TELE), (c2, "c2", at(10), TELE)],
        "link_user_merchant_interaction": [
            (i1, u1, m1, at(10), CLICK), (i1, u1, m1, at(10), CLICK),
            (i2, u1, m1, at(10, 30), CLICK), (i3, u2, m1, at(11), CLICK)],
        "sat_interaction_context_spatial": [
            (i1, at(10), "click", "ios", 100, "home_feed", 10.775, 106.7, CELL7, CELL9, None, CLICK),
            (i1, at(10), "click", "ios", 100, "home_feed", 10.775, 106.7, CELL7, CELL9, None, CLICK),
            (i2, at(10, 30), "purchase", "ios", 300, "home_feed", 10.776 if edge else 10.775, 106.7,
             CELL7, CELL9, None, CLICK),
            (i3, at(11), "click", "ios", 200, "home_feed", 10.777 if edge else 10.775, 106.7,
             CELL7, CELL9, None, CLICK)],
        "sat_courier_telemetry_spatial": [
            (c1, at(10, 30), 10.775, 106.7, 20.0, 90, "delivering", CELL7, CELL9, None, TELE),
            (c1, at(10), 10.775, 106.7, 0.0, 0, "idle", CELL7, CELL9, None, TELE),
            (c1, at(10, 30), 10.775, 106.7, 20.0, 90, "delivering", CELL7, CELL9, None, TELE),
            (c2, at(10), 10.775, 106.7, 0.0, 0, "idle", CELL7, CELL9, None, TELE)],
    }
    if edge:
        i4 = md5u("i4")
        rows["link_user_merchant_interaction"].append((i4, u1, m1, at(10), CLICK))
        rows["sat_interaction_context_spatial"].append(
            (i4, at(10), "click", "ios", 500, "home_feed", 10.775, 106.7, CELL7, CELL9, None, CLICK))
        m2 = md5u("m2")
        rows["hub_merchant"].append((m2, "m2", at(10), CLICK))
        far7, far9 = CELL7 + 1000, CELL9 + 1000  # distinct far cells (opaque ids)
        for k in range(5):
            key = md5u(f"distant_interaction_{k}")
            rows["link_user_merchant_interaction"].append((key, u1, m2, at(10), CLICK))
            rows["sat_interaction_context_spatial"].append(
                (key, at(10), "click", "ios", 100, "home_feed", 10.81, 106.74, far7, far9, None, CLICK))
    return rows


def vault(spark, edge: bool = False, rows: dict | None = None, schemas: dict | None = None) -> Vault:
    rows = rows or vault_rows(edge)
    schemas = {**S.VAULT_TABLES, **(schemas or {})}
    return Vault({n: spark.createDataFrame(rows[n], schemas[n]) for n in Vault.NAMES})
