"""Nested cells: one parent, seven children, and nothing lost between levels."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from hexvault.functions import hexgrid as HG
from hexvault.functions.spatial import cell_resolution, hexcell


def test_children_and_parents_are_inverse_everywhere(spark):
    rnd = random.Random(2)
    points = [(rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for _ in range(300)] + [(None, 1.0), (0.0, 0.0)]
    df = HG.with_nested(spark.createDataFrame(points, "lat double, lon double"), "lat", "lon",
                        {r: f"c{r}" for r in range(4, 10)}).withColumn("own", hexcell("lat", "lon", 9))
    df = spark.createDataFrame(df.collect(), df.schema)
    rows = df.select("*", HG.cell_children("c7").alias("kids"), HG.cell_parent("c8").alias("up2"),
                     HG.cell_digit(F.col("c8")).alias("digit"), cell_resolution("c5").alias("res")).collect()
    for r in rows:
        if r.own is None:
            assert r.c9 is None and r.c4 is None and r.kids is None
            continue
        assert r.c9 == r.own and r.up2 == r.c7 and r.res == 5
        assert len(set(r.kids)) == 7 and r.kids[r.digit] == r.c8
    kids = df.filter("c7 is not null").select("c7", F.posexplode(HG.cell_children("c7")).alias("d", "kid"))
    wrong = kids.filter((HG.cell_parent("kid") != F.col("c7")) | (HG.cell_digit(F.col("kid")) != F.col("d")))
    assert wrong.count() == 0


def test_every_cell_of_a_region_has_one_parent_with_seven_children(spark):
    q, r = F.col("id") % 70 - 35, F.expr("cast(id / 70 as long)") - 35
    cells = spark.range(4900).select(HG._packed(F.lit(9), q, r).alias("cell"))
    by_parent = cells.select(HG.cell_parent("cell").alias("p"), HG.cell_digit(F.col("cell")).alias("d")).groupBy("p").agg(
        F.count("*").alias("n"), F.countDistinct("d").alias("digits")).collect()
    assert all(x.n == x.digits <= 7 for x in by_parent) and sum(x.n == 7 for x in by_parent) > 550


def test_children_surround_their_parent(spark):
    assert sorted(HG.UNITS) == list(range(7)) and len(set(HG.UNITS.values())) == 7
    assert all(q * q + q * r + r * r <= 1 for q, r in HG.UNITS.values())
