"""Filter interaction audit on failing-id relations.

One pass over the texts writes, for every filter, the table of the rows that fail it.
These id tables and the table of all rows are bucketed by row number, so every join
below runs inside a bucket, without a shuffle, and a row number is never a hot key.

The rows go through the filters one after the other. At each, the left-anti join with
its id table passes the survivors on, and the left-semi join takes out what fails; what
fails goes on too, under the set of filters it has failed so far, since later filters
need to know what else they would have removed. No verdict depends on what is left, so
the split rows answer every prefix of every order, not only this one:

* survivors of a prefix: the rows that the joins never took out at one of its filters;
* removals of a filter after it: survivors of the prefix taken out at the filter;
* redundant: rows taken out at the filter that the prefix had removed already;
* fails of one filter only: rows taken out there and nowhere else;
* label losses: removals that are good or toxic by the labels.

Each part keeps 32 sums, from which its 120 orders follow.

Defined cases: a null text counts as empty, a null language as the empty part; equal
texts are compared by SHA-256; a null id equals no smaller id and has no label; rows
with one id and one text do not fail E by each other; a label counts if any row of
``labels`` gives it; repeated rows are documents of their own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from itertools import permutations
from math import factorial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexvault.llm.common import salted_lookup, stored
from hexvault.session import checkpoint_path

FILTERS = "ABCDE"
#: Characters that C and D count (fixed values).
CAPITALS, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
#: Rows of one bucket of the id tables.
BUCKET_ROWS = 1 << 20


def failures(text: bytes, points: int) -> tuple[bool, bool, bool, bool]:
    """Failure conditions that read one text (UTF-8); E compares the table and is added later."""
    words = text.split()  # of bytes: at blanks \x20 and \x09-\x0D only
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * capitals > 10 * points,
            len(text.translate(None, SYMBOLS)) < len(text))


def judged(docs: DataFrame, text: str = "text", id_col: str = "doc_id", part: str = "lang") -> DataFrame:
    """``row, id, part, identity, A, B, C, D``, stored, without the text."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text), F.lit("")).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [t.as_py() for t in batch.column("t").cast(pa.binary())]
            points = pc.utf8_length(batch.column("t")).to_pylist()
            found = list(zip(*map(failures, texts, points))) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("row", "id", "part")],
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                 *[pa.array(c, pa.bool_()) for c in found]], ["row", "id", "part", "identity", *"ABCD"])

    return stored(rows.mapInArrow(run, f"row long, id {kind}, part string, identity binary, "
                                       "A boolean, B boolean, C boolean, D boolean"), "filter-audit")


def repeated(rows: DataFrame) -> DataFrame:
    """Rows whose text stands under a smaller id as well. Only repeated texts are looked up."""
    first = (rows.groupBy("identity").agg(F.min("id").alias("first"), F.max("id").alias("last"))
             .filter("first < last").drop("last"))
    return salted_lookup(rows, first, ["identity"], "row").filter("id > first").drop("first")


def labelled(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``row, good, toxic``: the rows left-semi joined with the ids of either label."""
    ids = (labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
           .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
           .filter("good = 1 or toxic = 1"))
    return salted_lookup(rows.filter("id is not null"), ids, ["id"], "row").select("row", "good", "toxic")


def id_table(df: DataFrame, tag: str, buckets: int) -> DataFrame:
    """``df`` as a table of the shared folder, bucketed and sorted by ``row``."""
    spark = df.sparkSession
    name = f"{tag}_{uuid.uuid4().hex}"
    (df.repartition(buckets, "row").write.bucketBy(buckets, "row").sortBy("row")
     .option("path", checkpoint_path(spark, name)).saveAsTable(name))
    return spark.table(name)


def relations(docs: DataFrame, labels: DataFrame, **columns) -> tuple[DataFrame, dict[str, DataFrame], int]:
    """The id table of all rows (``row, part, good, toxic``), that of each filter (``row``), their buckets."""
    rows = judged(docs, **columns)
    buckets = max(2, -(-rows.count() // BUCKET_ROWS))
    marks = labelled(rows, labels).withColumnRenamed("row", "_row")
    whole = rows.join(marks, rows["row"] == marks["_row"], "left").select(
        "row", "part", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    fails = {f: id_table((repeated(rows) if f == "E" else rows.filter(f)).select("row"), f"fails_{f}", buckets)
             for f in FILTERS}
    return id_table(whole, "audited", buckets), fails, buckets


def split(whole: DataFrame, fails: dict[str, DataFrame], buckets: int) -> DataFrame:
    """``whole`` with ``failed``, the filters that took a row out, one bit each."""
    rows = whole.withColumn("failed", F.lit(0))
    for k, f in enumerate(FILTERS):
        ids = fails[f].hint("merge")
        survivors = rows.join(ids, "row", "left_anti")
        removed = rows.join(ids, "row", "left_semi").withColumn("failed", F.col("failed") + (1 << k))
        rows = survivors.unionAll(removed)
        if k % 2 and k + 1 < len(FILTERS):  # both halves read the rows again
            rows = id_table(rows, "split", buckets)
    return rows


def _steps() -> list[dict]:
    """The five steps of all 120 orders, by the bits of the filters before and at each step."""
    out = []
    for order in permutations(range(len(FILTERS))):
        for k, f in enumerate(order):
            out.append({"filter_order": "".join(FILTERS[x] for x in order), "step": k + 1, "f": f,
                        "bit": 1 << f, "before": sum(1 << x for x in order[:k])})
    return out


def _shares() -> list[list[dict]]:
    """For each filter, the sets of others and how many orders begin with each of them."""
    every, n = (1 << len(FILTERS)) - 1, len(FILTERS) - 1
    return [[{"before": s, "orders": factorial(s.bit_count()) * factorial(n - s.bit_count())}
             for s in range(every + 1) if not s >> f & 1] for f in range(len(FILTERS))]


def interactions(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """One row per part, order and step, zeros included (see the module's text)."""
    sums = (split(*relations(docs, labels, **columns)).groupBy("part", "failed")
            .agg(F.count("*").alias("n"), F.sum("good").cast("long").alias("good"),
                 F.sum("toxic").cast("long").alias("toxic")))
    # At most 32 entries a part, whatever the size of the table.
    parts = sums.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("sums"))

    def fixed(value, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(value)), kind)

    def total(items: Column, term) -> Column:
        return F.aggregate(items, F.lit(0).cast("long"), lambda s, x: s + term(x))

    def counted(holds, what: str = "n") -> Column:
        return total(F.filter("sums", lambda x: holds(x["failed"])), lambda x: x[what])

    def removed(before: Column, bit: Column, what: str = "n") -> Column:
        return counted(lambda m: (m.bitwiseAND(before) == 0) & (m.bitwiseAND(bit) != 0), what)

    shares = fixed(_shares(), "array<array<struct<before:int,orders:long>>>")
    shapley = F.transform(shares, lambda own, f: total(
        own, lambda x: x["orders"] * removed(x["before"], F.pow(F.lit(2), f).cast("int"))))
    steps = fixed(_steps(), "array<struct<filter_order:string,step:int,f:int,bit:int,before:int>>")
    out = parts.withColumn("shapley", shapley).withColumn("s", F.explode(steps))
    before, bit = F.col("s.before"), F.col("s.bit")
    return out.select(
        "part", "s.filter_order", "s.step",
        counted(lambda m: m.bitwiseAND(before + bit) == 0).alias("kept"),
        removed(before, bit).alias("removed"),
        counted(lambda m: (m.bitwiseAND(before) != 0) & (m.bitwiseAND(bit) != 0)).alias("redundant"),
        counted(lambda m: m == bit).alias("unique_fails"),
        removed(before, bit, "good").alias("good_lost"), removed(before, bit, "toxic").alias("toxic_lost"),
        F.element_at("shapley", F.col("s.f") + 1).alias("shapley"))
