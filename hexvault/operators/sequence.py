"""Skew-safe per-key sequence features: previous/next row, forward fill, running sums.

A ``Window.partitionBy(key)`` puts every row of a key into one task; a key that
holds a third of the data then becomes a third of the job in a single task.
``sequence_features`` instead cuts each large key into ordered *chunks* – time buckets
of the leading order column (an hour by default, a day for dates, narrower for a key
that is hot inside one) – computes the features inside
each chunk with a window over ``(key, chunk)``, and carries the state across
chunk boundaries from a small per-chunk summary (one row per large key and bucket).
A key of at most ``MAX_KEY_ROWS`` rows is one chunk and needs no summary:

* ``lag``    – value of the immediately preceding row of the key (null for the first);
* ``lead``   – value of the immediately following row;
* ``ffill``  – last non-null value at or before the row (as-of fill);
* ``cumsum`` – running sum up to and including the row.

The chunk is a deterministic function of the row (not a sampled range
partition), so every branch of the plan, and any recomputation after a lost
executor, assigns the same chunk. The order must be total within a key (add
tie-breakers) for deterministic output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexvault.session import cut_lineage

HOUR_MS, DAY_MS = 3_600_000, 86_400_000
#: Rows of a key in one chunk beyond which the key gets narrower chunks, and those chunks.
MAX_CHUNK_ROWS = 500_000
NARROW_MS = (60_000, 1_000, 1)
#: Rows up to which a key stays whole, and its only chunk.
MAX_KEY_ROWS = 50_000
WHOLE = -2 ** 63
#: Keys with narrower chunks up to which their widths are broadcast.
BROADCAST_KEYS = 10_000


def time_bucket(df: DataFrame, column: str, width_ms: int | Column = DAY_MS) -> Column:
    """Monotone bucket of a timestamp, date or epoch-millisecond column."""
    dtype = df.schema[column].dataType
    c, width = F.col(column), (width_ms if isinstance(width_ms, Column) else F.lit(width_ms)).cast("long")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(F.unix_micros(c.cast("timestamp")) / (width * 1000))
    if isinstance(dtype, T.DateType):
        return F.floor(F.unix_date(c) * F.lit(DAY_MS) / width)
    return F.floor(c / width)


def narrow_widths(df: DataFrame, key: str, column: str, bucket_ms: int, max_rows: int) -> DataFrame | None:
    """``_w_key, _width``: chunk width (ms) of the keys with over ``max_rows`` rows in a chunk; None without any.

    Rows are counted by key and chunk, combined before the shuffle; only the keys found are
    counted again at the next width. There are at most rows / ``max_rows`` of them. They are
    checkpointed, so all parts of a plan and any recomputation cut a key alike. A date has
    nothing narrower than its day, and rows of equal or no time stay in one chunk.
    """
    if isinstance(df.schema[column].dataType, T.DateType):
        return None
    rows, found = df.select(F.col(key).alias("_w_key"), column), None
    widths = [bucket_ms, *[w for w in NARROW_MS if w < bucket_ms]]
    for width, narrower in zip(widths, widths[1:]):
        bucket = time_bucket(rows, column, width)
        hot = cut_lineage(rows.filter(F.col(column).isNotNull()).groupBy("_w_key", bucket.alias("_b")).count()
                          .filter(F.col("count") > max_rows).select("_w_key").distinct())
        if hot.isEmpty():
            break
        this = hot.withColumn("_width", F.lit(narrower).cast("long"))
        if found is not None:
            same = found["_w_key"].eqNullSafe(hot["_w_key"])
            this = this.unionByName(found.join(hot, same, "left_anti"))
        found = this
        some = hot.withColumnRenamed("_w_key", "_h_key")
        rows = rows.join(some, F.col("_w_key").eqNullSafe(F.col("_h_key")), "left_semi")
    return found


def key_widths(df: DataFrame, key: str, column: str, bucket_ms: int = HOUR_MS,
               max_rows: int = MAX_CHUNK_ROWS) -> DataFrame | None:
    """``_w_key, _width``: chunk width (ms) of every key that is cut into chunks; None without any.

    Keys of over ``MAX_KEY_ROWS`` rows are cut. They are found by counting rows by key, combined
    before the shuffle, and only their rows are looked at for narrower chunks.
    """
    rows = df.select(F.col(key).alias(key), column)
    large = cut_lineage(rows.groupBy(F.col(key).alias("_l_key")).count()
                        .filter(F.col("count") > min(MAX_KEY_ROWS, max_rows)).select("_l_key"))
    if large.isEmpty():
        return None
    narrow = narrow_widths(rows.join(large, F.col(key).eqNullSafe(F.col("_l_key")), "left_semi"), key, column,
                           bucket_ms, max_rows)
    if narrow is None:
        return large.select(F.col("_l_key").alias("_w_key"), F.lit(bucket_ms).cast("long").alias("_width"))
    return cut_lineage(large.join(narrow, F.col("_l_key").eqNullSafe(F.col("_w_key")), "left").select(
        F.col("_l_key").alias("_w_key"), F.coalesce("_width", F.lit(bucket_ms).cast("long")).alias("_width")))


def with_chunks(df: DataFrame, key: str, column: str, widths: DataFrame) -> DataFrame:
    """``df`` with ``_chunk``: the time bucket of a row of the given keys, ``WHOLE`` for any other key."""
    if widths.count() <= BROADCAST_KEYS:
        widths = F.broadcast(widths)
    x = df.join(widths, df[key].eqNullSafe(F.col("_w_key")), "left")
    return x.withColumn("_chunk", F.when(F.col("_width").isNull(), F.lit(WHOLE)).otherwise(
        time_bucket(df, column, F.col("_width")))).drop("_w_key", "_width")


def chunked(df: DataFrame, key: str, column: str, bucket_ms: int = HOUR_MS,
            max_rows: int = MAX_CHUNK_ROWS) -> DataFrame:
    """``df`` with ``_chunk``: the time bucket of each row of a large key, narrower where the key is hot."""
    widths = key_widths(df, key, column, bucket_ms, max_rows)
    return df.withColumn("_chunk", F.lit(WHOLE)) if widths is None else with_chunks(df, key, column, widths)


def dealt(df: DataFrame, key: str, column: str, bucket_ms: int = HOUR_MS,
          max_rows: int = MAX_CHUNK_ROWS) -> DataFrame:
    """``df`` dealt out by key and chunk: a DISTINCT and ``sequence_features`` on it share this one shuffle.

    Has ``_chunk`` if there is any large key.
    """
    widths = key_widths(df, key, column, bucket_ms, max_rows)
    if widths is None:
        return df.repartition(key)
    return with_chunks(df, key, column, widths).repartition(key, "_chunk")


def sequence_features(df: DataFrame, key: str, order: list[str], lag: list[str] = (),
                      lead: list[str] = (), ffill: list[str] = (), cumsum: list[str] = (),
                      bucket: Column | None = None, bucket_ms: int = HOUR_MS,
                      max_rows: int = MAX_CHUNK_ROWS, is_dealt: bool = False) -> DataFrame:
    """Add ``prev_<c>``, ``next_<c>``, ``ffill_<c>``, ``cum_<c>`` columns (see module doc).

    ``bucket`` must be non-decreasing in the order; by default it is the
    ``bucket_ms`` bucket of the leading order column for large keys, narrower for keys with
    more than ``max_rows`` rows in one (found by one small job first). ``is_dealt``: ``df``
    comes from ``dealt`` by the same key and leading order column.
    """
    lag, lead, ffill, cumsum = list(lag), list(lead), list(ffill), list(cumsum)
    columns = [c for c in df.columns if c != "_chunk"]
    if bucket is not None:
        x = df.withColumn("_chunk", bucket)
    elif is_dealt:
        x = df
    else:
        widths = key_widths(df, key, order[0], bucket_ms, max_rows)
        x = df if widths is None else with_chunks(df, key, order[0], widths)
    whole = "_chunk" not in x.columns
    asc = [F.col(c).asc_nulls_first() for c in order]
    w = (Window.partitionBy(key) if whole else Window.partitionBy(key, "_chunk")).orderBy(*asc)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = [F.row_number().over(w).alias("_first")] if lag else []
    cols += [F.lead(F.lit(1)).over(w).isNull().alias("_last")] if lead else []
    cols += [F.lag(c).over(w).alias(f"_lag_{c}") for c in lag]
    cols += [F.lead(c).over(w).alias(f"_lead_{c}") for c in lead]
    cols += [F.last(c, ignorenulls=True).over(upto).alias(f"_ff_{c}") for c in ffill]
    cols += [F.sum(c).over(upto).alias(f"_cs_{c}") for c in cumsum]
    x = x.select("*", *cols)
    if whole:  # every key is one chunk
        return x.select(*columns, *[F.col(f"_lag_{c}").alias(f"prev_{c}") for c in lag],
                        *[F.col(f"_lead_{c}").alias(f"next_{c}") for c in lead],
                        *[F.col(f"_ff_{c}").alias(f"ffill_{c}") for c in ffill],
                        *[F.col(f"_cs_{c}").alias(f"cum_{c}") for c in cumsum])

    # one row per chunk: its first/last row values, last non-null values, totals
    order_key = F.struct(*[F.col(c) for c in order])
    aggs: list[Column] = []
    if lag:
        aggs.append(F.max_by(F.struct(*[F.col(c) for c in lag]), order_key).alias("_tail"))
    if lead:
        aggs.append(F.min_by(F.struct(*[F.col(c) for c in lead]), order_key).alias("_head"))
    for c in ffill:
        aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order_key)).alias(f"_lnn_{c}"))
    for c in cumsum:
        aggs.append(F.sum(c).alias(f"_tot_{c}"))
    cut = x.filter(F.col("_chunk").isNull() | (F.col("_chunk") != WHOLE))
    summary = cut.groupBy(key, "_chunk").agg(*aggs)
    ws = Window.partitionBy(key).orderBy("_chunk")
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    carry: list[Column] = []
    if lag:
        carry.append(F.lag("_tail").over(ws).alias("_c_tail"))
    if lead:
        carry.append(F.lead("_head").over(ws).alias("_c_head"))
    for c in ffill:
        carry.append(F.last(f"_lnn_{c}", ignorenulls=True).over(before).alias(f"_c_ff_{c}"))
    for c in cumsum:
        carry.append(F.sum(f"_tot_{c}").over(before).alias(f"_c_cs_{c}"))
    summary = summary.select(key, "_chunk", *carry)

    # Null keys and null times form chunks of their own and carry state like any other.
    summary = summary.withColumnsRenamed({key: "_s_key", "_chunk": "_s_chunk"})
    y = x.join(summary, x[key].eqNullSafe(F.col("_s_key")) & x["_chunk"].eqNullSafe(F.col("_s_chunk")), "left")
    out = [F.col(c) for c in columns]
    out += [F.when(F.col("_first") == 1, F.col(f"_c_tail.{c}")).otherwise(F.col(f"_lag_{c}")).alias(f"prev_{c}")
            for c in lag]
    out += [F.when(F.col("_last"), F.col(f"_c_head.{c}")).otherwise(F.col(f"_lead_{c}")).alias(f"next_{c}")
            for c in lead]
    out += [F.coalesce(F.col(f"_ff_{c}"), F.col(f"_c_ff_{c}")).alias(f"ffill_{c}") for c in ffill]
    out += [(F.col(f"_cs_{c}") + F.coalesce(F.col(f"_c_cs_{c}"), F.lit(0))).alias(f"cum_{c}")
            for c in cumsum]
    return y.select(*out)
