"""Stateful streams: historised satellites, last categories per user, late-row counts.

* ``history_stream`` – insert-only-on-change satellite. Rows wait in the state of their
  key until the watermark has passed them, so out-of-order rows take their place in time
  order, and a replay of a row that has passed is dropped as late. The state of a key is
  the hash diff of its last row and the rows of the delay, not its history.
* ``last_categories_stream`` – the k latest clicked categories of every user, a list of
  at most k entries that a timer clears when the user has been idle for long.
* ``LateRows`` – a listener that writes the progress of a query, with the rows that each
  batch dropped as late, to a table.

Both processors read rows grouped by key inside a micro-batch; what a batch repeats of a
key is combined before the shuffle.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from hexvault.functions.hashing import hash_diff
from hexvault.sources import files

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Days without a click after which the list of a user is forgotten.
IDLE_DAYS = 90


class OnState:
    """The state store that list, map and value state need, for the queries started inside."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.before = self.spark.conf.get(PROVIDER, None)
        self.spark.conf.set(PROVIDER, ROCKSDB)  # a query keeps the setting it was started with

    def __exit__(self, *_):
        if self.before is None:
            self.spark.conf.unset(PROVIDER)
        else:
            self.spark.conf.set(PROVIDER, self.before)


# --- historised satellite ----------------------------------------------------------------

class _Changes(StatefulProcessor):
    """Emits a row when its hash diff differs from that of the row before it in time.

    What a batch brings of a key waits as one packed entry, so state calls follow the keys
    of a batch, not its rows.
    """

    def __init__(self, key: str, order: list[str], kept: pa.Schema, out: list[str]):
        self.key, self.order, self.kept, self.out = key, order, kept, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "hash_diff string")
        self.pending = handle.getListState("pending", "rows binary")

    def _packed(self, rows: pa.Table) -> tuple[bytes]:
        return (_packed(rows, self.kept),)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [pa.Table.from_pandas(frame, self.kept, nthreads=1, preserve_index=False) for frame in rows]
        if new:
            new = pa.concat_tables(new).replace_schema_metadata(None)
            self.pending.appendValue(self._packed(new))
            first = pc.min(new["ts_us"]).as_py() // 1000
            self.handle.registerTimer(max(first, timerValues.getCurrentWatermarkInMs() + 1))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        packed = [entry[0] for entry in self.pending.get()]
        if not packed:  # another timer of the key took them
            return
        held = pa.concat_tables([_unpacked(rows) for rows in packed])
        passed = pc.less_equal(held["ts_us"], timerValues.getCurrentWatermarkInMs() * 1000)
        ready, rest = held.filter(passed), held.filter(pc.invert(passed))
        if not len(ready):
            return
        if len(rest):
            self.pending.put([self._packed(rest)])
            self.handle.registerTimer(pc.min(rest["ts_us"]).as_py() // 1000)
        else:
            self.pending.clear()
        ready = ready.take(pc.sort_indices(ready, sort_keys=[(c, "ascending") for c in self.order],
                                           null_placement="at_start"))
        yield from self.emitted(key, ready)

    def emitted(self, key, ready: pa.Table) -> Iterator[pd.DataFrame]:
        """The changes among rows in time order that the watermark has passed."""
        ready = ready.to_pandas()
        before = ready["hash_diff"].shift(1)
        if self.last.exists():
            before.iloc[0] = self.last.get()[0]
        changed = ready.loc[before.isna() | (before != ready["hash_diff"]), self.out]
        self.last.update((ready["hash_diff"].iloc[-1],))
        if len(changed):
            changed.insert(0, self.key, key[0])
            yield changed


class _BucketChanges(_Changes):
    """The same for all keys of a bucket at once: the bucket's rows wait together, and its state
    holds the last hash diff of every key. Calls and state follow the buckets, not the keys.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "keys binary")
        self.pending = handle.getListState("pending", "rows binary")

    def emitted(self, key, ready: pa.Table) -> Iterator[pd.DataFrame]:
        name, last = self.order[0], pa.schema([self.kept.field(self.order[0]), self.kept.field("hash_diff")])
        known = {}
        if self.last.exists():
            known = dict(zip(*(c.to_pylist() for c in _unpacked(self.last.get()[0]).columns)))
        keys = ready[name].combine_chunks().dictionary_encode()
        of = pc.fill_null(keys.indices, len(keys.dictionary)).to_numpy(zero_copy_only=False)
        keys = [*keys.dictionary.to_pylist(), None]
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        diff = ready["hash_diff"].to_pandas().to_numpy(dtype=object)
        before = np.append([None], diff[:-1])
        before[first] = [known.get(keys[k]) for k in of[first]]
        changed = pd.isna(before) | (before != diff)
        known.update((keys[of[a]], diff[a]) for a in np.append(first[1:], len(of)) - 1)
        self.last.update((_packed(pa.table([list(known), list(known.values())], schema=last), last),))
        if changed.any():
            yield ready.select([name, *self.out]).filter(pa.array(changed)).to_pandas()


def _packed(rows: pa.Table, schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(rows: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(rows)).read_all()


def history_stream(rows: DataFrame, key: str, ts: str, attributes: list[str], tie_break: list[str],
                   delay: str, buckets: int | None = None) -> DataFrame:
    """Streaming twin of ``features.historize``: the rows at which the hash diff of a key changes.

    ``delay`` is how late a row may arrive. Result: key, ``ts``, the attributes,
    ``hash_diff``. A state belongs to a key, or with ``buckets`` to so many hash buckets of
    keys, which a query must keep for as long as its checkpoint: for many keys of few rows.
    """
    extra = [c for c in [*tie_break, *attributes] if c != ts]
    kept = list(dict.fromkeys(extra))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    stamped = (rows.select(key, F.col(ts).cast("timestamp").alias("_at"), *kept)
               .withColumn("hash_diff", hash_diff(attributes)).withColumn("ts_us", F.unix_micros("_at"))
               .withWatermark("_at", delay))
    held = to_arrow_schema(stamped.select("ts_us", *kept, "hash_diff").schema)
    sent = list(dict.fromkeys(["ts_us", *attributes, "hash_diff"]))
    schema = ", ".join(f"{c} {kinds.get(c, 'long' if c == 'ts_us' else 'string')}" for c in [key, *sent])
    if buckets is None:
        grouped, step = stamped.groupBy(key), _Changes(key, ["ts_us", *tie_break], held, sent)
    else:
        stamped = stamped.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
        held = pa.schema([to_arrow_schema(stamped.select(key).schema).field(0), *held])
        grouped, step = stamped.groupBy("_bucket"), _BucketChanges(key, [key, "ts_us", *tie_break], held, sent)
    out = grouped.transformWithStateInPandas(step, schema, "Append", "EventTime")
    return out.select(key, F.timestamp_micros("ts_us").cast("timestamp_ntz").alias(ts), *attributes, "hash_diff")


# --- last categories ---------------------------------------------------------------------

class _LastClicks(StatefulProcessor):
    """Keeps the k latest clicks of a user; emits the list when it changes."""

    SCHEMA = "event_ts_ms long, event_id string, category string"

    def __init__(self, k: int, idle_days: int):
        self.k, self.idle_ms = k, idle_days * 86_400_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clicks = handle.getListState("clicks", self.SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(x) for x in self.clicks.get()] if self.clicks.exists() else []
        best = {x[1]: x for x in held}
        for frame in rows:
            for ms, event_id, category in zip(frame["event_ts_ms"], frame["event_id"], frame["category"]):
                best[event_id] = (int(ms), event_id, category)
        latest = sorted(best.values(), key=lambda x: (x[0], x[1]), reverse=True)[:self.k]
        if latest != held:
            self.clicks.put(latest)
            self.handle.registerTimer(max(latest[0][0] + self.idle_ms, timerValues.getCurrentWatermarkInMs() + 1))
            yield pd.DataFrame({"user_id": [key[0]],
                                "last_categories": ["|".join(x[2] for x in latest if x[2] is not None)]})


    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        latest = max((x[0] for x in self.clicks.get()), default=None) if self.clicks.exists() else None
        if latest is not None and latest + self.idle_ms <= timerValues.getCurrentWatermarkInMs():
            self.clicks.clear()  # no newer click came since the timer was set
        return iter([])


def last_categories_stream(clicks: DataFrame, k: int = 5, idle_days: int = IDLE_DAYS) -> DataFrame:
    """Streaming twin of ``features.last_clicked_categories``: ``user_id, last_categories`` on every change.

    Order is event time, then event id, whatever the order of arrival; a replayed click
    changes nothing. Clicks may be as late as a user may be idle: a click that is later
    belongs to a list that is forgotten. Run it in update mode.
    """
    clicked = (clicks.filter(F.col("event_type") == "click")
               .select("user_id", "event_ts_ms", "event_id", "category",
                       F.timestamp_millis("event_ts_ms").alias("_at")).withWatermark("_at", f"{idle_days} days"))
    return clicked.groupBy("user_id").transformWithStateInPandas(
        _LastClicks(k, idle_days), "user_id string, last_categories string", "Update", "EventTime")


# --- late rows ---------------------------------------------------------------------------

class LateRows(StreamingQueryListener):
    """Writes ``query, batch_id, input_rows, late_rows, watermark`` of every batch under ``root``.

    A batch folder is rewritten when a batch is reported again, so a restart repeats nothing.
    Late rows are those that the first stateful step dropped; put a row-wise step (the
    dedup of ids) before windows, which drop whole groups of rows combined before.
    """

    SCHEMA = "query string, batch_id long, input_rows long, late_rows long, watermark string"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        steps = p.stateOperators
        # Operators are listed from the sink up: the last is the first that rows meet.
        late = int(steps[-1].numRowsDroppedByWatermark) if steps else 0
        row = (p.name or str(p.id), int(p.batchId), int(p.numInputRows), late, (p.eventTime or {}).get("watermark"))
        self.spark.createDataFrame([row], self.SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            f"{self.root}/query={p.id}/batch={int(p.batchId):012d}")

    def wait_for(self, query, seconds: float = 60) -> None:
        """Progress is reported behind the query; returns once its last batch is in the table."""
        last = query.lastProgress
        folder = f"{self.root}/query={query.id}"
        until = time.time() + seconds
        while last and f"batch={int(last.batchId):012d}" not in files.committed_children(self.spark, folder, "batch="):
            if time.time() > until:
                raise TimeoutError(f"no progress of batch {last.batchId} after {seconds} s")
            time.sleep(0.1)

    def read(self) -> DataFrame:
        folders = [f"{self.root}/{q}/{b}" for q in files.children(self.spark, self.root)
                   for b in files.committed_children(self.spark, f"{self.root}/{q}", "batch=")]
        return files.read_folders(self.spark, folders, self.SCHEMA)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def counted_windows(events: DataFrame, key: str, window: str, delay: str, lateness: str, dedup: str = "event_id",
                    ) -> DataFrame:
    """Counts per key and window of distinct events; rows later than delay and lateness are dropped.

    The dedup by id stands before the windows, so each late row is dropped, and reported,
    by itself.
    """
    from hexvault.streaming.features import _seconds, _ts
    allowed = f"{_seconds(delay) + _seconds(lateness)} seconds"
    once = _ts(events).withWatermark("event_time_ltz", allowed).dropDuplicatesWithinWatermark([dedup])
    return (once.groupBy(F.col(key), F.window("event_time_ltz", window).alias("w")).agg(F.count("*").alias("events"))
            .select(key, F.col("w.start").alias("window_start"), "events"))
