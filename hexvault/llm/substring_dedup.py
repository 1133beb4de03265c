"""Substring dedup: repeated word windows, found behind a count-min prefilter.

Pass 1 hashes every window of ``window`` words and sends, per task, sorted and
compressed cell numbers of a count-min sketch (``DEPTH`` rows of ``WIDTH`` cells with
counters that stop at two). Cells are merged by shard; the merged sketch, one bit a
cell for "two or more", has a fixed size (DEPTH * WIDTH / 8 = 128 MiB, whatever the
input) and goes to the workers as a broadcast. It can only overestimate, so no
repeated window is lost. Pass 2 hashes the windows again and keeps those estimated
repeated: inside a task each is reduced to its earliest start (the others are known
repeats already), with all texts that tie for it, so a passage of a third of all
documents gives one row per task; across tasks an exact grouping by 80 bits of hash
finds the starts that are not the earliest. Repeats are gathered by id and text key,
so many texts of one id (null, say) are spread. Pass 3 drops the words covered by repeats.

Beyond about WIDTH windows the sketch fills up and filters less; the result stays
exact, the grouping just gets more rows. Raise WIDTH with the memory of the workers.

Defined cases: a null text has no words; a null id counts as the smallest id; equal
rows (same id and text) are one document and each gets the same result; rows with one
id and different texts order by start only, and equal starts do not remove each other;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexvault.llm.common import text_key

WINDOW = 20
DEPTH, WIDTH_BITS, SHARD_BITS = 2, 29, 20
#: Bases of the two rolling polynomial hashes, finishers of the cell rows (fixed values).
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
FINISH = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
#: Text characters handled at once, windows gathered before a flush, words remembered.
SLICE_CHARS, FLUSH, CACHE = 1 << 22, 1 << 22, 500_000
NO_ID = -(1 << 63)
#: Bits of the second hash that are grouped beside the first; known repeats stand outside them.
H2_BITS, SURE = 16, -1


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def rolled(hashes: np.ndarray, window: int, base: int) -> np.ndarray:
    """Polynomial hash of every window, by doubling (log2(window) passes over the words)."""
    if len(hashes) < window:
        return np.zeros(0, dtype=np.uint64)
    done, size = None, 0
    block, length, power = hashes, 1, base
    with np.errstate(over="ignore"):
        for bit in range(window.bit_length()):
            if window >> bit & 1:
                if done is None:
                    done, size = block, length
                else:  # done covers the first ``size`` words, the block the next ``length``
                    n = len(hashes) - size - length + 1
                    done = done[:n] + np.uint64(pow(base, size, 1 << 64)) * block[size:size + n]
                    size += length
            if window >> (bit + 1):
                n = len(block) - length
                block = block[:n] + np.uint64(power) * block[length:length + n]
                length, power = 2 * length, power * power % (1 << 64)
    return done


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with a bounded number of characters (one long text is a range)."""
    start = chars = 0
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for i, size in enumerate(sizes):
        if chars and chars + size > SLICE_CHARS:
            yield start, i
            start, chars = i, 0
        chars += size
    if start < len(sizes):
        yield start, len(sizes)


def _windows(texts: pa.Array, memory: _WordHashes, window: int):
    """(h1, h2, row, start) of every window of the texts."""
    words: list[bytes] = []
    counts = []
    for t in texts.cast(pa.binary()):
        own = (t.as_py() or b"").split()
        counts.append(len(own))
        words += own
    counts = np.array(counts, dtype=np.int64)
    hashes = np.fromiter(map(memory.__getitem__, words), dtype=np.uint64, count=len(words))
    del words
    if len(hashes) < window:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    first = np.cumsum(counts) - counts
    row = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(hashes)) - first[row]
    inside = np.flatnonzero(start + window <= counts[row])
    h1, h2 = (rolled(hashes, window, b)[inside] for b in BASES)
    return h1, h2, row[inside], start[inside]


def _cells(h1: np.ndarray, h2: np.ndarray, depth: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h1 if depth == 0 else h1 ^ (h2 << np.uint64(1))) * np.uint64(FINISH[depth])
        x ^= x >> np.uint64(32)
        x *= np.uint64(FINISH[1 - depth])
    return x >> np.uint64(64 - WIDTH_BITS)


# --- pass 1: the sketch ------------------------------------------------------------------

SKETCH = "depth int, shard int, n int, cells binary, twice binary"


def _planes(values: np.ndarray) -> bytes:
    """Sorted 20-bit numbers as compressed byte planes of their differences."""
    steps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4)[:, :3].T).tobytes(),
                       codec="zstd", asbytes=True)


def _values(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 3 * n, codec="zstd", asbytes=True), np.uint8).reshape(3, n)
    steps = np.zeros((n, 4), dtype=np.uint8)
    steps[:, :3] = planes.T
    return np.cumsum(steps.view("<u4").ravel(), dtype=np.int64)


def _partial(cells: np.ndarray, depth: int) -> pa.RecordBatch:
    found, counts = np.unique(cells, return_counts=True)
    shard = (found >> np.uint64(SHARD_BITS)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(shard, prepend=-1))
    low = (found & np.uint64((1 << SHARD_BITS) - 1)).astype(np.uint32)
    out: list[tuple] = []
    for a, b in zip(cuts, np.append(cuts[1:], len(found))):
        out.append((depth, int(shard[a]), int(b - a), _planes(low[a:b]),
                    np.packbits(counts[a:b] > 1).tobytes()))
    depths, shards, n, packed, twice = zip(*out) if out else ([],) * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(depths, pa.int32()), pa.array(shards, pa.int32()), pa.array(n, pa.int32()),
         pa.array(packed, pa.binary()), pa.array(twice, pa.binary())],
        ["depth", "shard", "n", "cells", "twice"])


def partial_sketches(docs: DataFrame, window: int) -> DataFrame:
    def run(batches):
        memory, gathered, n = _WordHashes(), [[] for _ in range(DEPTH)], 0
        for batch in batches:
            texts = batch.column("text")
            for a, b in _slices(texts):
                h1, h2, _, _ = _windows(texts.slice(a, b - a), memory, window)
                for d in range(DEPTH):
                    gathered[d].append(_cells(h1, h2, d).astype(np.uint32))
                n += len(h1)
                if n >= FLUSH:
                    for d in range(DEPTH):
                        yield _partial(np.concatenate(gathered[d]).astype(np.uint64), d)
                    gathered, n = [[] for _ in range(DEPTH)], 0
        if n:
            for d in range(DEPTH):
                yield _partial(np.concatenate(gathered[d]).astype(np.uint64), d)

    return docs.select("text").mapInArrow(run, SKETCH)


def merged_sketch(partials: DataFrame) -> list[tuple[int, int, bytes]]:
    """(depth, shard, compressed bits of the cells counted twice or more); a fixed-size result."""

    def run(batches):
        counters: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(5))):
                depth, shard, n, packed, twice = r
                counter = counters.setdefault((depth, shard), np.zeros(1 << SHARD_BITS, dtype=np.uint8))
                cells = _values(packed, n)
                add = 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=n)
                counter[cells] = np.minimum(counter[cells] + add, 2)
        keys = list(counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([pa.compress(np.packbits(counters[k] >= 2).tobytes(), codec="zstd", asbytes=True)
                       for k in keys], pa.binary())], ["depth", "shard", "bits"])

    spark = partials.sparkSession
    tasks = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    merged = partials.repartition(tasks, "depth", "shard").mapInArrow(run, "depth int, shard int, bits binary")
    return [(r.depth, r.shard, bytes(r.bits)) for r in merged.toLocalIterator()]


_SKETCHES: dict[str, list[np.ndarray]] = {}


def _unpacked(name: str, shards: list[tuple[int, int, bytes]]) -> list[np.ndarray]:
    """The sketch as bit arrays, kept by the worker for its next tasks (one sketch at a time)."""
    if name not in _SKETCHES:
        _SKETCHES.clear()
        bits = [np.zeros(1 << (WIDTH_BITS - 3), dtype=np.uint8) for _ in range(DEPTH)]
        size = 1 << (SHARD_BITS - 3)
        for depth, shard, packed in shards:
            bits[depth][shard * size:(shard + 1) * size] = np.frombuffer(
                pa.decompress(packed, size, codec="zstd", asbytes=True), np.uint8)
        _SKETCHES[name] = bits
    return _SKETCHES[name]


def _set(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    at = cells.astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


# --- pass 2: exact grouping --------------------------------------------------------------

FLAGGED = "h1 long, h2 long, id long, text_key long, start long, more array<long>"


def _lists(values: np.ndarray, cuts: np.ndarray, rows: np.ndarray, total: int) -> pa.Array:
    """``total`` lists, null but for ``rows``, which hold the values from each cut on."""
    sizes = np.zeros(total, dtype=np.int64)
    sizes[rows] = np.diff(np.append(cuts, len(values)))
    none = np.ones(total, dtype=bool)
    none[rows] = False
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)),
                                    pa.array(values), mask=pa.array(none))


def _cuts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _reduced(parts: list[tuple]) -> pa.RecordBatch:
    """Earliest start of each window of the flushed rows, and the sure repeats per document.

    ``more`` of an earliest start are the keys of the other texts that tie for it; of
    sure repeats (``h2`` is ``SURE``, ``h1`` only deals them out) their starts.
    """
    h1, h2, ids, keys, start = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((start, ids, h2, h1))
    same = np.zeros(len(order), dtype=bool)
    a, b = order[1:], order[:-1]
    same[1:] = (h1[a] == h1[b]) & (h2[a] == h2[b])
    # A start equal to the earliest of its group is no repeat.
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    lead = order[first]
    later = (ids[order] != ids[lead]) | (start[order] != start[lead])
    candidate = np.sort(order[~same])
    # Other texts that start the group as early as its lead (equal rows share their key).
    tied = ~later & (keys[order] != keys[lead])
    to, other = np.searchsorted(candidate, lead[tied]), keys[order[tied]]
    by = np.lexsort((other, to))
    to, other = to[by], other[by]
    once = _cuts(to, other)
    to, other = to[once], other[once]
    ties = _cuts(to)
    repeat = order[later]
    group = np.lexsort((start[repeat], keys[repeat], ids[repeat]))
    rid, rkey, rstart = ids[repeat][group], keys[repeat][group], start[repeat][group]
    once = _cuts(rid, rkey, rstart)
    rid, rkey, rstart = rid[once], rkey[once], rstart[once]
    cuts = _cuts(rid, rkey)
    n, m = len(candidate), len(cuts)
    with np.errstate(over="ignore"):
        deal = rid[cuts] * np.int64(31) + rkey[cuts]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([h1[candidate].view(np.int64), deal])),
         pa.array(np.concatenate([h2[candidate].astype(np.int64), np.full(m, SURE)])),
         pa.array(np.concatenate([ids[candidate], rid[cuts]])),
         pa.array(np.concatenate([keys[candidate], rkey[cuts]])),
         pa.array(np.concatenate([start[candidate], np.zeros(m, dtype=np.int64)])),
         _lists(np.concatenate([other, rstart]), np.concatenate([ties, len(other) + cuts]),
                np.concatenate([to[ties], n + np.arange(m)]), n + m)],
        ["h1", "h2", "id", "text_key", "start", "more"])


def flagged_windows(docs: DataFrame, shards: list[tuple[int, int, bytes]], window: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(shards)
    name = hashlib.md5(b"".join(x[2] for x in shards)).hexdigest()

    def run(batches):
        bits, memory, gathered, n = _unpacked(name, sent.value), _WordHashes(), [], 0
        for batch in batches:
            texts = batch.column("text")
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            keys = batch.column("text_key").to_numpy(zero_copy_only=False)
            for a, b in _slices(texts):
                h1, h2, row, start = _windows(texts.slice(a, b - a), memory, window)
                for d in range(DEPTH):
                    hit = _set(bits[d], _cells(h1, h2, d))
                    h1, h2, row, start = h1[hit], h2[hit], row[hit], start[hit]
                gathered.append((h1, h2 >> np.uint64(64 - H2_BITS), ids[a + row], keys[a + row], start))
                n += len(h1)
                if n >= FLUSH // 2:
                    yield _reduced(gathered)
                    gathered, n = [], 0
        if n:
            yield _reduced(gathered)

    return docs.mapInArrow(run, FLAGGED)


def text_bits(text: str):
    return text_key(text)


def repeats(rows: DataFrame, window: int) -> DataFrame:
    """``id, text_key, marks``: the starts of each document's windows that also start earlier."""
    flagged = flagged_windows(rows, merged_sketch(partial_sketches(rows, window)), window)
    in_group = Window.partitionBy("h1", "h2").orderBy("id", "start")
    mark = lambda key, start: F.struct(key.alias("text_key"), start.cast("int").alias("start"))
    sure = F.transform("more", lambda s: mark(F.col("text_key"), s))
    tied = F.transform(F.concat(F.array("text_key"), F.coalesce("more", F.array().cast("array<bigint>"))),
                       lambda k: mark(k, F.col("start")))
    ranked = flagged.withColumn("rank", F.rank().over(in_group))
    later = F.when(F.col("h2") == SURE, sure).when(F.col("rank") > 1, tied)
    # Narrow rows are sent to their document first and gathered there.
    sent = (ranked.select("id", F.explode(later).alias("mark")).select("id", "mark.text_key", "mark.start")
            .repartition("id", "text_key"))
    return sent.groupBy("id", "text_key").agg(F.collect_list("start").alias("marks"))


def deduplicated(docs: DataFrame, text: str = "text", id_col: str = "doc_id", window: int = WINDOW,
                 with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row; ``with_text`` adds the kept text."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                       text_bits(text).alias("text_key"),
                       F.col(text).alias("text"))
    joined = rows.join(repeats(rows, window), ["id", "text_key"], "left").select("id", "text", "marks")
    schema = ("doc_id long, n_words long, n_removed long, kept_sha256 string"
              + (", kept_text string" if with_text else ""))

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            ids = batch.column("id").to_pylist()
            for i, t, s in zip(ids, batch.column("text").cast(pa.binary()), batch.column("marks")):
                words = (t.as_py() or b"").split()
                total = len(words)
                if s.is_valid:
                    at = s.values.to_numpy()
                    edge = np.zeros(total + window + 1, dtype=np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + window, -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(edge)[:total] == 0)]
                kept = b" ".join(words)
                out.append((None if i == NO_ID else i, total, total - len(words),
                            hashlib.sha256(kept).hexdigest(), *([kept.decode()] if with_text else [])))
            columns = list(zip(*out)) or [[]] * (5 if with_text else 4)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names[:len(columns)])

    return joined.mapInArrow(run, schema)
