"""Exact removal of repeated byte strings by prefix-free parsing.

*Parsing.* A position is a trigger if its rolling hash is the smallest of ``SPAN``
consecutive ones, so triggers depend on the bytes around them only and every string of
``length`` bytes holds one. Phrases run from trigger to trigger. Each string belongs to
the smallest trigger of its first ``SPAN`` positions: equal strings belong to equal
triggers, at the same distance. What a trigger stands in, from the first of its strings
to the end of the last, is its context: the tail of the phrases before the trigger, and
the parse from the trigger on. Where text repeats, contexts repeat as wholes, so the
work below is done once per distinct context instead of once per byte.

*Counting.* All strings of a trigger share the ``length - SPAN + 1`` bytes from it on.
Their hash is counted over the corpus (combined in the task first). A hash seen once
ends there; one whose contexts are all equal has repeats only; the rest is resolved.

*Corpus order.* Contexts of one hash meet in a task. The suffix array of the dictionary
ranks the suffixes of all phrase tails (prefix doubling), the suffix array of the parse
ranks what follows the triggers, with the common prefixes of neighbours. A string is a
suffix of a tail and then a prefix of a parse suffix, so both ranks together put the
strings in corpus order, in which equal ones are neighbours. Hashes of more than
``HOT`` occurrences are not gathered: their strings are grouped by 128 bits of hash,
with partial sums, which is exact as well and has no hot key.

Defined cases: a null text counts as empty; texts under ``length`` bytes lose nothing;
marks follow the text, so a null or repeated id needs no rule, and equal rows are
documents of their own that repeat each other; an empty table gives no rows; other
columns are ignored. Long texts are parsed in pieces of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexvault.llm.common import salted_lookup, stored

LENGTH, SPAN, GRAM = 200, 96, 8
#: Occurrences of a hash beyond which its strings are grouped by hash instead of in one task: a bound
#: on the memory of a task, which then holds at most so many contexts of one hash (some 15 MB).
HOT = 50_000
#: Bytes parsed at once, triggers gathered before a flush, contexts of a resolving task.
PIECE, FLUSH, TASK_CONTEXTS = 1 << 20, 1 << 18, 50_000
#: Bases of the rolling hashes and a finisher (fixed values).
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
FINISH = 0xFF51AFD7ED558CCD


def _byte_values() -> np.ndarray:
    """A well mixed number for each byte."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[0])
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x


class Rolling:
    """Hashes of any ranges of a byte array, from prefix sums and powers of a base."""

    values = _byte_values()
    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, raw: np.ndarray, base: int = BASES[0]):
        n = len(raw) + 1
        if base not in self._powers or len(self._powers[base][0]) < n:
            up, down = np.full(n, base, dtype=np.uint64), np.full(n, pow(base, -1, 1 << 64), dtype=np.uint64)
            up[0] = down[0] = 1
            self._powers[base] = np.multiply.accumulate(up), np.multiply.accumulate(down)
        self.down = self._powers[base][1]
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(self.values[raw] * self._powers[base][0][:n - 1], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self.down[start]
        return (x ^ (x >> np.uint64(32))) * np.uint64(FINISH)


def smallest(hashes: np.ndarray, span: int) -> np.ndarray:
    """Position of the smallest hash of every ``span`` consecutive ones, the first if equal."""
    best = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size < span:
        step = min(size, span - size)
        best = np.minimum(best[:-step], best[step:])
        size += step
    return (best & np.uint64((1 << 32) - 1)).astype(np.int64)


def parsed(raw: np.ndarray, ends: np.ndarray, doc: np.ndarray, length: int, span: int):
    """Triggers of concatenated texts: ``(rolling, trigger, first, size, doc, key, context)``.

    ``doc`` is the text of each byte and ``ends`` the end of each text. The strings of
    a trigger start at ``first`` and the ``size - 1`` positions after it.
    """
    rolling = Rolling(raw)
    at = np.arange(len(raw) - GRAM + 1)
    belongs = smallest(rolling.of(at, at + GRAM), span)
    starts = np.flatnonzero(np.arange(len(belongs)) + length <= ends[doc[:len(belongs)]])
    mine = belongs[starts]
    cuts = np.flatnonzero(np.diff(mine, prepend=-1))
    first, trigger = starts[cuts], mine[cuts]
    size = np.diff(np.append(cuts, len(starts)))
    key = rolling.of(trigger, trigger + length - span + 1)
    whole = rolling.of(first, first + size - 1 + length)
    with np.errstate(over="ignore"):
        whole ^= ((trigger - first) << 16 | size).astype(np.uint64) * np.uint64(BASES[1])
    return rolling, trigger, first, size, doc[first], key, whole


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list, list]]:
    """``(raw, ends, doc, rows, offsets)`` of bounded size; a long text comes in overlapping pieces.

    A cut between two pieces may cut the strings of a trigger in two, each string stays in one.
    """
    parts, rows, offsets, total = [], [], [], 0

    def flush():
        sizes = [len(p) for p in parts]
        raw = np.frombuffer(b"".join(parts), np.uint8)
        return raw, np.cumsum(sizes), np.repeat(np.arange(len(parts)), sizes), rows, offsets

    for row, text in enumerate(texts):
        for start in range(0, max(len(text) - length + 1, 0), PIECE):
            part = text[start:start + PIECE + length - 1]
            parts.append(part)
            rows.append(row)
            offsets.append(start)
            total += len(part)
            if total >= PIECE:
                yield flush()
                parts, rows, offsets, total = [], [], [], 0
    if parts:
        yield flush()


def _bytes(column: pa.Array) -> list[bytes]:
    return [t.as_py() for t in column.cast(pa.binary())]


def _batch(schema: dict[str, pa.DataType], *columns) -> pa.RecordBatch:
    signed = [c.view(np.int64) if isinstance(c, np.ndarray) and c.dtype == np.uint64 else c for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(signed, schema.values())], list(schema))


I64, I32 = pa.int64(), pa.int32()


# --- counting ----------------------------------------------------------------------------

def counted(rows: DataFrame, length: int, span: int) -> DataFrame:
    """``key, hits, same``: hashes that occur twice or more, and whether their contexts are all equal."""
    schema = {"key": I64, "hits": I64, "low": I64, "high": I64}

    def combined(found):
        key, whole = (np.concatenate(x) for x in zip(*found))
        whole = whole.view(np.int64)
        order = np.lexsort((whole, key))
        key, whole = key[order], whole[order]
        cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        last = np.append(cuts[1:], len(key)) - 1
        return _batch(schema, key[cuts], last - cuts + 1, whole[cuts], whole[last])

    def run(batches):
        found, n = [], 0
        for batch in batches:
            for raw, ends, doc, _, _ in pieces(_bytes(batch.column("text")), length):
                *_, key, whole = parsed(raw, ends, doc, length, span)
                found.append((key, whole))
                n += len(key)
                if n >= FLUSH:
                    yield combined(found)
                    found, n = [], 0
        if n:
            yield combined(found)

    parts = rows.select("text").mapInArrow(run, "key long, hits long, low long, high long")
    every = parts.groupBy("key").agg(F.sum("hits").alias("hits"), F.min("low").alias("low"), F.max("high").alias("high"))
    return stored(every.filter("hits > 1").select("key", "hits", (F.col("low") == F.col("high")).alias("same")),
                  "suffix-keys")


def occurrences(rows: DataFrame, length: int, span: int) -> DataFrame:
    """``id, text_key, key, context, at`` of every trigger; ``at`` packs first, distance and size."""
    schema = {c: I64 for c in ("id", "text_key", "key", "context", "at")}

    def run(batches):
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy() for c in ("id", "text_key"))
            for raw, ends, doc, row, offset in pieces(_bytes(batch.column("text")), length):
                _, trigger, first, size, part, key, whole = parsed(raw, ends, doc, length, span)
                row, offset = np.array(row)[part], np.array(offset)[part]
                begin = np.concatenate([[0], ends[:-1]])[part]
                at = (first - begin + offset) << 16 | (trigger - first) << 8 | size
                yield _batch(schema, ids[row], keys[row], key, whole, at)

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in schema))


# --- corpus order ------------------------------------------------------------------------

def suffix_ranks(tails: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(rank of the suffix at each byte of the joined tails and their ends, start of each tail).

    Prefix doubling over the dictionary; a suffix ends with its tail, equal suffixes share a rank.
    """
    sizes = np.array([len(t) for t in tails])
    ends = np.cumsum(sizes + 1) - 1
    stop = np.repeat(ends, sizes + 1)
    joined = np.frombuffer(b"\0".join(tails) + b"\0", np.uint8).astype(np.int64) + 1
    joined[ends] = 0
    rank = np.unique(joined, return_inverse=True)[1]
    at, step = np.arange(len(rank)), 1
    while step < sizes.max(initial=0) + 1:
        rank = np.unique(rank * (len(rank) + 1) + rank[np.minimum(at + step, stop)], return_inverse=True)[1]
        step *= 2
    return rank, ends - sizes


def common_prefixes(ordered: list[bytes]) -> np.ndarray:
    """Common prefix of each string with the one before it in order (none for the first)."""
    sizes = np.array([len(x) for x in ordered])
    out = np.zeros(len(ordered), dtype=np.int64)
    for a in range(1, len(ordered), 10_000):
        b = min(a + 10_000, len(ordered))
        width = sizes[a - 1:b].max()
        block = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in ordered[a - 1:b]), np.uint8).reshape(-1, width)
        differ = block[1:] != block[:-1]
        out[a:b] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return np.minimum(out, np.minimum(sizes, np.append(0, sizes[:-1])))


def repeated_strings(contexts: list[bytes], tail: np.ndarray, size: np.ndarray, hits: np.ndarray,
                     length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, string, whether the string occurs twice) of distinct contexts with so many hits each."""
    tails = [c[:t] for c, t in zip(contexts, tail)]
    parses = [c[t:] for c, t in zip(contexts, tail)]
    dictionary = sorted(set(tails))
    ordered = sorted(set(parses))
    tail_of = {t: i for i, t in enumerate(dictionary)}
    parse_of = {p: i for i, p in enumerate(ordered)}
    rank, start = suffix_ranks(dictionary)
    common = common_prefixes(ordered)
    owner = np.repeat(np.arange(len(contexts)), size)
    string = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    before = tail[owner] - string  # bytes of the string before the trigger
    word = np.array([tail_of[t] for t in tails])[owner]
    in_tail = rank[start[word] + string]
    parse = np.array([parse_of[p] for p in parses])[owner]
    in_parse = np.zeros(len(owner), dtype=np.int64)
    for b in np.unique(before):  # parse suffixes that agree on what is left of the string
        mine = before == b
        in_parse[mine] = np.cumsum(common < length - b)[parse[mine]]
    order = np.lexsort((in_parse, in_tail))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(in_tail[order]) != 0) | (np.diff(in_parse[order]) != 0)
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=hits[owner[order]])
    twice = np.zeros(len(order), dtype=bool)
    twice[order] = total[group] > 1
    return owner, string, twice


def _runs(owner: np.ndarray, string: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, size) of the runs of consecutive strings."""
    if not len(owner):
        return owner, string, string
    cuts = np.flatnonzero(np.append(True, (np.diff(owner) != 0) | (np.diff(string) != 1)))
    return owner[cuts], string[cuts], np.diff(np.append(cuts, len(owner)))


CONTEXTS = "key long, context long, tail int, size int, hits long, bytes binary, hot boolean"
RUNS = {"key": I64, "context": I64, "start": I32, "strings": I32}


def contexts_of(rows: DataFrame, open_: DataFrame, length: int) -> DataFrame:
    """The distinct contexts of ``open_`` occurrences with their bytes, combined per task; stored."""
    lists = open_.groupBy("id", "text_key").agg(F.collect_set(F.struct("key", "context", "at", "hot")).alias("at"))
    joined = rows.join(lists, ["id", "text_key"]).select("text", "at")

    def flushed(found):
        key, context, tail, size, hits, data, hot = zip(*((*k, *v) for k, v in found.items()))
        return pa.RecordBatch.from_arrays(
            [pa.array(key, I64), pa.array(context, I64), pa.array(tail, I32), pa.array(size, I32),
             pa.array(hits, I64), pa.array(data, pa.binary()), pa.array(hot, pa.bool_())],
            ["key", "context", "tail", "size", "hits", "bytes", "hot"])

    def run(batches):
        found: dict[tuple[int, int], list] = {}
        for batch in batches:
            for text, items in zip(_bytes(batch.column("text")), batch.column("at")):
                fields = items.values
                for key, context, at, hot in zip(*(fields.field(k).to_pylist() for k in range(4))):
                    seen = found.get((key, context))
                    if seen is None:
                        first, tail, size = at >> 16, at >> 8 & 255, at & 255
                        found[key, context] = [tail, size, 1, text[first:first + size - 1 + length], hot]
                    else:
                        seen[2] += 1
                if len(found) >= FLUSH // 8:
                    yield flushed(found)
                    found = {}
        if found:
            yield flushed(found)

    return stored(joined.mapInArrow(run, CONTEXTS), "suffix-contexts")


def resolved(contexts: DataFrame, tasks: int, length: int) -> DataFrame:
    """``key, context, start, strings``: runs of repeated strings, contexts of a hash in one task."""

    def run(batches):
        merged: dict[tuple[int, int], list] = {}
        for batch in batches:
            for key, context, tail, size, hits, data in zip(*(batch.column(k).to_pylist() for k in range(6))):
                seen = merged.setdefault((key, context), [tail, size, 0, data])
                seen[2] += hits
        if not merged:
            return
        tail, size, hits, data = zip(*merged.values())
        keys = np.array(list(merged), dtype=np.int64)
        owner, string, twice = repeated_strings(list(data), np.array(tail), np.array(size), np.array(hits), length)
        owner, start, strings = _runs(owner[twice], string[twice])
        yield _batch(RUNS, keys[owner, 0], keys[owner, 1], start, strings)

    return contexts.repartition(tasks, "key").mapInArrow(run, "key long, context long, start int, strings int")


def resolved_by_hash(contexts: DataFrame, length: int) -> DataFrame:
    """The same for contexts of hot hashes: their strings grouped by 128 bits, with partial sums."""
    schema = {"h1": I64, "h2": I64, "key": I64, "context": I64, "string": I32, "hits": I64}

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            data = _bytes(batch.column("bytes"))
            sizes = batch.column("size").to_numpy().astype(np.int64)
            raw = np.frombuffer(b"".join(data), np.uint8)
            begin = np.cumsum([0, *map(len, data[:-1])])
            owner = np.repeat(np.arange(len(data)), sizes)
            string = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = begin[owner] + string
            h1, h2 = (Rolling(raw, b).of(at, at + length) for b in BASES)
            of = lambda c: batch.column(c).to_numpy()[owner]
            yield _batch(schema, h1, h2, of("key"), of("context"), string, of("hits"))

    strings = stored(contexts.mapInArrow(run, "h1 long, h2 long, key long, context long, string int, hits long"),
                     "suffix-strings")
    twice = strings.groupBy("h1", "h2").agg(F.sum("hits").alias("n")).filter("n > 1").drop("n")
    held = (salted_lookup(strings, twice, ["h1", "h2"], "context").groupBy("key", "context")
            .agg(F.array_sort(F.collect_set("string")).alias("found")))  # at most ``span`` of them
    edge = lambda step: F.filter("found", lambda x: ~F.array_contains("found", x + step))
    runs = F.transform(F.arrays_zip(edge(-1).alias("first"), edge(1).alias("last")), lambda r: F.struct(
        r["first"].alias("start"), (r["last"] - r["first"] + 1).alias("strings")))
    return held.select("key", "context", F.explode(runs).alias("run")).select("key", "context", "run.*")


# --- removal -----------------------------------------------------------------------------

def repeats(rows: DataFrame, length: int, span: int, hot: int) -> DataFrame:
    """``id, text_key, marks``: runs of repeated strings of every document that has any."""
    spark = rows.sparkSession
    keys = counted(rows, length, span)
    found = stored(salted_lookup(occurrences(rows, length, span), keys, ["key"], "at", salts=4)
                   .withColumn("hot", F.col("hits") > hot), "suffix-occurrences")
    sure = found.filter("same").select(
        "id", "text_key", F.shiftright("at", 16).alias("start"), F.col("at").bitwiseAND(255).alias("strings"))
    open_ = found.filter("not same")
    contexts = contexts_of(rows, open_, length)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-contexts.count() // TASK_CONTEXTS))
    runs = stored(resolved(contexts.filter("not hot"), tasks, length)
                  .unionByName(resolved_by_hash(contexts.filter("hot"), length)), "suffix-runs")
    # One row per context, with the runs inside it: at most ``span`` of them.
    runs = runs.groupBy("key", "context").agg(F.collect_list(F.struct("start", "strings")).alias("runs"))
    placed = (salted_lookup(open_.select("id", "text_key", "key", "context", "at"), runs, ["key", "context"], "at")
              .select("id", "text_key", F.shiftright("at", 16).alias("first"), F.explode("runs").alias("run"))
              .select("id", "text_key", (F.col("first") + F.col("run.start")).alias("start"),
                      F.col("run.strings").cast("long").alias("strings")))
    return (sure.unionByName(placed).groupBy("id", "text_key")
            .agg(F.collect_set(F.struct("start", "strings")).alias("marks")))


RESULT = {"n_bytes": I64, "n_removed": I64, "n_spans": I64, "kept_sha256": pa.string()}


def _cut(text: bytes, start: np.ndarray, strings: np.ndarray, length: int) -> tuple[bytes, int]:
    """(what is left, number of removed runs)."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], (start + strings - 1 + length)[order]
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    begin, stop = start[new], reach[np.append(new[1:], len(start)) - 1]
    kept = [text[a:b] for a, b in zip([0, *stop.tolist()], [*begin.tolist(), len(text)])]
    return b"".join(kept), len(new)


def deduplicated(docs: DataFrame, text: str = "text", id_col: str = "doc_id", length: int = LENGTH,
                 span: int = SPAN, hot: int = HOT, with_kept: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row; ``with_kept`` adds the bytes left."""
    if not GRAM <= span < min(length, 256):
        raise ValueError("span must lie between the rolling hash and the length of a string, and under 256")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    long = rows.filter(F.octet_length("text") >= length).select(
        "doc_id", F.xxhash64("doc_id").alias("id"), F.xxhash64("text").alias("text_key"), "text")
    marks = repeats(long.drop("doc_id"), length, span, hot)
    # Short texts, null ones among them, have no strings and skip the shuffle.
    short = rows.filter(F.octet_length("text") < length).withColumn(
        "marks", F.lit(None).cast(marks.schema["marks"].dataType))
    joined = long.join(marks, ["id", "text_key"], "left").select("doc_id", "text", "marks").unionByName(short)
    schema = RESULT | ({"kept": pa.binary()} if with_kept else {})

    def run(batches):
        for batch in batches:
            out = []
            for data, found in zip(_bytes(batch.column("text")), batch.column("marks")):
                kept, spans = data, 0
                if found.is_valid:
                    start, strings = (found.values.field(k).to_numpy() for k in range(2))
                    kept, spans = _cut(data, start, strings, length)
                out.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(),
                            *([kept] if with_kept else [])))
            columns = list(zip(*out)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, schema.values())]],
                ["doc_id", *schema])

    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                                  + (", kept binary" if with_kept else ""))
