"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are made per document in Arrow batches. Linking works on distinct
fingerprints only, so copies cost nothing. The 64 bits are grouped into parts by
correlation, measured over all fingerprints. If two fingerprints differ in at most
``max_bits`` bits, then for any thresholds that add up to ``max_bits - parts + 1``
some part differs in at most its threshold (a threshold of -1 skips the part). Each
fingerprint takes the thresholds with the least estimated cost, found by dynamic
programming over estimated candidate counts: a part whose value is very common is
skipped, and rarer parts are probed with a wider radius instead. Probes meet the
indexed fingerprints in buckets; every pair of a bucket is verified and only the
links of a spanning forest leave it. A bucket above ``block`` fingerprints is cut
into blocks, and each pair of blocks is a task of its own.

Defined cases: a null or blank text has fingerprint zero and is linked like any
other; rows with a null id take part in links but never name a component, whose id
is null if all its ids are; repeated rows give one output row each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexvault.llm.common import by_key, keyed, salted_lookup, stored, text_key, unpack
from hexvault.llm.components import connected_components
from hexvault.session import narrowed

BITS = 64
SEED = 42
#: Values of a part at or above this share of all fingerprints are counted exactly
#: (at most this many a part), all others by the independence estimate.
HEAVY_SHARE = 1 / 1024
#: Cost of one probe row and of one verified candidate, in the same unit.
PROBE_COST, VERIFY_COST = 8.0, 1.0
BLOCK = 2048
#: Value counts are kept for pieces of at most this many bits of a part.
PIECE_BITS = 11


def fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit SimHash of one text: majority bits over the hashes of its shingles."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str, carry: list[Column], shingle: int) -> DataFrame:
    """``carry`` columns and ``fp`` (long) for every row."""
    rows = docs.select(*carry, F.col(text).alias("_text"))
    keep = [f for f in rows.schema.fields if f.name != "_text"]
    schema = rows.select(*[f.name for f in keep], F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column("_text").to_pylist()]
            cols = [batch.column(f.name) for f in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fps, pa.int64())],
                                             [f.name for f in keep] + ["fp"])

    return rows.mapInArrow(run, schema)


# --- parts and thresholds ----------------------------------------------------------------

def _bit_rows(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_correlation(fps: DataFrame) -> np.ndarray:
    """64 x 64 absolute correlations of the bits over all fingerprints (a fixed-size result)."""

    def run(batches):
        total = np.zeros((BITS, BITS))
        rows = 0
        for batch in batches:
            bits = _bit_rows(batch.column("fp").to_numpy()).astype(np.float64)
            total += bits.T @ bits
            rows += len(bits)
        if rows:
            yield pa.RecordBatch.from_pydict({"i": np.arange(BITS + 1),
                                              "sums": [*total.tolist(), [float(rows)] * BITS]})

    sums = fps.select("fp").mapInArrow(run, "i long, sums array<double>")
    added = sums.groupBy("i").agg(F.array(*[F.sum(F.col("sums")[k]) for k in range(BITS)]).alias("s"))
    table = {r["i"]: r["s"] for r in added.collect()}  # 65 rows
    if not table:
        return np.zeros((BITS, BITS))
    n = table[BITS][0]
    both = np.array([table[i] for i in range(BITS)]) / n
    mean = np.diag(both)
    spread = np.sqrt(np.clip(mean * (1 - mean), 1e-12, None))
    return np.abs((both - np.outer(mean, mean)) / np.outer(spread, spread))


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of near-equal size, each grown by the strongest correlation."""
    left, groups = list(range(BITS)), []
    sizes = [len(x) for x in np.array_split(np.arange(BITS), parts)]
    for size in sizes:
        c = correlation[np.ix_(left, left)].copy()
        np.fill_diagonal(c, -1)
        seed = left[int(np.argmax(c.max(axis=1)))]
        group = [seed]
        rest = [b for b in left if b != seed]
        while len(group) < size:
            best = max(rest, key=lambda b: (correlation[b, group].mean(), -b))
            group.append(best)
            rest.remove(best)
        groups.append(sorted(group))
        left = rest
    return groups


def part_values(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    u = fps.astype(np.int64).view(np.uint64)
    out = np.zeros(len(u), dtype=np.int64)
    for k, b in enumerate(bits):
        out |= ((u >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def _pieces(width: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the near-equal pieces of a part for which counts are kept."""
    sizes = [len(x) for x in np.array_split(np.arange(width), -(-width // PIECE_BITS))]
    return [(sum(sizes[:i]), n) for i, n in enumerate(sizes)]


class Estimator:
    """Estimated number of fingerprints within a distance of a part's value."""

    def __init__(self, groups, rows: int, counts: dict, heavy: dict, radius: int):
        self.groups, self.rows, self.radius, self.heavy = groups, rows, radius, heavy
        self.near = {}  # (part, piece) -> share of fingerprints [value, exact distance]
        for key, hist in counts.items():
            v = np.arange(len(hist))
            dist = np.bitwise_count((v[:, None] ^ v[None, :]).astype(np.uint64))
            self.near[key] = np.stack([(dist == a) @ hist for a in range(radius + 1)], axis=1) / max(rows, 1)

    def within(self, part: int, values: np.ndarray) -> np.ndarray:
        """Estimates[t, row] for the distances t = 0 .. radius (pieces taken as independent)."""
        exact = np.zeros((self.radius + 1, len(values)))
        exact[0] = self.rows
        for k, (first, bits) in enumerate(_pieces(len(self.groups[part]))):
            share = self.near[part, k][(values >> first) & ((1 << bits) - 1)]
            exact = np.stack([sum(exact[a] * share[:, t - a] for a in range(t + 1))
                              for t in range(self.radius + 1)])
        known = np.zeros_like(exact)
        for v, n in self.heavy.get(part, []):
            d = np.bitwise_count((values ^ v).astype(np.uint64))
            for t in range(self.radius + 1):
                known[t] += np.where(d == t, n, 0)
        return np.maximum(np.cumsum(exact, axis=0), np.cumsum(known, axis=0))


def allocate(cost: np.ndarray, total: int) -> np.ndarray:
    """Thresholds[part, row] from -1 up with sum ``total`` and the least cost.

    ``cost[part, t + 1, row]`` is the cost of threshold t. Dynamic programming over
    the parts; ties go to the smaller threshold of the later part.
    """
    parts, choices, n = cost.shape
    best = {0: np.zeros(n)}
    picks: list[dict[int, np.ndarray]] = []
    for p in range(parts):
        new: dict[int, np.ndarray] = {}
        pick: dict[int, np.ndarray] = {}
        for s, c in best.items():
            for t in range(-1, choices - 1):
                value = c + cost[p, t + 1]
                if s + t not in new:
                    new[s + t], pick[s + t] = value.copy(), np.full(n, t)
                else:
                    better = value < new[s + t]
                    new[s + t][better] = value[better]
                    pick[s + t][better] = t
        best, picks = new, [*picks, pick]
    out = np.zeros((parts, n), dtype=np.int64)
    state = np.full(n, total)
    for p in reversed(range(parts)):
        for s, chosen in picks[p].items():
            at = state == s
            out[p, at] = chosen[at]
        state = state - out[p]
    return out


def _neighbour_masks(width: int, radius: int) -> list[np.ndarray]:
    """XOR masks of each distance 1 .. radius inside a part."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(width), d)], dtype=np.int64)
            for d in range(1, radius + 1)]


def _statistics(fps: DataFrame, groups: list[list[int]]) -> tuple[int, dict, dict]:
    """Row count, value counts of each piece of a part (fixed size) and the heavy part values."""
    pieces = {(p, k): piece for p, g in enumerate(groups) for k, piece in enumerate(_pieces(len(g)))}

    def run(batches):
        hists = {key: np.zeros(1 << bits, dtype=np.int64) for key, (_, bits) in pieces.items()}
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            for p, g in enumerate(groups):
                v = part_values(fp, g)
                for k, (first, bits) in enumerate(_pieces(len(g))):
                    hists[p, k] += np.bincount((v >> first) & ((1 << bits) - 1), minlength=1 << bits)
        for (p, k), h in hists.items():
            at = np.flatnonzero(h)
            yield pa.RecordBatch.from_pydict({"p": np.full(len(at), p), "s": np.full(len(at), k),
                                              "v": at, "n": h[at]})

    counts = {key: np.zeros(1 << bits) for key, (_, bits) in pieces.items()}
    counted = fps.select("fp").mapInArrow(run, "p long, s long, v long, n long").groupBy("p", "s", "v").agg(
        F.sum("n").alias("n"))
    for r in counted.collect():  # at most pieces * 2 ** PIECE_BITS rows
        counts[r["p"], r["s"]][r["v"]] = r["n"]
    rows = int(counts[0, 0].sum())

    def values(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            for p, g in enumerate(groups):
                v, n = np.unique(part_values(fp, g), return_counts=True)
                yield pa.RecordBatch.from_pydict({"p": np.full(len(v), p), "v": v, "n": n})

    heavy: dict[int, list] = {}
    common = (fps.select("fp").mapInArrow(values, "p long, v long, n long").groupBy("p", "v")
              .agg(F.sum("n").alias("n")).filter(F.col("n") >= max(2.0, rows * HEAVY_SHARE)))
    if rows >= 1 / HEAVY_SHARE:  # below that every value is heavy and the estimate is good enough
        for r in common.collect():  # at most 1 / HEAVY_SHARE rows a part
            heavy.setdefault(r["p"], []).append((r["v"], r["n"]))
    return rows, counts, heavy


# --- probing -----------------------------------------------------------------------------

def _bucket_rows(fps: DataFrame, groups: list[list[int]], est: Estimator, max_bits: int) -> DataFrame:
    """``p, v, fp, probing``: every fingerprint at its own values, and its probes beside them."""
    total = max_bits - len(groups) + 1

    def run(batches):
        masks = [_neighbour_masks(len(g), max(max_bits, 0)) for g in groups]
        for batch in batches:
            every = batch.column("fp").to_numpy()
            for at in range(0, len(every), 4096):
                fp = every[at:at + 4096]
                n = len(fp)
                cost = np.zeros((len(groups), max_bits + 2, n))
                vals = [part_values(fp, g) for g in groups]
                for p in range(len(groups)):
                    probes = np.cumsum([1] + [len(m) for m in masks[p]])
                    cost[p, 1:] = est.within(p, vals[p]) * VERIFY_COST + probes[:, None] * PROBE_COST
                radius = allocate(cost, total)
                for p in range(len(groups)):
                    yield _rows(p, vals[p], fp, radius[p] >= 0)
                    for d, mask in enumerate(masks[p], start=1):
                        who = np.flatnonzero(radius[p] >= d)
                        if len(who):
                            v = (vals[p][who, None] ^ mask[None, :]).ravel()
                            yield _rows(p, v, np.repeat(fp[who], len(mask)), np.ones(len(v), dtype=bool))

    def _rows(p, v, fp, probing):
        return pa.RecordBatch.from_pydict({"p": np.full(len(v), p, dtype=np.int32), "v": v, "fp": fp,
                                           "probing": probing})

    return fps.select("fp").mapInArrow(run, "p int, v long, fp long, probing boolean")


def _links(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints, as (member, smallest member)."""
    if len(values) <= 8:
        ints = values.tolist()
        root = list(range(len(ints)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for i, j in combinations(range(len(ints)), 2):
            if ((ints[i] ^ ints[j]) & 0xFFFFFFFFFFFFFFFF).bit_count() <= max_bits:
                a, b = find(i), find(j)
                if a != b:
                    root[max(a, b)] = min(a, b)
        members: dict[int, list[int]] = {}
        for i in range(len(ints)):
            members.setdefault(find(i), []).append(ints[i])
        return [(x, min(m)) for m in members.values() if len(m) > 1 for x in m if x != min(m)]
    out, left = [], values.view(np.uint64)
    while len(left):  # one connected piece at a time; every member is compared with the rest once
        piece, frontier, left = [left[:1]], left[:1], left[1:]
        while len(frontier) and len(left):
            hit = np.zeros(len(left), dtype=bool)
            for at in range(0, len(frontier), 256):
                near = np.bitwise_count(frontier[at:at + 256, None] ^ left[None, :]) <= max_bits
                hit |= near.any(axis=0)
            frontier, left = left[hit], left[~hit]
            piece.append(frontier)
        found = np.concatenate(piece).view(np.int64)
        if len(found) > 1:
            first = int(found.min())
            out += [(int(x), first) for x in found if x != first]
    return out


def links(fps: DataFrame, max_bits: int = 3, parts: int = 4, block: int = BLOCK) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that connect every near pair."""
    if not 2 <= parts <= max_bits + 1:
        raise ValueError("parts must lie between 2 and max_bits + 1")
    groups = group_bits(bit_correlation(fps), parts)
    est = Estimator(groups, *_statistics(fps, groups), radius=max_bits)
    rows = _bucket_rows(fps, groups, est, max_bits)
    sizes = (rows.groupBy("p", "v").agg(F.count("*").alias("n"), F.max("probing").alias("probed"))
             .filter((F.col("n") > 1) & F.col("probed")).select("p", "v", "n"))
    # Blocks of a bucket: a fingerprint goes to every pair of blocks that holds its own.
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    placed = (salted_lookup(rows, sizes, ["p", "v"], "fp", salts=4)
              .withColumn("blocks", blocks)
              .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("p", "v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))
    buckets = placed.groupBy("p", "v", "i", "j").agg(F.collect_list("fp").alias("fps"))

    def run(batches):
        for batch in batches:
            pairs = []
            lists = batch.column("fps")
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            for lo, hi in zip(offsets[:-1], offsets[1:]):
                if hi - lo > 1:
                    pairs += _links(flat[lo:hi], max_bits)
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in pairs], pa.int64()),
                                              "b": pa.array([y for _, y in pairs], pa.int64())})

    return buckets.select("fps").mapInArrow(run, "a long, b long").distinct()


def _grouped(marked: DataFrame, max_bits: int, parts: int) -> DataFrame:
    """``fp, root``: the component of every fingerprint of ``marked`` that has a link."""
    distinct = stored(narrowed(marked.select("fp").distinct()), "simhash-fps")
    return connected_components(links(distinct, max_bits, parts))


def components(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3,
               max_bits: int = 3, parts: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row."""
    marked = stored(with_fingerprints(docs, text, [F.monotonically_increasing_id().alias("row"),
                                                   F.col(id_col).alias("id")], shingle), "simhash")
    firsts = marked.groupBy("fp").agg(F.min("id").alias("first"))
    roots = _grouped(marked, max_bits, parts)
    rooted = (firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = salted_lookup(rooted.select("fp", "root"), named, ["root"], "fp").select("fp", "component_id")
    return salted_lookup(marked, by_fp, ["fp"], "row").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3,
                    max_bits: int = 3, parts: int = 4) -> DataFrame:
    """One row of each component, in the columns of ``docs``: the smallest id, then the first row."""
    marked = stored(with_fingerprints(docs, text, [F.monotonically_increasing_id().alias("row"),
                                                   F.col(id_col).alias("id"), text_key(text).alias("identity")],
                                      shingle), "simhash-rows")
    firsts = marked.groupBy("fp").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"), F.col("identity"))).alias("first"))
    roots = _grouped(marked, max_bits, parts)
    chosen = (firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
              .select(F.col("first.id").alias("k0"), F.col("first.identity").alias("k1")))
    # Equal rows share their key: one of them stays.
    found = by_key(keyed(docs, id_col, text), chosen, 2, "left_semi")
    return unpack(found.groupBy("k0", "k1").agg(F.first("doc").alias("doc")), docs.columns)
