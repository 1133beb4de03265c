"""Nearest neighbours by cosine over randomly rotated one-bit codes.

Every unit vector is rotated by one random orthonormal matrix and kept as its sign
bits plus one correction scalar (the inner product of the vector with its own code).
A query's inner product with a vector is estimated from the packed bits and divided
by that scalar; the estimate's error has a known bound for a given confidence. Only
vectors whose upper bound reaches the query's present k-th best exact score are
scored on the original vectors.

All vectors are cut into blocks by hash, the queries too, and each pair of a query
block and a data block is one task of bounded size. Every task returns its best k a
query; the lists are merged by query.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite
components, take no part, neither as queries nor as candidates; finite ones of any size
do; rows that ask with one id but different vectors share one list; only vectors of the
query's length are compared; repeated query rows count once, repeated candidate rows
each take a rank; ties go to the smaller id; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexvault.llm.common import stored

#: Vectors of a data block, queries of a query block, vectors estimated at once.
DATA_BLOCK, QUERY_BLOCK, STEP = 8192, 8192, 1024
#: Width of the error bound in standard deviations, and room for 32-bit rounding.
CONFIDENCE, ROUNDING = 3.0, 1e-5
SEED = 42


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """Random orthonormal matrix, the same in every task."""
    gauss = np.random.default_rng(seed + dim).standard_normal((dim, dim))
    q, r = np.linalg.qr(gauss)
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed sign bits, correction scalar) of each vector."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = unit @ turn
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def scaled(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Vectors times powers of two that bring their largest components between 1/2 and 1.

    Cosines stay the same to the last bit, and no norm or product of very large or very
    small vectors leaves the range of doubles.
    """
    if not len(flat):
        return flat
    exponent = np.frexp(np.maximum.reduceat(np.abs(flat), starts))[1]
    return np.ldexp(flat, -np.repeat(exponent, sizes))


def indexed(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Stored index of all valid vectors, scaled: ``id, dim, vector, code, scale``."""
    v = F.col("vector")
    infinity = F.lit(float("inf"))
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vector"))
            .filter(F.col("id").isNotNull() & (F.size(v) > 0)
                    & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinity)))
            .filter(F.exists(v, lambda x: x != 0)))

    def run(batches):
        for batch in batches:
            offsets = batch.column("vector").offsets.to_numpy()
            starts, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
            flat = scaled(batch.column("vector").values.to_numpy()[offsets[0]:offsets[-1]], starts, sizes)
            lists = pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pa.array(flat))
            codes: list = [None] * len(sizes)
            scales = np.zeros(len(sizes))
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                code, scale = encode(flat[starts[at, None] + np.arange(dim)], rotation(int(dim)))
                scales[at] = scale
                for i, c in zip(at, code):
                    codes[i] = c.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes.astype(np.int32)), lists, pa.array(codes, pa.binary()),
                 pa.array(scales)], ["id", "dim", "vector", "code", "scale"])

    return stored(rows.mapInArrow(run, "id long, dim int, vector array<double>, code binary, scale double"),
                  "ann-index")


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("vector").combine_chunks()
    return flat.flatten().to_numpy().reshape(table.num_rows, -1)


def _scores(queries: np.ndarray, vectors: np.ndarray, qn: np.ndarray, vn: np.ndarray,
            q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact cosines of the pairs (q, v); the same value for equal vectors wherever they stand."""
    out = np.empty(len(q))
    for at in range(0, len(q), 50_000):
        a, b = q[at:at + 50_000], v[at:at + 50_000]
        out[at:at + 50_000] = (queries[a] * vectors[b]).sum(axis=1) / (qn[a] * vn[b])
    return out


def _best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each query: higher score, then smaller id."""
    order = np.lexsort((ids, -score, q))
    first = np.searchsorted(q[order], q[order])
    return order[np.arange(len(order)) - first < k]


def search_block(query_ids, queries, ids, vectors, codes, scales, k: int, confidence: float):
    """(query, id, score) of the k best in one data block, by estimate, bound and exact score."""
    n, dim = queries.shape
    qn, vn = np.linalg.norm(queries, axis=1), np.linalg.norm(vectors, axis=1)
    turned = ((queries / qn[:, None]) @ rotation(dim)).astype(np.float32)
    error = confidence * np.sqrt(np.clip(1 - scales ** 2, 0, None)) / scales / np.sqrt(max(dim - 1, 1)) + ROUNDING
    kept = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
    floor = np.full(n, -np.inf)
    for at in range(0, len(ids), STEP):
        part = slice(at, at + STEP)
        signs = np.unpackbits(codes[part], axis=1, count=dim).astype(np.float32) * 2 - 1
        estimate = (turned @ signs.T) / (np.sqrt(dim) * scales[part]).astype(np.float32)
        estimate = np.where(query_ids[:, None] == ids[part][None, :], np.float32(-np.inf), estimate)
        if at == 0:  # a first floor from the best estimates, so that the bound prunes at once
            m = min(2 * k, estimate.shape[1])
            top = np.argpartition(-estimate, m - 1, axis=1)[:, :m]
            q, v = np.repeat(np.arange(n), m), top.ravel()
            good = np.isfinite(estimate[q, v])
            exact = np.full(len(q), -np.inf)
            exact[good] = _scores(queries, vectors, qn, vn, q[good], v[good])
            ranked = -np.sort(-exact.reshape(n, m), axis=1)
            if m >= k:
                floor = ranked[:, k - 1]
        reach = estimate + error[part][None, :].astype(np.float32) >= (floor - ROUNDING)[:, None]
        q, v = np.nonzero(reach & np.isfinite(estimate))
        exact = _scores(queries, vectors, qn, vn, q, v + at)
        pool = [np.concatenate(x) for x in zip(kept, (q, v + at, exact))]
        best = _best(pool[0], ids[pool[1]], pool[2], k)
        kept = tuple(x[best] for x in pool)
        counts = np.bincount(kept[0], minlength=n)
        worst = np.full(n, np.inf)
        np.minimum.at(worst, kept[0], kept[2])
        floor = np.where(counts >= k, np.maximum(floor, worst), floor)
    return query_ids[kept[0]], ids[kept[1]], kept[2]


def nearest(vectors: DataFrame, query_every: int = 50, k: int = 5, id_col: str = "vec_id",
            column: str = "embedding", confidence: float = CONFIDENCE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of each vector whose id is divisible by ``query_every``."""
    index = indexed(vectors, id_col, column)
    asked = index.filter(F.col("id") % query_every == 0).select("id", "dim", "vector").distinct()
    n, n_asked = index.count(), asked.count()
    data_blocks, query_blocks = max(1, -(-n // DATA_BLOCK)), max(1, -(-n_asked // QUERY_BLOCK))

    def block(salt: int, count: int):
        return F.pmod(F.xxhash64(F.lit(salt), "id", "vector"), F.lit(count)).cast("int")

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = asked.withColumn("qb", block(1, query_blocks)).withColumn("db", every(data_blocks))
    # Equal vectors spread by their ids, so a very common vector fills no block.
    right = index.withColumn("db", F.pmod(F.xxhash64("id"), F.lit(data_blocks)).cast("int")).withColumn(
        "qb", every(query_blocks))

    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        if not queries.num_rows or not data.num_rows:
            found = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        else:
            codes = np.frombuffer(b"".join(data.column("code").to_pylist()), np.uint8)
            found = search_block(queries.column("id").to_numpy(), _matrix(queries), data.column("id").to_numpy(),
                                 _matrix(data), codes.reshape(data.num_rows, -1),
                                 data.column("scale").to_numpy(), k, confidence)
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    lists = left.groupBy("dim", "qb", "db").cogroup(right.groupBy("dim", "qb", "db")).applyInArrow(
        run, "query_id long, vec_id long, score double")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (lists.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
