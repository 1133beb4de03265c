"""Maximal marginal relevance: re-rank bounded candidate lists by score and novelty."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexvault.operators.features import top_k_per_key

#: Weight of the score against the likeness to what stands above.
MMR_LAMBDA = 0.7
MMR_LIST = 50


def unit_rows(vectors: list, width: int) -> np.ndarray:
    """One unit row per vector; null, zero, non-finite and other-sized ones give a row of zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        if v is not None and len(v) == width and None not in v:
            row = np.asarray(v, dtype=np.float64)
            top = np.abs(row).max(initial=0.0)
            if np.isfinite(top) and top > 0:
                row = row / top
                out[i] = row / np.linalg.norm(row)
    return out


def mmr_order(scores: np.ndarray, units: np.ndarray, weight: float) -> list[int]:
    """Indexes in picked order: each time the largest ``weight * score - (1 - weight) * nearest picked``.

    ``scores`` stand in falling order; ties go to the earlier one.
    """
    like = units @ units.T
    near = np.zeros(len(scores))
    left = np.ones(len(scores), dtype=bool)
    picked: list[int] = []
    for _ in range(len(scores)):
        worth = np.where(left, weight * scores - (1 - weight) * near, -np.inf)
        best = int(np.argmax(worth))
        near = like[best].copy() if not picked else np.maximum(near, like[best])
        left[best] = False
        picked.append(best)
    return picked


def mmr(candidates: DataFrame, vectors: DataFrame, key: str = "user_id", item: str = "item_id",
        score: str = "score", vector: str = "embedding", limit: int = MMR_LIST,
        weight: float = MMR_LAMBDA) -> DataFrame:
    """``key, item, score, rank, position``: each key's ``limit`` best candidates in order of marginal relevance.

    The list is the ``limit`` highest scores (ties: smaller item), chosen by salted
    two-level ranking, so a key never sends more than that to a task whatever it holds.
    Scores count as shares of the list's largest size; likeness is the cosine. ``vectors``
    has one row per item; an item without a valid vector is like nothing. Rows without key,
    item or score take no part.
    """
    rows = candidates.filter(F.col(key).isNotNull() & F.col(item).isNotNull() & F.col(score).isNotNull()
                             & ~F.isnan(F.col(score).cast("double")))
    best = top_k_per_key(rows.select(key, item, score), key, [F.desc(score), F.asc(item)], limit)
    known = best.join(vectors.select(item, F.col(vector).cast("array<double>").alias("_vector")), item, "left")
    # A list is the rows of a key in turn; a task holds one batch of rows, whatever the lists hold.
    rows = known.select(key, item, F.col(score).cast("double").alias(score), "rank", "_vector")
    lists = rows.repartition(key).sortWithinPartitions(key, "rank", item, score, "_vector")
    schema = T.StructType([rows.schema[key], rows.schema[item], T.StructField(score, T.DoubleType()),
                           T.StructField("rank", T.IntegerType()), T.StructField("position", T.IntegerType())])

    def placed(table: pa.Table, starts: list[int]) -> pa.Table:
        order: list[int] = []
        scores = table.column(score).to_numpy()
        for begin, end in zip(starts, starts[1:]):
            found = table.column("_vector").slice(begin, end - begin).to_pylist()
            widths = [len(v) for v in found if v]
            units = unit_rows(found, widths[0] if widths else 1)
            top = np.abs(scores[begin:end]).max(initial=0.0)
            share = scores[begin:end] / top if top > 0 else scores[begin:end]
            order += [begin + i for i in mmr_order(share, units, weight)]
        places = [i + 1 for begin, end in zip(starts, starts[1:]) for i in range(end - begin)]
        return table.drop_columns("_vector").take(pa.array(order, pa.int64())).append_column(
            "position", pa.array(places, pa.int32()))

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            keys = held.column(key).to_pylist()
            starts = [i for i, k in enumerate(keys) if i == 0 or k != keys[i - 1]]
            if len(starts) > 1:  # the last list may go on in the next batch
                yield from placed(held, starts).to_batches()
                held = held.slice(starts[-1])
        if held is not None and held.num_rows:
            yield from placed(held, [0, held.num_rows]).to_batches()

    return lists.mapInArrow(run, schema).select(key, item, score, "rank", "position")
