"""Mixing sources to target weights by temperature (DataFrame functions only).

Source token shares p are raised to an exponent a and normalised: w = p**a / Z. The
exponent is found by bisection, towards a target entropy (the largest a whose
weights have at least that entropy: below 1 it flattens the shares, above 1 it sharpens
them) or a repetition limit (the a next to it at which no source is read more often);
if both are given, the limit wins. Entropy falls with a towards that of the sources that
tie for the largest; a target that it never falls below keeps the natural shares. The weights are
realised in whole: each source is cut into blocks of documents, every epoch is a new
permutation of its blocks, and a source gives blocks until its share of the token
budget is spent. The last block of a source is cut at a document.

Defined cases: a null source is a source of its own; a document costs its words and
one more token, so blank and null texts take part; repeated rows are documents of
their own; an empty table gives no rows; other columns are passed through by
``mixed`` and ignored by ``schedule``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexvault.llm.common import by_key, keyed, salted_lookup, stored, text_key, unpack, words_of
from hexvault.session import narrowed

#: Bisection levels, and how many of them one job decides (it sees all their midpoints).
LEVELS, LEVELS_PER_JOB = 24, 4
#: Upper ends of the exponent, tried in turn until the entropy is below its target.
UPPER = [float(1 << k) for k in range(1, 9)]
#: Permuted blocks are summed in so many ranges first, so no window holds a whole source.
RANGES = 1024


def measured(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> DataFrame:
    """``row, id, source, identity, tokens``, stored, without the text."""
    return stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(source).alias("source"),
        text_key(text).alias("identity"), (F.size(words_of(F.col(text))) + 1).cast("long").alias("tokens")),
        "mixing")


def source_sizes(rows: DataFrame) -> DataFrame:
    return stored(narrowed(rows.groupBy("source").agg(F.sum("tokens").alias("size"),
                                                      F.count("*").alias("documents"))), "mixing-sources")


def _moments(sizes: DataFrame, total: float, exponents: list[float]) -> list[tuple[float, float]]:
    """(sum of p**a, sum of p**a * ln p) for each exponent a, in one aggregate."""
    p = F.col("size") / F.lit(total)
    row = sizes.agg(*[e for a in exponents for e in (
        F.sum(F.pow(p, F.lit(a))), F.sum(F.pow(p, F.lit(a)) * F.log(p)))]).first()
    return [(row[2 * k], row[2 * k + 1]) for k in range(len(exponents))]


def _bisect(sizes: DataFrame, total: float, low_side, lo: float = 0.0, hi: float = 1.0) -> tuple[float, float]:
    """The interval of exponents at whose lower end ``low_side(a, Z, S)`` holds, 2**-LEVELS of the whole."""
    for _ in range(LEVELS // LEVELS_PER_JOB):
        steps = 1 << LEVELS_PER_JOB
        grid = [lo + (hi - lo) * k / steps for k in range(1, steps)]
        holds = [low_side(a, z, s) for a, (z, s) in zip(grid, _moments(sizes, total, grid))]
        left, right = 0, steps
        while right - left > 1:
            middle = (left + right) // 2
            left, right = (middle, right) if holds[middle - 1] else (left, middle)
        lo, hi = lo + (hi - lo) * left / steps, lo + (hi - lo) * right / steps
    return lo, hi


def solve(sizes: DataFrame, entropy_share: float | None = None, max_repeats: float | None = None,
          budget: int | str = "cover") -> tuple[float, float, float]:
    """(exponent, Z, token budget) for the sources.

    ``entropy_share`` is the target entropy as a share of the largest possible one.
    ``budget`` is a number of tokens, "corpus" (as many as there are) or "cover" (the
    smallest at which every source is read at least once).
    """
    whole = sizes.agg(F.sum("size"), F.count("*"), F.min("size"), F.max("size")).first()
    if not whole[1]:
        return 1.0, 1.0, 0.0
    total, n, least, most = (float(x) for x in whole)
    p_min, p_max = least / total, most / total
    natural, flat = _moments(sizes, total, [1.0, 0.0])

    def tokens(a, z):
        if budget == "cover":
            return most * z / p_max ** a
        return total if budget == "corpus" else float(budget)

    def entropy(a, z, s):
        return math.log(z) - a * s / z

    def repeats(a, z):
        """Readings of the source read most often: the smallest if flattened, the largest if sharpened."""
        return tokens(a, z) / z * max(p_min ** a / least, p_max ** a / most)

    exponent = 1.0
    if entropy_share is not None and n > 1:
        target = entropy_share * math.log(n)
        enough = lambda a, z, s: entropy(a, z, s) >= target
        if not enough(1.0, *natural):
            exponent = _bisect(sizes, total, enough)[0]
        else:  # all upper ends in one job
            above = [a for a, m in zip(UPPER, _moments(sizes, total, UPPER)) if not enough(a, *m)]
            if above:
                exponent = _bisect(sizes, total, enough, max(1.0, above[0] / 2), above[0])[0]
    elif max_repeats is not None:
        exponent = 0.0
    if max_repeats is not None:
        z = _moments(sizes, total, [exponent])[0][0]
        if exponent > 1 and repeats(exponent, z) > max_repeats and repeats(1.0, natural[0]) <= max_repeats:
            exponent = _bisect(sizes, total, lambda a, z, s: repeats(a, z) <= max_repeats, 1.0, exponent)[0]
        elif repeats(exponent, z) > max_repeats and repeats(1.0, natural[0]) <= max_repeats:
            exponent = max(exponent, _bisect(
                sizes, total, lambda a, z, s: repeats(a, z) > max_repeats)[1])
        elif repeats(exponent, z) > max_repeats:
            exponent = 1.0  # the budget itself is above the limit: stay at the natural shares
    z = _moments(sizes, total, [exponent])[0][0]
    return exponent, z, tokens(exponent, z)


def schedule(rows: DataFrame, entropy_share: float | None = None, max_repeats: float | None = None,
             budget: int | str = "cover", block_tokens: int = 1 << 17, seed: int = 42) -> DataFrame:
    """``row, source, tokens, epoch, block, position, weight, exponent``, one row per reading.

    ``position`` (0 up to 1) is the share of the source's quota spent before the
    document; ordering by it interleaves the sources at their weights.
    """
    sizes = source_sizes(rows)
    exponent, z, tokens = solve(sizes, entropy_share, max_repeats, budget)
    total = sizes.agg(F.sum("size")).first()[0] or 1
    weight = F.pow(F.col("size") / F.lit(float(total)), F.lit(exponent)) / F.lit(z)
    plan = (sizes.withColumn("weight", weight)
            .withColumn("quota", F.round(F.col("weight") * F.lit(tokens)).cast("long"))
            .withColumn("blocks", F.ceil(F.col("size") / F.lit(block_tokens)).cast("long"))
            .withColumn("last", F.floor((F.col("quota") - 1) / F.col("size")).cast("int"))
            .select("source", "size", "weight", "quota", "blocks", "last"))
    blocked = (salted_lookup(rows.select("row", "id", "source", "tokens"), plan, ["source"], "row")
               .withColumn("mix", F.xxhash64(F.lit(seed), "id", "row"))
               .withColumn("block", F.pmod("mix", "blocks")))
    # Blocks in the permuted order of each epoch, with the tokens before each.
    block = (blocked.groupBy("source", "block").agg(F.sum("tokens").alias("block_size"),
                                                    *[F.first(c).alias(c) for c in ("size", "quota", "last")])
             .filter(F.col("quota") > 0)
             .withColumn("epoch", F.explode(F.sequence(F.lit(0), "last")))
             .withColumn("order", F.xxhash64(F.lit(seed), "source", "block", "epoch"))
             .withColumn("range", F.shiftright("order", 64 - int(math.log2(RANGES)))))
    ranges = block.groupBy("source", "epoch", "range").agg(F.sum("block_size").alias("range_size"))
    before_range = ranges.select("source", "epoch", "range", F.coalesce(F.sum("range_size").over(
        Window.partitionBy("source", "epoch").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before_range")).withColumnsRenamed({"source": "rs", "epoch": "re", "range": "rr"})
    inside = Window.partitionBy("source", "epoch", "range").orderBy("order", "block").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = (block.join(before_range, F.col("source").eqNullSafe(F.col("rs")) & (F.col("epoch") == F.col("re"))
                         & (F.col("range") == F.col("rr")))
              .withColumn("before", F.col("epoch") * F.col("size") + F.col("before_range")
                          + F.coalesce(F.sum("block_size").over(inside), F.lit(0)))
              .filter(F.col("before") < F.col("quota"))
              .select(F.col("source").alias("bs"), F.col("block").alias("bb"), "epoch", "before", "block_size"))
    taken = blocked.join(placed, F.col("source").eqNullSafe(F.col("bs")) & (F.col("block") == F.col("bb")))
    documents = Window.partitionBy("source", "epoch", "block").orderBy("mix", "row").rowsBetween(
        Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum("tokens").over(documents), F.lit(0))
    return (taken.withColumn("at", at).filter(F.col("at") < F.col("quota"))
            .select("row", "id", "source", "tokens", "epoch", "block",
                    (F.col("at") / F.col("quota")).alias("position"), "weight",
                    F.lit(exponent).alias("exponent")))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The readings of all documents: ``doc_id, source, n_tokens, epoch, block, position, weight, exponent``."""
    return schedule(measured(docs), **options).select(
        F.col("id").alias("doc_id"), "source", F.col("tokens").alias("n_tokens"), "epoch", "block",
        "position", "weight", "exponent")


def mixed(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id",
          **options) -> DataFrame:
    """The documents themselves, once per reading, in the columns of ``docs``.

    Rows equal in id, source and text are scheduled together, as one document of their
    joint size, so that the text needs no row number: it is shuffled once, to its readings.
    """
    rows = measured(docs, text, source, id_col)
    together = rows.groupBy("id", "source", "identity").agg(F.min("row").alias("row"), F.sum("tokens").alias("tokens"))
    together = stored(narrowed(together), "mixing-keys")
    readings = (schedule(together, **options).select("row", "epoch")
                .join(together, "row").groupBy("id", "source", "identity").agg(F.count("*").alias("times"))
                .select(F.col("id").alias("k0"), F.col("source").alias("k1"), F.col("identity").alias("k2"), "times"))
    found = by_key(keyed(docs, id_col, source, text), readings, 3)
    return unpack(found.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))), docs.columns)
