"""Quality rules with cross-document line frequency (DataFrame functions only).

Each document gets its word statistics (base rules). Its lines are normalised and
hashed, and distinct documents are counted per host and line. Lines that stand in
too many of a host's documents, or in too large a share of them, are boilerplate and
are removed; a document of which too little is left is rejected.

Defined cases: a null text has no words, so it fails the base rules; a null host is a
host of its own; repeated rows count as one document (documents are told apart by
their text) and give one output row each; an empty table gives no rows; other
columns are passed through by ``cleaned`` and ignored by ``verdicts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexvault.llm.common import (
    BLANK_RUN, BLANKS, by_key, keyed, salted_lookup, stored, text_key, with_text, words_of)

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: A line is boilerplate in a host when it stands in more distinct documents than both,
MIN_LINE_DOCUMENTS = 20
MAX_LINE_SHARE = 0.1
#: or in more than so many, however large the host,
MANY_LINE_DOCUMENTS = 100
#: or in more than both of these, however small the host.
MIN_SMALL_DOCUMENTS = 5
MAX_SMALL_SHARE = 0.5
#: A document is depleted when less than this share of its line characters is left.
MIN_LEFT_SHARE = 0.3


def _normalised(line: Column) -> Column:
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(BLANKS)), BLANK_RUN, " "))


def _line_hash(line: Column) -> Column:
    return F.xxhash64(_normalised(line))


def _with_words(df: DataFrame) -> DataFrame:
    """Adds the base statistics of column ``t``; each helper column is computed once.

    Five-word windows are compared by 64-bit hash inside one text. Only texts with an
    equal pair sort their windows; covered words follow from the sorted positions.
    """
    df = df.withColumn("words", words_of(F.col("t")))
    windows = F.transform(
        F.sequence(F.lit(0), F.size("words") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WINDOW)]))
    none = F.array().cast("array<bigint>")
    df = df.withColumn("hashes", F.when(F.size("words") >= WINDOW, windows).otherwise(none))
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    ranked = F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("ranked", F.when(repeats, ranked))
    same = lambda x, i, step: x["h"] == F.get(F.col("ranked"), i + step)["h"]
    twice = F.filter("ranked", lambda x, i: F.coalesce(same(x, i, -1), F.lit(False))
                     | F.coalesce(same(x, i, 1), F.lit(False)))
    starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, x: F.struct((a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n"), x.alias("last")),
        lambda a: a["n"])
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    df = df.withColumn("worded", lines)
    return df.select(
        *[c for c in df.columns if c not in ("words", "hashes", "ranked", "worded", "t")],
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("ranked").isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.transform("worded", lambda x: F.struct(
            _line_hash(x).alias("h"), F.length(_normalised(x)).alias("n"))).alias("lines"))


def profile(docs: DataFrame, text: str = "text", host: str = "source", id_col: str = "doc_id") -> DataFrame:
    """One stored row per input row: base statistics and hashed lines, without the text."""
    base = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(host).alias("host"),
        # Documents are told apart by their text, so an exact copy is no new document.
        text_key(text).alias("identity"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return stored(_with_words(base), "quality-rules")


def boilerplate(profiled: DataFrame) -> DataFrame:
    """``host, h`` of the lines above the limits."""
    n, of = F.col("documents"), F.col("host_documents")
    lines = profiled.select("host", "identity", F.explode(
        F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    counted = (lines.groupBy("host", "h", "identity").agg(F.count("*").alias("_c"))
               .groupBy("host", "h").agg(F.count("*").alias("documents"))
               .filter(n > min(MIN_LINE_DOCUMENTS, MIN_SMALL_DOCUMENTS, MANY_LINE_DOCUMENTS)))
    hosts = (profiled.groupBy("host", "identity").agg(F.count("*").alias("_c"))
             .groupBy("host").agg(F.count("*").alias("host_documents")))
    return (salted_lookup(counted, hosts, ["host"], "h")
            .filter((n > MANY_LINE_DOCUMENTS)
                    | ((n > MIN_LINE_DOCUMENTS) & (n > of * F.lit(MAX_LINE_SHARE)))
                    | ((n > MIN_SMALL_DOCUMENTS) & (n > of * F.lit(MAX_SMALL_SHARE))))
            .select("host", "h"))


def _removals(profiled: DataFrame) -> DataFrame:
    """``row, removed_chars, removed_lines, removed`` for rows that hold boilerplate."""
    lines = (profiled.select("row", "host", F.explode("lines").alias("line"))
             .select("row", "host", F.col("line.h").alias("h"), F.col("line.n").alias("n"))
             .groupBy("row", "host", "h").agg(F.sum("n").alias("n"), F.count("*").alias("times")))
    hit = salted_lookup(lines, boilerplate(profiled).withColumn("_hit", F.lit(True)), ["host", "h"], "row")
    return hit.groupBy("row").agg(F.sum("n").alias("removed_chars"), F.sum("times").alias("removed_lines"),
                                  F.collect_set("h").alias("removed"))


def _judged(profiled: DataFrame) -> DataFrame:
    all_chars = F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    left = all_chars - F.coalesce("removed_chars", F.lit(0))
    return (profiled.join(_removals(profiled), "row", "left")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (left >= F.lit(MIN_LEFT_SHARE) * all_chars)))


def verdicts(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: base statistics, base verdict and final verdict."""
    return _judged(profile(docs, text, host)).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.coalesce("removed_lines", F.lit(0)).cast("long").alias("n_removed_lines"))


def cleaned(docs: DataFrame, text: str = "text", host: str = "source", length: str = "n_chars",
            id_col: str = "doc_id") -> DataFrame:
    """The kept documents with boilerplate lines taken out, in the columns of ``docs``.

    ``length`` (if there is such a column) follows the shortened text. The text is
    shuffled once, to the verdict of its id, host and content.
    """
    verdict = (_judged(profile(docs, text, host, id_col)).filter("kept")
               .groupBy(F.col("id").alias("k0"), F.col("host").alias("k1"), F.col("identity").alias("k2"))
               .agg(F.first("removed").alias("removed")))
    kept = by_key(keyed(docs, id_col, host, text), verdict, 3)
    old = F.col(f"doc.`{text}`")
    short = F.array_join(F.filter(F.split(old, "\n", -1), lambda x: (F.btrim(x, F.lit(BLANKS)) == "")
                                  | ~F.array_contains("removed", _line_hash(x))), "\n")
    return with_text(kept, docs.columns, text, F.when(F.col("removed").isNull(), old).otherwise(short), length)
