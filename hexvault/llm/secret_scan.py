"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Every text is matched against the base rules (assignments, access keys, long hex
runs) and against a generic token rule. The values found are hashed and counted
over the whole corpus by distinct repositories and owners. A value that many owners
or many repositories (if of one owner) hold is a copied example; a value held by one
owner in few repositories that looks random is taken for a live credential. The verdict goes back to each occurrence as an added span.

Defined cases: a null text counts as empty; a null owner or repository is one
owner or repository of its own; repeated rows give one output row each with equal
values; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexvault.llm.common import by_key, keyed, salted_lookup, stored, text_key, with_text
from hexvault.session import narrowed

# The base rules, by kind, in the order in which kinds are listed.
ASSIGN = ("((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?"
          "([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
MIN_ASSIGN_VALUE = 8
#: Generic random-looking tokens, candidates for the ownership count only.
TOKEN = "[A-Za-z0-9+/_-]{20,}"
KINDS = ["assign", "access", "hex", "live", "example"]
#: Values that are written down to be replaced (fixed values).
PLACEHOLDER = "(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|0123456789|abcdefgh"

SPAN = "struct<start:int,ord:int,end:int>"
CANDIDATE = "struct<start:int,end:int,value:string>"


def _blocks(items: Column, size: Column) -> Column:
    """An array as an array of arrays of ``size`` items."""
    n = F.ceil(F.size(items) / size).cast("int")
    return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
                       lambda b: F.slice(items, b * size + 1, size))


def _running(lengths: Column, start: Column) -> Column:
    """Sums before each item and after the last, from ``start`` on. Arrays grow by copying: for few items."""
    return F.aggregate(lengths, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def located(df: DataFrame, text: str, patterns: dict[str, tuple[str, int]]) -> DataFrame:
    """``df`` with, for each name, all leftmost non-overlapping matches of ``(pattern, value group)``.

    Matches are array<struct<start, end, value>>. The text between matches (``split``) and
    the matches themselves interleave, so running lengths give the positions, in code
    points. Running sums are taken in blocks of about the square root of the number of
    matches and over the blocks, so a text of very many matches costs little more than
    its length. ``value`` is the given group.
    """
    t = F.col(text)
    for name, (pattern, group) in patterns.items():
        hit = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        value = hit if not group else F.regexp_extract_all(t, F.lit(pattern), F.lit(group))
        parts = F.arrays_zip(F.slice(F.split(t, pattern, -1), F.lit(1), F.size(hit)).alias("gap"),
                             hit.alias("hit"), value.alias("value"))
        item = lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"),
                                  x["value"].alias("value"))
        df = df.withColumn(f"_{name}", F.when(t.rlike(pattern), F.transform(parts, item)))
    both = lambda x: x["gap"] + x["hit"]
    for name in patterns:  # each helper is a column of its own, so it is computed once
        size = F.ceil(F.sqrt(F.size(f"_{name}"))).cast("int")
        df = df.withColumn(f"_{name}", _blocks(F.col(f"_{name}"), size))
    for name in patterns:
        sums = F.transform(f"_{name}", lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + both(x)))
        df = df.withColumn(f"_{name}_at", _running(sums, F.lit(0)))

    def placed(name):
        def block(items, k):
            ends = F.slice(_running(F.transform(items, both), F.get(F.col(f"_{name}_at"), k)), F.lit(2), F.size(items))
            return F.transform(F.arrays_zip(items.alias("item"), ends.alias("end")), lambda x: F.struct(
                (x["end"] - x["item"]["hit"]).alias("start"), x["end"].alias("end"), x["item"]["value"].alias("value")))
        found = F.flatten(F.transform(f"_{name}", block)).cast(f"array<{CANDIDATE}>")
        return F.coalesce(found, F.array().cast(f"array<{CANDIDATE}>")).alias(name)

    plain = [c for c in df.columns if c not in {f"_{n}" for n in patterns} | {f"_{n}_at" for n in patterns}]
    return df.select(*plain, *[placed(n) for n in patterns])


def _as_spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("ord"), x["end"].alias("end")))


def scan(docs: DataFrame, text: str = "text", owner: str = "source",
         repository: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """Base spans and hashed candidates of every row, one stored row per input row.

    Returns ``row, id, identity, owner, repository, base, candidates`` with
    ``candidates`` as array<struct<start, end, from_rule, looks_live, digest>>; the
    text is not carried on. ``repository`` defaults to owner and language together.
    """
    owned = F.col(owner).cast("string")
    repo = repository if repository is not None else F.concat_ws("/", owner, "lang")
    first = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                        text_key(text).alias("identity"), owned.alias("owner"), repo.alias("repository"),
                        F.coalesce(F.col(text), F.lit("")).alias("t"))
    first = located(first, "t", {"assign": (ASSIGN, 2), "access": (ACCESS, 0), "hex": (HEX, 0),
                                 "token": (TOKEN, 0)}).drop("t")
    first = first.withColumn("assign", F.filter("assign", lambda x: F.length(x["value"]) >= MIN_ASSIGN_VALUE))
    # The value of a match is at its end (for all rules but assignments it is the match).
    value = lambda from_rule: lambda x: F.struct(
        (x["end"] - F.length(x["value"])).cast("int").alias("start"), x["end"].alias("end"),
        x["value"].alias("value"), F.lit(from_rule).alias("from_rule"))
    values = F.concat(F.transform(F.concat("assign", "access", "hex"), value(True)),
                      F.transform("token", value(False)))
    looks_live = lambda v: (v.rlike("[0-9]") & v.rlike("[A-Za-z]") & ~v.rlike(PLACEHOLDER)
                            & (F.size(F.array_distinct(F.split(v, ""))) >= 8))
    candidates = F.array_sort(F.transform(values, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["from_rule"].alias("from_rule"),
        looks_live(x["value"]).alias("looks_live"), F.sha2(x["value"], 256).alias("digest"))))
    # Equal candidates are neighbours once sorted.
    first = first.withColumn("sorted", candidates)
    once = F.filter("sorted", lambda x, i: (i == 0) | (x != F.get(F.col("sorted"), i - 1)))
    base = F.array_sort(F.concat(_as_spans(F.col("assign"), "assign"), _as_spans(F.col("access"), "access"),
                                 _as_spans(F.col("hex"), "hex")))
    return stored(first.select("row", "id", "identity", "owner", "repository", base.alias("base"),
                               once.alias("candidates")), "secret-scan")


def ownership(scanned: DataFrame) -> DataFrame:
    """``digest, owners, repositories``: distinct holders of each candidate value.

    Repetitions inside a repository are combined before the shuffle, then inside an
    owner, so a value that fills a third of the corpus adds few rows per step.
    """
    held = (scanned.select("owner", "repository", F.explode("candidates").alias("c"))
            .select(F.col("c.digest").alias("digest"), "owner", "repository"))
    per_repo = held.groupBy("digest", "owner", "repository").agg(F.count("*").alias("hits"))
    per_owner = per_repo.groupBy("digest", "owner").agg(F.count("*").alias("repositories"))
    return per_owner.groupBy("digest").agg(F.count("*").alias("owners"),
                                           F.sum("repositories").alias("repositories"))


#: A value is a copied example from so many owners or so many repositories on, and live only up to
#: so many of both; between them there is no verdict.
MIN_EXAMPLE_OWNERS, MIN_EXAMPLE_REPOSITORIES = 3, 4
MAX_LIVE_OWNERS, MAX_LIVE_REPOSITORIES = 1, 2


def judged(scanned: DataFrame) -> DataFrame:
    """``row, start, end, from_rule, ord`` of every candidate; ``ord`` is live, example or null."""
    occurrences = (scanned.select("row", F.explode("candidates").alias("c"))
                   .select("row", F.col("c.start").alias("start"), F.col("c.end").alias("end"),
                           F.col("c.from_rule").alias("from_rule"),
                           F.col("c.looks_live").alias("looks_live"), F.col("c.digest").alias("digest")))
    kind = (F.when((F.col("owners") >= MIN_EXAMPLE_OWNERS) | (F.col("repositories") >= MIN_EXAMPLE_REPOSITORIES),
                   KINDS.index("example"))
             .when((F.col("owners") <= MAX_LIVE_OWNERS) & (F.col("repositories") <= MAX_LIVE_REPOSITORIES)
                   & F.col("looks_live"), KINDS.index("live")))
    return salted_lookup(occurrences, ownership(scanned), ["digest"], "row").select(
        "row", "start", "end", "from_rule", kind.alias("ord"))


def verdicts(scanned: DataFrame) -> DataFrame:
    """Added spans per row: ``row, added`` (live and example spans)."""
    return (judged(scanned).filter(F.col("ord").isNotNull())
            .groupBy("row").agg(F.collect_set(F.struct("start", "ord", "end").cast(SPAN)).alias("added")))


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(name, s["ord"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _n(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["ord"] == KINDS.index(kind))).cast("long")


def secret_spans(docs: DataFrame, **options) -> DataFrame:
    """One row per document: base counts, digest of the base spans, all spans.

    ``n_live`` and ``n_example`` count the added spans by verdict.
    """
    scanned = scan(docs, **options)
    none = F.array().cast(f"array<{SPAN}>")
    both = scanned.join(verdicts(scanned), "row", "left").withColumn("added", F.coalesce("added", none))
    base, added = F.col("base"), F.col("added")
    return both.select(
        F.col("id").alias("doc_id"), _n(base, "assign").alias("n_assign"), _n(base, "access").alias("n_access"),
        _n(base, "hex").alias("n_hex"), F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.concat(base, added)).alias("spans"),
        _n(added, "live").alias("n_live"), _n(added, "example").alias("n_example"))


def redacted(docs: DataFrame, text: str = "text", length: str = "n_chars", mark: str = "[SECRET]",
             id_col: str = "doc_id", **options) -> DataFrame:
    """All rows in the columns of ``docs``, with secret values replaced by ``mark``.

    Replaced are the values of base matches and the live-looking ones; values that
    many owners hold (copied examples) stay. Overlapping values become one mark.
    ``length`` (if there is such a column) follows the changed text.
    """
    scanned = scan(docs, text, id_col=id_col, **options)
    example, live = KINDS.index("example"), KINDS.index("live")
    hits = (judged(scanned).filter((F.col("ord") == live)
                                   | (F.col("from_rule") & ~F.col("ord").eqNullSafe(F.lit(example))))
            .select("row", "start", "end").distinct())
    # Overlapping values become one: a value is fresh if all before it end at or before its start.
    in_text = Window.partitionBy("row").orderBy("start", "end")
    reach = F.max("end").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (F.coalesce(reach, F.lit(0)) <= F.col("start")).cast("int")
    merged = (hits.withColumn("fresh", fresh).withColumn("k", F.sum("fresh").over(in_text))
              .groupBy("row", "k").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    spans = merged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("hidden"))
    hidden = (spans.join(scanned.select("row", "id", "identity"), "row")
              .groupBy(F.col("id").alias("k0"), F.col("identity").alias("k1")).agg(F.first("hidden").alias("hidden")))
    # The few documents with secrets are stored, so the join sees how many there are.
    both = by_key(keyed(docs, id_col, text), stored(narrowed(hidden), "secret-values"), 2, "left")
    old = F.col(f"doc.`{text}`")
    # A substring is found by counting from the start, so the text is cut into blocks first.
    long = F.length(old)
    block = F.greatest(F.lit(2048), F.ceil(long / 512).cast("int"))
    cut = F.transform(F.sequence(F.lit(0), F.floor(long / F.col("block")).cast("int")),
                      lambda b: F.substr(old, b * F.col("block") + 1, F.col("block")))
    both = (both.withColumn("block", F.when(F.col("hidden").isNotNull(), block))
            .withColumn("blocks", F.when(F.col("hidden").isNotNull(), cut))
            .withColumn("long", long))

    def piece(a, b):
        """The text from a to b, out of its blocks."""
        size, get = F.col("block"), lambda k: F.get(F.col("blocks"), k)
        first, last = F.floor(a / size).cast("int"), F.floor(b / size).cast("int")
        inside = F.substr(get(first), a % size + 1, F.least(size, b - a))
        between = F.array_join(F.slice("blocks", first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        return F.when(first == last, inside).otherwise(
            F.concat(F.substr(get(first), a % size + 1, size), between, F.substr(get(last), F.lit(1), b % size)))

    kept = F.transform("hidden", lambda x, i: F.concat(
        piece(F.coalesce(F.get(F.col("hidden"), i - 1)["end"], F.lit(0)), x["start"]), F.lit(mark)))
    new = F.concat(F.array_join(kept, ""), piece(F.element_at("hidden", -1)["end"], F.col("long")))
    return with_text(both, docs.columns, text, F.when(F.col("hidden").isNull(), old).otherwise(new), length)
