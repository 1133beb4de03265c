"""Event contracts: schemas as data, set-at-a-time message validation, wire format.

* ``CONTRACTS`` – the four record contracts (field, type, nullable-with-default).
* ``contract_schema`` – contract → Spark ``StructType`` (nullable iff a null union).
* ``validate_messages`` – one pass over JSON messages: parse once to VARIANT,
  read each field's JSON type, and emit the list of violations per message
  (unknown field, missing required field, null in required field, wrong type,
  optional domain rules). ``split_messages`` routes valid rows to typed columns
  (absent optional fields get their default) and the rest to a rejects frame.
* ``wire_frame`` / ``parse_wire_header`` – the schema-registry wire header:
  magic byte 0, big-endian unsigned 32-bit schema id, then the body.
* ``topic_name`` / ``route_topic`` – JSON topics keep their name, Avro topics get
  the ``.avro.v1`` suffix; unknown topics or formats are rejected (null).
* ``check_evolution`` – BACKWARD compatibility plus "a field without default may
  not be removed or retyped", as a join of two schema frames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The record contracts. Each field is (name, type, optional-with-null-default).
CONTRACTS: dict[str, list[tuple[str, str, bool]]] = {
    "events.clickstream": [
        ("event_id", "string", False), ("user_id", "string", False), ("item_id", "string", False),
        ("merchant_id", "string", False), ("event_type", "string", False),
        ("device_type", "string", False), ("dwell_time_ms", "long", False),
        ("referrer_page", "string", False), ("latitude", "double", False),
        ("longitude", "double", False), ("event_ts_ms", "long", False)],
    "events.telemetry": [
        ("telemetry_id", "string", False), ("courier_id", "string", False), ("order_id", "string", True),
        ("latitude", "double", False), ("longitude", "double", False), ("speed_kmh", "double", False),
        ("bearing_deg", "int", False), ("status", "string", False), ("event_ts_ms", "long", False)],
    "cdc.users": [
        ("user_id", "string", False), ("op", "string", False), ("event_ts_ms", "long", False),
        ("display_name", "string", True)],
    "cdc.products": [
        ("product_id", "string", False), ("merchant_id", "string", False), ("op", "string", False),
        ("event_ts_ms", "long", False), ("name", "string", True), ("category", "string", True)],
}
TOPICS = tuple(CONTRACTS)
FORMATS = ("json", "avro")
AVRO_SUFFIX = ".avro.v1"

_SPARK_TYPES = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(),
                "double": T.DoubleType(), "float": T.FloatType(), "boolean": T.BooleanType(),
                "bytes": T.BinaryType()}
# JSON value types (as reported for a parsed VARIANT) accepted for each contract type.
_ACCEPTS = {"string": ["STRING"], "long": ["BIGINT"], "int": ["BIGINT"],
            "double": ["BIGINT", "DECIMAL", "DOUBLE"], "float": ["BIGINT", "DECIMAL", "DOUBLE"],
            "boolean": ["BOOLEAN"], "bytes": ["STRING"]}
INT32 = (-(2 ** 31), 2 ** 31 - 1)
#: Stands between the reasons of the fields while they are one text.
_BETWEEN = "\x01"


def contract(topic: str) -> list[tuple[str, str, bool]]:
    if topic not in CONTRACTS:
        raise ValueError(f"Unknown event contract: {topic}")
    return CONTRACTS[topic]


def contract_schema(topic: str) -> T.StructType:
    """Contract → StructType; a field is nullable iff its type is a union with null."""
    return T.StructType([T.StructField(n, _SPARK_TYPES[t], opt) for n, t, opt in contract(topic)])


def avsc_to_fields(avsc: dict) -> list[tuple[str, str, bool]]:
    """Record schema JSON (``{"fields": [...]}``) → contract field list."""
    out = []
    for f in avsc["fields"]:
        t = f["type"]
        if isinstance(t, list):
            non_null = [x for x in t if x != "null"]
            if len(non_null) != 1:
                raise ValueError(f"Unsupported union for {f['name']}: {t}")
            out.append((f["name"], non_null[0], "null" in t))
        else:
            out.append((f["name"], t, False))
    return out


def topic_name(topic: str, event_format: str) -> str:
    if topic not in TOPICS:
        raise ValueError(f"Unknown event contract: {topic}")
    if event_format not in FORMATS:
        raise ValueError(f"Unsupported event format: {event_format}")
    return f"{topic}{AVRO_SUFFIX}" if event_format == "avro" else topic


def route_topic(topic: Column, event_format: Column) -> Column:
    """Column version of ``topic_name``; null for an unknown topic or format."""
    known = topic.isin(list(TOPICS)) & event_format.isin(list(FORMATS))
    return F.when(known & (event_format == "avro"), F.concat(topic, F.lit(AVRO_SUFFIX))) \
            .when(known, topic)


def _is_kind(schema: Column, kinds: list[str]) -> Column:
    """Whether the type of a VARIANT value (``schema_of_variant``) is one of BIGINT, DECIMAL, DOUBLE, STRING, VOID…"""
    return reduce(Column.__or__, [schema.startswith(f"{k}(") if k == "DECIMAL" else schema == k for k in kinds])


def computed_once(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with new columns that go through a one-row generator.

    Filters on what a generator returns stay above it; below a projection alone they would
    take a copy of the expression for every use of a column.
    """
    kept = [F.col(f"`{c}`") for c in (df.columns if keep is None else keep)]
    made = df.select(*kept, *[c.alias(f"_made_{n}") for n, c in columns.items()])
    return made.select(*kept, F.inline(F.array(F.struct(*[F.col(f"_made_{n}").alias(n) for n in columns]))))


#: Types of the fields of an object as ``schema_of_variant`` writes them, as patterns.
_WRITTEN = {"DECIMAL": r"DECIMAL\([0-9]+,[0-9]+\)"}


def _plain_shape(topic: str) -> str:
    """Pattern of ``schema_of_variant`` of a message that has the fields of the contract in their types and no others.

    The fields of an object stand in the order of their names; a name that is no plain
    identifier stands in quotes, so none can pass for a field and its type.
    """
    fields = ""
    for name, typ, optional in sorted(contract(topic)):
        kinds = [_WRITTEN.get(k, k) for k in _ACCEPTS[typ]] + ["VOID"] * optional
        fields += f"(?:{name}: (?:{'|'.join(kinds)})(?:, |>$)){'?' if optional else ''}"
    return f"^OBJECT<{fields}(?<=>)$"


def validate_messages(messages: DataFrame, topic: str, value_col: str = "value",
                      domains: dict[str, list[str]] | None = None, parsed: bool = False) -> DataFrame:
    """Add ``reasons`` (array<string>, empty = valid) and ``valid`` to a frame of JSON text.

    ``parsed`` keeps the VARIANT as ``_v`` for ``typed_columns`` (null, if it is no JSON).

    The message is parsed once (``try_parse_json``). The types of all its fields, read
    at once, tell most valid messages apart; only the others have their keys listed and
    each field's type looked at (so a string "123" is not mistaken for a number). The
    reasons are ``computed_once``: a filter on them would otherwise be moved below the
    parse and repeat it wherever a field is looked at.
    """
    fields = contract(topic)
    domains = domains or {}
    base = messages.columns
    st = messages.withColumn("_v", F.try_parse_json(F.col(value_col)))
    read = lambda name, kind: F.expr(f"try_variant_get(_v, '$.{name}', '{kind}')")
    numbers = {name: read(name, "bigint") for name, typ, _ in fields if typ == "int"}
    texts = {name: read(name, "string") for name, _, _ in fields if domains.get(name)}
    plain = reduce(Column.__and__, [F.schema_of_variant("_v").rlike(_plain_shape(topic)),
                                    *[n.between(*INT32) for n in numbers.values()],
                                    *[t.isin(domains[name]) for name, t in texts.items()]])
    st = st.withColumn("_plain", F.coalesce(plain, F.lit(False)))
    st = st.withColumns({"_odd": F.when(~F.col("_plain"), F.col("_v")),
                         "_keys": F.json_object_keys(F.when(~F.col("_plain"), F.col(value_col)))})
    st = st.withColumns({f"_t_{name}": F.schema_of_variant(F.expr(f"_odd:`{name}`")) for name, _, _ in fields})
    checks: list[Column] = []
    for name, typ, optional in fields:
        kind = F.col(f"_t_{name}")  # null, if there is no such field
        ok_type = _is_kind(kind, _ACCEPTS[typ])
        if typ == "int":
            ok_type = ok_type & numbers[name].between(*INT32)
        if optional:
            found = F.when(kind.isNull() | (kind == "VOID"), F.lit(None))
        else:
            found = F.when(kind.isNull(), F.lit(f"missing:{name}")).when(kind == "VOID", F.lit(f"null:{name}"))
        found = found.when(~ok_type, F.lit(f"wrong_type:{name}"))
        if domains.get(name):
            found = found.when(~texts[name].isin(domains[name]), F.lit(f"invalid_value:{name}"))
        checks.append(found)
    known = F.array(*[F.lit(n) for n, _, _ in fields])
    none = F.array().cast("array<string>")
    odd = F.col("_odd").isNotNull() & F.col("_keys").isNotNull()
    st = st.withColumns({"_found": F.when(odd, F.concat_ws(_BETWEEN, *checks)),
                         "_extra": F.when(odd, F.array_except("_keys", known))})
    unknown = F.transform("_extra", lambda k: F.concat(F.lit("unknown:"), k))
    per_field = F.when(F.col("_found") == "", none).otherwise(F.split("_found", _BETWEEN))
    reasons = F.when(F.col("_plain"), none).when(F.col("_found").isNull(), F.array(F.lit("parse_error"))) \
               .when((F.col("_found") == "") & (F.size("_extra") == 0), none) \
               .when(F.size("_extra") == 0, F.array_sort(per_field)) \
               .otherwise(F.array_sort(F.concat(per_field, unknown)))
    return computed_once(st, {"reasons": reasons}, [*base, *(["_v"] if parsed else [])]).withColumn("valid", F.size("reasons") == 0)


def typed_columns(topic: str, variant_col: str = "_v") -> list[Column]:
    """Typed fields read from a parsed VARIANT column; absent optional fields → null default."""
    cols = []
    for name, typ, _ in contract(topic):
        spark_type = _SPARK_TYPES[typ].simpleString()
        cols.append(F.expr(f"try_variant_get(`{variant_col}`, '$.{name}', '{spark_type}')").alias(name))
    return cols


def with_typed(checked: DataFrame, topic: str, value_col: str = "value") -> DataFrame:
    """Typed columns beside those of ``validate_messages(..., parsed=True)``; equal to ``typed_columns``.

    A valid message has the contract's types, so one pass over its text reads all fields at
    once. The VARIANT is asked for the rest: invalid messages, whatever that pass leaves
    null, and zeros, as it alone knows no negative zero in whole numbers and decimals.
    """
    read = checked.withColumn("_j", F.from_json(value_col, contract_schema(topic)))
    whole = reduce(Column.__and__, [F.col(f"_j.{n}").isNotNull() for n, _, optional in contract(topic) if not optional],
                   F.col("valid"))
    read = read.withColumn("_whole", whole)
    columns = []
    for (name, typ, _), asked in zip(contract(topic), typed_columns(topic, "_v")):
        fits = F.col("_whole") & (F.col(f"_j.{name}") != 0) if typ in ("double", "float") else F.col("_whole")
        columns.append(F.when(fits, F.col(f"_j.{name}")).otherwise(asked).alias(name))
    return read.select(*[c for c in checked.columns if c != "_v"], *columns)


def split_messages(messages: DataFrame, topic: str, value_col: str = "value",
                   domains: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows as typed contract columns, rejects with their reasons) — one validation pass.

    Callers that write both outputs should persist the validated frame (as the
    streaming sink does per micro-batch) so the messages are parsed once.
    """
    checked = validate_messages(messages, topic, value_col, domains, parsed=True)
    extra = [c for c in messages.columns if c != value_col]
    valid = checked.filter("valid").select(*extra, *typed_columns(topic, "_v"))
    rejects = checked.filter(~F.col("valid")).select(*messages.columns, "reasons")
    return valid, rejects


def to_messages(df: DataFrame, topic: str) -> DataFrame:
    """Rows with contract columns → JSON messages (``value``); null optional fields are omitted."""
    names = [n for n, _, _ in contract(topic)]
    return df.select(F.to_json(F.struct(*names)).alias("value"))


# --- wire format -----------------------------------------------------------------------------

def wire_frame(body: Column, schema_id: Column, magic: int = 0) -> Column:
    """``magic byte || uint32 big-endian schema id || body`` as binary."""
    if not 0 <= magic <= 255:
        raise ValueError("magic must be one byte")
    head = F.unhex(F.concat(F.lpad(F.hex(F.lit(magic)), 2, "0"), F.lpad(F.hex(schema_id), 8, "0")))
    in_range = (schema_id >= 0) & (schema_id < F.lit(2 ** 32))
    return F.when(in_range, F.concat(head, body.cast("binary")))


def parse_wire_header(frame: Column) -> Column:
    """Struct(magic int, schema_id bigint, body binary, valid boolean) of a framed message.

    Valid when at least five bytes, magic is 0 and the schema id is positive.
    """
    magic = F.conv(F.hex(F.substring(frame, 1, 1)), 16, 10).cast("int")
    sid = F.conv(F.hex(F.substring(frame, 2, 4)), 16, 10).cast("bigint")
    body = F.substring(frame, 6, 2 ** 31 - 1)
    ok = (F.length(frame) >= 5) & (magic == 0) & (sid > 0)
    return F.struct(magic.alias("magic"), sid.alias("schema_id"), body.alias("body"),
                    F.coalesce(ok, F.lit(False)).alias("valid"))


def decode_frames(df: DataFrame, frame_col: str = "frame") -> DataFrame:
    """Add ``header`` (see ``parse_wire_header``) to a frame of binary messages."""
    return df.withColumn("header", parse_wire_header(F.col(frame_col)))


# --- schema evolution --------------------------------------------------------------------------

_PROMOTIONS = {("int", "long"), ("int", "float"), ("int", "double"), ("long", "float"),
               ("long", "double"), ("float", "double"), ("string", "bytes"), ("bytes", "string")}


def evolution_fields(avsc: dict) -> list[tuple[str, str, bool, bool]]:
    """Record schema JSON → (name, type, nullable, has_default): a union with null alone is no default."""
    return [(n, t, optional, "default" in f)
            for (n, t, optional), f in zip(avsc_to_fields(avsc), avsc["fields"])]


def schema_frame(spark: SparkSession, fields: list[tuple]) -> DataFrame:
    """Fields (name, type, optional) as in contracts, where optional means nullable with a
    null default, or (name, type, nullable, has_default)."""
    return spark.createDataFrame([(f[0], f[1], bool(f[2]), bool(f[-1])) for f in fields],
                                 "name string, type string, nullable boolean, has_default boolean")


def check_evolution(previous: DataFrame, candidate: DataFrame) -> DataFrame:
    """Violations of candidate (reader) against previous (writer): ``(name, rule)``.

    Rules: a new field needs a default; a field kept in both must be readable (same
    type or a numeric/bytes promotion); a field that may hold null cannot become
    required; a required field of the previous version must stay with the identical
    type.
    """
    p = previous.select(F.col("name"), F.col("type").alias("p_type"), F.col("nullable").alias("p_null"))
    c = candidate.select(F.col("name"), F.col("type").alias("c_type"), F.col("nullable").alias("c_null"),
                         F.col("has_default").alias("c_def"))
    both = p.join(c, "name", "full")
    promo = F.array(*[F.lit(f"{a}>{b}") for a, b in sorted(_PROMOTIONS)])
    readable = (F.col("p_type") == F.col("c_type")) | F.array_contains(
        promo, F.concat(F.col("p_type"), F.lit(">"), F.col("c_type")))
    rule = (F.when(F.col("p_type").isNull() & ~F.col("c_def"), "new_field_without_default")
             .when(F.col("c_type").isNull() & ~F.col("p_null"), "required_field_removed")
             .when(F.col("p_type").isNotNull() & F.col("c_type").isNotNull() & ~readable,
                   "incompatible_type")
             .when(F.col("p_null") & ~F.col("c_null"), "nullable_to_required")
             .when(F.col("p_type").isNotNull() & F.col("c_type").isNotNull() & ~F.col("p_null")
                   & (F.col("p_type") != F.col("c_type")), "required_field_retyped"))
    return both.select("name", rule.alias("rule")).filter(F.col("rule").isNotNull())


# --- typed fixture loading -----------------------------------------------------------------------

# Declared SQL type names accepted in fixture documents.
FIXTURE_TYPES = {"VARCHAR": T.StringType(), "STRING": T.StringType(), "CHAR": T.StringType(),
                 "BIGINT": T.LongType(), "INT": T.IntegerType(), "INTEGER": T.IntegerType(),
                 "DOUBLE": T.DoubleType(), "DATETIME": T.TimestampNTZType(), "TIMESTAMP": T.TimestampNTZType(),
                 "VARBINARY": T.BinaryType(), "BOOLEAN": T.BooleanType()}


def load_fixture_tables(spark: SparkSession, fixture: dict) -> dict[str, DataFrame]:
    """``{table: {"columns": [...], "types": [...], "rows": [[...]]}}`` → typed DataFrames.

    Datetime values are ISO text (``YYYY-MM-DD HH:MM:SS``); type names may carry a
    length suffix (``VARCHAR(64)``), which is ignored.
    """
    import datetime as _dt
    out = {}
    for name, spec in fixture.items():
        types = [FIXTURE_TYPES[t.upper().split("(")[0]] for t in spec["types"]]
        schema = T.StructType([T.StructField(c, t) for c, t in zip(spec["columns"], types)])
        rows = []
        for r in spec["rows"]:
            vals = []
            for v, t in zip(r, types):
                if v is not None and isinstance(t, T.TimestampNTZType) and isinstance(v, str):
                    v = _dt.datetime.fromisoformat(v)
                if v is not None and isinstance(t, T.BinaryType) and isinstance(v, str):
                    v = bytes.fromhex(v)
                vals.append(v)
            rows.append(tuple(vals))
        out[name] = spark.createDataFrame(rows, schema)
    return out
