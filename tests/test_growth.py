"""Steps that must not grow faster than their input: plans, passes over a table, rows of a task."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from hexvault.sources import contracts as C

CLICK = {"event_id": "e1", "user_id": "u1", "item_id": "i1", "merchant_id": "m1", "event_type": "click",
         "device_type": "ios", "dwell_time_ms": 100, "referrer_page": "home_feed", "latitude": 10.7,
         "longitude": 106.7, "event_ts_ms": 1}


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "")


def _messages(spark, payloads):
    return spark.createDataFrame([(json.dumps(p),) for p in payloads], "value string").repartition(2)


def test_filter_on_validity_parses_a_message_once(spark):
    messages = _messages(spark, [CLICK, {**CLICK, "user_id": None, "more": 1}])
    valid, rejects = C.split_messages(messages, "events.clickstream")
    assert _optimized(rejects).count("parsejson") == 1
    assert _optimized(valid).count("parsejson") == 1
    assert [r["reasons"] for r in rejects.collect()] == [["null:user_id", "unknown:more"]]
    assert [r["user_id"] for r in valid.collect()] == ["u1"]


def test_typed_stream_reads_columns_from_the_validated_parse(spark):
    from hexvault.streaming import ingest as I
    typed = I.typed_stream(_messages(spark, [CLICK, {**CLICK, "user_id": 5}]), "events.clickstream")
    assert _optimized(typed).count("parsejson") == 1
    found = sorted((r["valid"], r["user_id"], r["event_ts_ms"]) for r in typed.collect())
    assert found == [(False, "5", 1), (True, "u1", 1)]


def test_unpacked_reasons_parse_a_message_once(spark):
    checked = C.validate_messages(_messages(spark, [CLICK, {**CLICK, "event_type": 3, "b": 1, "a": 2}]),
                                  "events.clickstream")
    reasons = checked.select(F.explode("reasons").alias("reason"))
    assert _optimized(reasons).count("parsejson") == 1
    assert [r[0] for r in reasons.collect()] == ["unknown:a", "unknown:b", "wrong_type:event_type"]


def test_a_slice_is_one_batch_of_many_files(spark, workdir):
    import __spark_entry__  # noqa: F401  (registers the queries in order)
    from hexvault.plans import streaming_queries as SQ
    seen = []

    class Held:
        pass

    c = Held()
    c.spark = spark
    slices = [spark.range(k * 100, k * 100 + 100, 1, 4).select(F.col("id").alias("n")) for k in range(3)]
    SQ._in_order(c, workdir, slices, lambda source: source.writeStream.foreachBatch(
        lambda b, i: seen.append((b.rdd.getNumPartitions(), sorted(r.n for r in b.collect()))))
        .option("checkpointLocation", f"{workdir}/ck").trigger(availableNow=True).start())
    assert [rows for _, rows in seen] == [list(range(k * 100, k * 100 + 100)) for k in range(3)]
    written = [n for n in __import__("os").listdir(f"{workdir}/events") if n.startswith("part-")]
    assert len(written) == 12 and all(parts > 1 for parts, _ in seen)


def test_state_holds_one_entry_a_key_and_batch(spark):
    import pandas as pd
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    from hexvault.streaming import state as ST

    class Kept(list):
        def appendValue(self, v):
            self.append(v)

        def put(self, v):
            self[:] = v

        def get(self):
            return iter(list(self))

    class Last:
        value = None
        exists = lambda self: self.value is not None
        get = lambda self: self.value

        def update(self, v):
            self.value = v

    class Handle:
        getValueState = lambda self, *a: Last()
        getListState = lambda self, *a: Kept()
        registerTimer = lambda self, ms: None

    class At:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

    schema = to_arrow_schema(T.StructType().add("ts_us", "long").add("h", "long").add("status", "string")
                             .add("hash_diff", "string"))
    step = ST._Changes("k", ["ts_us", "status", "h"], schema, ["ts_us", "status", "hash_diff"])
    step.init(Handle())
    rows = lambda *r: iter([pd.DataFrame(r, columns=["ts_us", "h", "status", "hash_diff"])])
    list(step.handleInputRows(("a",), rows((3000, None, "x", "1"), (1000, 2 ** 60 + 1, None, "0"), (2000, 3, "x", "1")), At(0)))
    list(step.handleInputRows(("a",), rows((9000, 5, "y", "2"), (2500, 4, "z", "3")), At(0)))
    assert len(step.pending) == 2
    found = [f.values.tolist() for f in step.handleExpiredTimer(("a",), At(4), None)]
    assert found == [[["a", 1000, None, "0"], ["a", 2000, "x", "1"], ["a", 2500, "z", "3"], ["a", 3000, "x", "1"]]]
    assert len(step.pending) == 1 and not list(step.handleExpiredTimer(("a",), At(8), None))
    assert [f.values.tolist() for f in step.handleExpiredTimer(("a",), At(9), None)] == [[["a", 9000, "y", "2"]]]


def _exchanges(df) -> int:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def _pings(spark, n=400):
    import datetime as dt
    import random
    rnd = random.Random(4)
    day = dt.datetime(2024, 1, 1)
    rows = [(f"c{rnd.randint(0, 6)}" if i % 3 else None, day + dt.timedelta(minutes=rnd.randint(0, 9000)),
             1.0 * rnd.randint(0, 3), 2.0, 3.0, 4, rnd.choice(["idle", "delivering", None]), rnd.randint(5, 7), 9)
            for i in range(n)]
    schema = ("hk_courier_id string, load_date timestamp_ntz, latitude double, longitude double, speed_kmh double, "
              "bearing_deg int, status string, h3_res7 long, h3_res9 long")
    return spark.createDataFrame(rows + rows[::5], schema)


def test_history_and_travel_times_deal_rows_out_once(spark, monkeypatch):
    from hexvault.operators import features as D
    from hexvault.operators import sequence as Q
    from hexvault.operators import staging
    tie = ["status", "latitude", "longitude", "speed_kmh", "bearing_deg", "h3_res7", "h3_res9"]
    sat = _pings(spark)
    staged = staging.stg_courier_telemetry(sat)
    rows = lambda df: sorted(map(str, df.collect()))
    whole = (rows(D.historize(staged, "hk_courier_id", "load_date", ["status"], tie)), rows(D.travel_times(staged)))
    for limit in (Q.MAX_KEY_ROWS, 30):  # no large key; large keys that are cut by the hour
        monkeypatch.setattr(Q, "MAX_KEY_ROWS", limit)
        in_order = lambda: staging.stg_courier_telemetry(Q.dealt(sat, "hk_courier_id", "load_date"))
        history = D.historize(in_order(), "hk_courier_id", "load_date", ["status"], tie, is_dealt=True)
        assert rows(history) == whole[0]
        assert rows(D.travel_times(in_order(), is_dealt=True)) == whole[1]
        if limit > 30:
            assert _exchanges(history) == 1


def test_keys_of_few_rows_stay_whole(spark):
    from hexvault.operators import sequence as Q
    df = spark.createDataFrame([(f"k{i % 9}", i * 3_600_000, i) for i in range(90)], "k string, t long, n int")
    assert Q.key_widths(df, "k", "t") is None
    out = Q.sequence_features(df, "k", ["t"], lag=["n"])
    assert _exchanges(out) == 1 and {r["prev_n"] for r in out.collect() if r["n"] >= 9} == set(range(81))


def test_clusters_compute_profiles_once(spark):
    from hexvault.operators import ml as ML
    sat = _pings(spark)
    out = ML.courier_clusters(sat)
    assert "Scan ExistingRDD" in out._jdf.queryExecution().executedPlan().toString()
    assert _exchanges(out) == 0 and out.count() == 8


def test_marginal_relevance_holds_a_batch_of_rows(spark):
    from hexvault.operators import rerank as R
    seen = spark.createDataFrame([(f"u{u}", f"i{i}", float((i * 7 + u) % 11)) for u in range(9) for i in range(12)],
                                 "user_id string, item_id string, score double")
    vectors = spark.createDataFrame([(f"i{i}", [float(i % 3), float(i % 4), 1.0]) for i in range(11)],
                                    "item_id string, embedding array<double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)  # a list spans batches
    try:
        out = R.mmr(seen, vectors, limit=8)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        got = {}
        for r in out.orderBy("user_id", "position").collect():
            got.setdefault(r["user_id"], []).append((r["position"], r["rank"], r["item_id"]))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "collect_list" not in plan and len(got) == 9
    known = {r["item_id"]: r["embedding"] for r in vectors.collect()}
    for u in range(9):
        best = sorted(((float((i * 7 + u) % 11), f"i{i}") for i in range(12)), key=lambda x: (-x[0], x[1]))[:8]
        units = R.unit_rows([known.get(i) for _, i in best], 3)
        order = R.mmr_order(__import__("numpy").array([s for s, _ in best]) / best[0][0], units, R.MMR_LAMBDA)
        assert got[f"u{u}"] == [(p + 1, o + 1, best[o][1]) for p, o in enumerate(order)]


def test_rounds_of_components_write_few_files(spark):
    import glob
    from hexvault.llm.components import connected_components
    from hexvault.session import ensure_checkpoint_dir
    files = lambda: set(glob.glob(f"{ensure_checkpoint_dir(spark)}/**/rdd-*/part-*", recursive=True))
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 101), (None, 7)], "a long, b long")
    before, kept = files(), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.node: r.root for r in connected_components(links).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {**{k: 1 for k in range(1, 41)}, 100: 100, 101: 100}
    of = {}
    for path in files() - before:
        of.setdefault(path.rsplit("/", 2)[1], []).append(path)
    assert of and max(map(len, of.values())) == 8  # 64 / 8, not one file a shuffle partition


def test_packed_hashes_come_back(spark):
    from hexvault.functions import hashing as H
    texts = [None, "", "c1", "A" * 32, "a" * 32, "0123456789ABCDEF" * 2, "0123456789abcdef" * 2, "G" * 32, "\0" * 15, "\0" * 17, "é" * 32]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "i int, hk_a string, b string")
    packed = H.with_packed_hashes(df)
    assert packed.schema["hk_a"].dataType.simpleString() == "binary" and packed.schema["b"] == df.schema["b"]
    assert packed.select("hk_a").distinct().count() == len(texts)
    assert packed.filter(F.octet_length("hk_a") == 16).count() == 2
    assert sorted(H.with_hashes(packed).collect()) == sorted(df.collect())


def test_built_telemetry_keeps_a_courier_in_one_file(spark, workdir, monkeypatch):
    import glob
    from hexvault.operators import sequence as Q
    from hexvault.operators import staging
    from hexvault.operators.vault import Vault
    from hexvault.plans.models import Models
    sat = _pings(spark).repartition(4)
    vault = Vault({n: sat for n in Vault.NAMES})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for limit, at in ((Q.MAX_KEY_ROWS, "whole"), (30, "cut")):  # no large key; large keys that are cut by the hour
            monkeypatch.setattr(Q, "MAX_KEY_ROWS", limit)
            Models(vault).build(f"{workdir}/{at}", ["stg_courier_telemetry"])
            built = spark.read.parquet(f"{workdir}/{at}/stg_courier_telemetry")
            assert built.columns == staging.TELEMETRY_COLUMNS
            rows = lambda df: sorted(map(str, df.collect()))
            assert rows(built) == rows(staging.stg_courier_telemetry(sat))
            files = built.select("hk_courier_id", F.input_file_name().alias("f")).distinct().groupBy("hk_courier_id").count()
            assert at == "cut" or files.agg(F.max("count")).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    names = glob.glob(f"{workdir}/whole/stg_courier_telemetry/part-*")
    assert len(names) > 1 and all(".zstd." in n for n in names)


def test_gate_groups_packed_hashes(spark):
    from hexvault.operators import quality as Q
    tests = [Q.Test("unique", "a", "hk_x"), Q.Test("unique_combination", "a", None, {"columns": ["hk_x", "n"]}),
             Q.Test("relationships", "a", "hk_x", {"to": "p", "field": "id"})]
    key = "0123456789ABCDEF" * 2
    models = {"a": spark.createDataFrame([(key, 1), (key, 1), (key.lower(), 1), ("u", 2), (None, 3), (None, 3)], "hk_x string, n int"),
              "p": spark.createDataFrame([(key,), ("v",)], "id string")}
    out = Q.gate_results(models, tests)
    assert {r["kind"]: r["violations"] for r in out.collect()} == {"unique": 1, "unique_combination": 2, "relationships": 2}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("unhex") >= 2


def _joins(df) -> tuple[int, int]:
    """(merged joins, broadcasts) of the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("SortMergeJoin"), plan.count("Broadcast")


def test_audit_lookups_are_not_broadcast_with_their_repeats(spark, workdir):
    from hexvault.llm import filter_audit as A
    path = f"{workdir}/labels"  # a file of few bytes a row, as the table of labels is
    spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"),
                             (F.col("id") % 3 == 0).cast("int").alias("toxic")).write.parquet(path)
    rows = spark.range(4000).select(F.col("id").alias("row"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("id"),
                                    F.sha2((F.col("id") % 1500).cast("string"), 256).cast("binary").alias("identity"))
    marks = A.labelled(rows, spark.read.parquet(path))
    assert _joins(marks) == (1, 0)
    assert {tuple(r) for r in marks.collect()} == {
        (k, k % 2, int(k % 3 == 0)) for k in range(3000) if k % 7 and (k % 2 or k % 3 == 0)}
    again = A.repeated(rows)
    assert _joins(again) == (1, 0)
    least = {}
    for k in range(4000):
        if k % 7:
            least[k % 1500] = min(k, least.get(k % 1500, k))
    assert {r["row"] for r in again.collect()} == {k for k in range(4000) if k % 7 and k > least[k % 1500]}


def test_repeated_strings_are_looked_up_without_a_broadcast(spark, monkeypatch):
    import random
    from hexvault.llm import common
    from hexvault.llm import suffix_dedup as S
    rnd = random.Random(8)
    prose = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = prose(90)
    docs = spark.createDataFrame([(i, f"{prose(60)}{passage if i % 2 else ''}{prose(60)}") for i in range(40)],
                                 "doc_id long, text string").repartition(3)
    seen, joined = [], common.salted_lookup
    monkeypatch.setattr(S, "salted_lookup", lambda *a, **k: seen.append(joined(*a, **k)) or seen[-1])
    got = {r.doc_id: r.n_removed for r in S.deduplicated(docs, length=40, span=20, hot=1).collect()}
    assert all((got[i] >= 90) == bool(i % 2) for i in range(40))
    assert [_joins(df) for df in seen] == [(1, 0)] * 3  # of the hashes, of the hot strings, of the runs


def test_state_of_a_history_follows_the_buckets_not_the_keys(spark, workdir):
    import datetime as dt
    import os
    from hexvault.streaming import state as ST
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    calls = []

    class Counted(ST._BucketChanges):
        def emitted(self, key, ready):
            with open(f"{workdir}/calls", "a") as f:
                f.write("x\n")
            yield from super().emitted(key, ready)

    schema = "k string, at timestamp, status string, n long"
    keys = [None, *[f"k{i}" for i in range(60)]]
    slices = [[(k, day(d), s, n) for k in keys for d, s, n in part] for part in (
        [(0, "x", 1), (4, "x", None), (4, "w", 2 ** 60)], [(2, "y", 1), (0, "x", 1), (3, None, 1), (3, None, 2)],
        [(20, "z", 1)], [(1, "late", 1), (4, "x", None)], [(21, "z", 1)])] + [[("~", day(90), "x", 1)]]
    found = []
    before, ST._BucketChanges = ST._BucketChanges, Counted
    try:
        for name, buckets in (("by_key", None), ("by_bucket", 3)):
            for rows in slices:
                spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{workdir}/{name}")
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{workdir}/{name}")
            out, got = ST.history_stream(stream, "k", "at", ["status"], ["n"], "5 days", buckets), {}
            with ST.OnState(spark):
                q = (out.writeStream.foreachBatch(lambda b, i: [got.setdefault(r.k, []).append((r.at.timetuple().tm_yday, r.status))
                                                                for r in b.collect()] and None)
                     .option("checkpointLocation", f"{workdir}/{name}-ck").trigger(availableNow=True).start())
            q.awaitTermination()
            assert q.exception() is None
            assert set(got) == set(keys)
            found.append({k: sorted(v, key=str) for k, v in got.items()})
    finally:
        ST._BucketChanges = before
    assert found[0] == found[1] and {(3, "y"), (4, None), (5, "w"), (21, "z")} < set(found[1][None])
    calls = open(f"{workdir}/calls").read().split()
    assert 3 <= len(calls) <= 3 * len(slices) < len(keys)  # not one a key


def test_typed_columns_read_at_once_equal_those_of_the_variant(spark):
    odd = [json.dumps({**CLICK, **more}) for more in (
        {}, {"latitude": 0, "longitude": -5}, {"latitude": 0.1 + 0.2, "longitude": 1e-320}, {"dwell_time_ms": 2 ** 63 - 1},
        {"dwell_time_ms": 2 ** 63}, {"dwell_time_ms": 1.0}, {"dwell_time_ms": "7"}, {"latitude": "7"}, {"latitude": 2 ** 80},
        {"user_id": 5}, {"user_id": None}, {"user_id": "é\U0001f600\n\"\\ "}, {"user_id": ""}, {"extra": 1}, {"latitude": float("nan")})]
    plain = json.dumps(CLICK)
    odd += [plain.replace("10.7", x) for x in ("-0.0", "-0", "-0e0", "0.0", "1e400", "1E2", "123456789012345678901234567890.5")]
    odd += [plain + " x", plain[:-1], plain.replace('"u1"', "'u1'"), plain.replace('"u1"', '"\\ud800"'), "[]", "", None,
            plain[:-1] + ', "user_id": "u2"}', plain.replace('{"event_id"', ' {\t"event_id"')]
    pings = [json.dumps({"telemetry_id": "t", "courier_id": "c", "latitude": 1, "longitude": 2.5, "speed_kmh": 0.0,
                         "status": "idle", "event_ts_ms": 5, **more})
             for more in ({"bearing_deg": 7}, {"bearing_deg": 2 ** 31}, {"bearing_deg": 7, "order_id": None}, {"bearing_deg": 7, "order_id": "o"})]
    for topic, texts in (("events.clickstream", odd), ("events.telemetry", pings)):
        messages = spark.createDataFrame([(t,) for t in texts], "value string").repartition(2)
        checked = C.validate_messages(messages, topic, parsed=True)
        asked = checked.select("value", "reasons", "valid", *C.typed_columns(topic, "_v"))
        read = C.with_typed(checked, topic)
        assert read.columns == asked.columns and read.dtypes == asked.dtypes
        assert sorted(map(repr, read.collect())) == sorted(map(repr, asked.collect()))
        assert 2 < read.filter("valid").count() < len(texts) or topic == "events.telemetry"


def test_a_batch_holds_the_text_of_bad_messages_only(spark, workdir):
    from hexvault.streaming import ingest as I
    typed = I.typed_stream(_messages(spark, [CLICK, {**CLICK, "user_id": 5}]), "events.clickstream")
    sink = I.VaultSink(workdir, "events.clickstream", quarantine=True)
    held = {r.valid: r for r in sink.held(typed).collect()}
    assert held[True].value is None and held[True].reasons is None and held[True].user_id == "u1"
    assert json.loads(held[False].value)["user_id"] == 5 and held[False].reasons == ["wrong_type:user_id"]
    sink(typed, 0)
    assert [r.reasons for r in I.read_dead_letters(spark, workdir).collect()] == [["wrong_type:user_id"]]
    assert [(r.user_id, r.event_ts_ms) for r in I.read_log(spark, workdir).collect()] == [("u1", 1)]


def test_messages_of_a_query_are_stored_packed(spark, monkeypatch):
    import os
    import __spark_entry__  # noqa: F401  (registers the queries in order)
    from hexvault.operators.vault import with_event_time
    from hexvault.plans import streaming_queries as SQ
    from hexvault.streaming import ingest as I
    monkeypatch.setattr(SQ, "FILE_MESSAGES", 10, raising=False)

    class Held:
        pass

    c = Held()
    c.spark = spark
    c.clicks = with_event_time(spark.createDataFrame(
        [{**CLICK, "event_id": f"e{i}", "event_ts_ms": i} for i in range(95)], C.contract_schema("events.clickstream")).coalesce(1))
    root = SQ._run_stream(c, "events.clickstream")
    names = [n for n in os.listdir(f"{os.path.dirname(root)}/messages") if n.startswith("part-")]
    assert len(names) == 10 and all(n.endswith(".gz") for n in names)
    assert len(I.snapshot(spark, root, (I.CLICKS,))[I.CLICKS]) == 4
    assert sorted(r.event_ts_ms for r in I.read_log(spark, root).collect()) == list(range(95))
