"""Neighbours, archives, the classifier and the pipeline."""

from __future__ import annotations

import io
import zipfile
from collections import Counter

import numpy as np
import pytest

import brute
import corpus_pipeline
import __spark_entry__ as entry
from hexvault.llm import ann, quality_cnn, queries, warc
from hexvault.llm.common import table

SF = "/root/testdata/sf0.001"


# --- neighbours --------------------------------------------------------------------------

def vectors():
    rnd = np.random.default_rng(5)
    rows = [(i, rnd.normal(size=16).tolist()) for i in range(600)]
    common = rows[7][1]
    rows += [(1000 + i, common) for i in range(300)]
    rows += [(2000, None), (2050, []), (2100, [0.0] * 16), (2150, [None] + [1.0] * 15),
             (2200, [float("nan")] * 16), (2250, [float("inf")] + [0.0] * 15), (None, common), (2300, [1.0, 2.0]),
             rows[50], rows[51], (3000, [1e-30] * 16)]
    return rows


def test_neighbours_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "DATA_BLOCK", 100)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    rows = vectors()
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    got = ann.nearest(frame, 50, 5).collect()
    want = brute.neighbours(list({repr(r): r for r in rows}.values()), 50, 5)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == {q for q, w in want.items() if w}
    assert 2300 in want and 2300 not in found  # no other vector of its length
    for q, mine in found.items():
        # row 51 stands twice and takes a rank each time
        scores = [s for _, s in mine]
        assert scores == sorted(scores, reverse=True)
        assert np.allclose(scores[:1], [s for _, s in want[q]][:1], atol=1e-12)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in w}) for q, w in want.items() if q in found)
    assert hits / sum(len(w) for q, w in want.items() if q in found) >= 0.97
    common = [i for i, _ in found[1000]]
    assert common == [7, 1001, 1002, 1003, 1004]  # ties go to smaller ids


def test_neighbours_of_very_large_and_very_small_vectors(spark):
    rnd = np.random.default_rng(9)
    sizes = (1.0, 2.0 ** -600, 2.0 ** 600, 2.0 ** 1000, 2.0 ** -1000)
    plain = [(i, rnd.normal(size=16)) for i in range(300)]
    rows = [(i, (v * sizes[i // 7 % 5]).tolist()) for i, v in plain]
    rows += [(400, [5e-324] * 16), (401, [1.7e308] * 16), (402, [1.7e308, 5e-324] * 8)]
    plain += [(400, np.ones(16)), (401, np.ones(16)), (402, np.array([1.0, 0.0] * 8))]
    want = brute.neighbours([(i, v.tolist()) for i, v in plain], 50, 5)
    found = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        assert np.isfinite(r.score)
        found.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert set(found) == set(want) == {0, 50, 100, 150, 200, 250, 300 + 100}
    assert sum(len(set(found[q]) & {i for i, _ in w}) for q, w in want.items()) >= 34
    for q, w in want.items():
        assert all(abs(found[q][i] - s) < 1e-12 for i, s in w if i in found[q])
    assert found[400][401] == max(found[400].values()) and abs(found[400][401] - 1) < 1e-12


def test_neighbours_recall_on_the_whole_table(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in table(spark, SF, "embeddings").collect()]
    want = brute.neighbours(rows, 50, 5)
    got = {}
    for r in queries.op4_nearest(spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(want)
    recall = np.mean([len(got[q] & {i for i, _ in w}) / len(w) for q, w in want.items()])
    assert recall >= 0.98


def test_estimates_stay_inside_their_bounds():
    rnd = np.random.default_rng(2)
    x, q = rnd.normal(size=(2000, 64)), rnd.normal(size=(20, 64))
    turn = ann.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    code, scale = ann.encode(x, turn)
    signs = np.unpackbits(code, axis=1, count=64) * 2.0 - 1
    unit = q / np.linalg.norm(q, axis=1, keepdims=True)
    estimate = (unit @ turn) @ signs.T / 8 / scale
    exact = unit @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T
    bound = ann.CONFIDENCE * np.sqrt(1 - scale ** 2) / scale / np.sqrt(63)
    assert (np.abs(estimate - exact) <= bound).mean() > 0.99


def test_no_vectors(spark):
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# --- archives ----------------------------------------------------------------------------

def page_rows():
    rows = [(i, f"http://a.example/{i}", f"<p>page {i % 40} é你</p>" * (1 + i % 5)) for i in range(200)]
    rows += [(300, None, None), (301, "http://x/\r\ny", ""), (302, "u", "x" * 300_000), (None, "n", "alone"),
             (None, "n", rows[3][2]), rows[4], rows[4], (303, "v", "\r\n\r\nPK\x05\x06 tricky")]
    return rows


def test_pages_through_archives_and_back(spark):
    rows = page_rows()
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.archived_pages(frame).collect()
    want = brute.pages([(r[0], r[2]) for r in rows])
    assert Counter(map(repr, map(tuple, got))) == Counter(map(repr, want))
    stored = warc.written(frame, archive_bytes=2000)
    assert stored.count() > 3  # many bounded archives
    back = {(r.page_id, r.url): r for r in warc.read(stored, with_payload=True).collect()}
    assert bytes(back[302, "u"].payload) == b"x" * 300_000
    assert back[301, "http://x/%0D%0Ay"].payload_bytes == 0
    assert back[300, None].record_type == "revisit" and back[300, None].refers_to == 301


def test_small_payloads_stay_responses(spark):
    frame = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "yyyy"), (4, "d", "yyyy")],
                                  "page_id long, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.archived_pages(frame, min_bytes=3).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_archives_are_plain_zip_files_and_damage_raises():
    raw = warc.record(5, "http://u", b"body", None, False)
    import gzip
    data = warc.archive([(5, gzip.compress(raw))])
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and set(z.namelist()) == {warc.DATA, warc.INDEX}
        assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
    asked = []

    def fetch(a, n):
        asked.append((a, n))
        return data[a:a + n]

    (fields, block), = warc.records(fetch, len(data))
    assert fields["WARC-Type"] == "response" and block.endswith(b"body")
    with pytest.raises(ValueError):
        warc.central_directory(lambda a, n: b"\0" * n, 100)


def test_zip64_directories(monkeypatch):
    """An archive whose counts and offsets stand in ZIP64 records only."""
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for i in range(5):
            with z.open(zipfile.ZipInfo(f"m{i}"), "w", force_zip64=True) as f:
                f.write(b"payload %d" % i * 3)
        packed = zipfile.ZipInfo("packed")
        packed.compress_type = zipfile.ZIP_DEFLATED
        z.writestr(packed, b"x" * 100)
        z.comment = b"a comment"
    data = out.getvalue()
    assert b"PK\x06\x06" in data
    members = warc.central_directory(lambda a, n: data[a:a + n], len(data))
    assert set(members) == {f"m{i}" for i in range(5)}  # compressed members are no stored members
    for i in range(5):
        at, n = members[f"m{i}"]
        assert data[at:at + n] == b"payload %d" % i * 3


def test_no_pages(spark):
    assert warc.archived_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- classifier --------------------------------------------------------------------------

def test_network_reaches_held_out_accuracy(spark):
    import zlib
    sf = "/root/testdata/sf0.01"
    scored = queries.op7_quality_cnn(spark, sf)
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    rows = scored.collect()
    assert len(rows) == table(spark, sf, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    tested = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in tested]) >= 0.9
    assert np.mean([p for p, y in tested if y == 1]) >= 0.95


def test_whole_texts_are_pooled():
    """A segment at a time gives what one pass over every chunk gives; the end of a text counts."""
    rnd = np.random.default_rng(0)
    net = quality_cnn.Network(rnd.normal(size=(quality_cnn.TAPS, 256, quality_cnn.FILTERS)).astype(np.float32),
                              np.zeros(quality_cnn.FILTERS, np.float32), rnd.normal(size=2 * quality_cnn.FILTERS), 0.1)
    texts = [b"", b"abc", bytes(rnd.integers(0, 256, 70_000, dtype=np.uint8)), b"q" * 511, b"r" * 513, b"z" * 900]
    owner, features = quality_cnn.pooled(texts, net)
    at = 0
    for i, t in enumerate(texts):
        data = quality_cnn._padded(t)
        for s in quality_cnn.chunk_starts(len(data)):
            part = np.frombuffer(data[s:s + quality_cnn.CHUNK], np.uint8)
            want = np.maximum(quality_cnn.convolved(part, net).max(axis=0), 0)
            assert owner[at] == i and np.allclose(features[at], want, atol=1e-5)
            at += 1
    assert at == len(owner)
    a = quality_cnn.probabilities([b"a" * 5000 + b"b" * 10], net)
    b = quality_cnn.probabilities([b"a" * 5010], net)
    assert a != b


def test_classifier_without_usable_labels(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_cnn.quality(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1), (3, None), (None, 0), (4, 0), (4, 1)], "doc_id long, quality int")
    assert all(r.score > 0.99 for r in quality_cnn.quality(docs, one).collect())
    assert quality_cnn.quality(no_docs, none).count() == 0


# --- pipeline ----------------------------------------------------------------------------

def test_stages_hand_on_the_columns_of_documents(spark, docs):
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == names, name


def test_pipeline_runs_over_documents(spark):
    out = entry.queries()["pipeline"](spark, SF).collect()
    ids = {r.doc_id for r in table(spark, SF, "documents").collect()}
    assert out and {r.doc_id for r in out} <= ids
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash", "secret_scan", "mixing", "packing"]


def test_every_operator_is_registered(spark):
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))


def test_native_operators_run_no_python(spark):
    for name in ("op1_secret_scan", "op2_quality_rules", "op5_mixing"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop")), name
