"""Texts of very many matches: positions, redaction and time."""

from __future__ import annotations

import time

import pytest

import brute
from hexvault.llm import secret_scan


def many(n):
    return "é\U0001f600 " + " ".join(f"token=a{i:07d}bcdefQ" for i in range(n))


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, many(100_000), "en", "s"), (2, "plain", "en", "s"), (3, many(3), "en", "t")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(2)


def test_hundred_thousand_matches_are_found_in_time(table):
    begun = time.time()
    got = secret_scan.secret_spans(table).filter("doc_id = 1").first()
    assert time.time() - begun < 60
    want = brute.secrets(many(100_000))
    assert (got.n_assign, got.base_sha256) == (want["n_assign"], want["base_sha256"]) and got.n_assign == 100_000


def test_hundred_thousand_values_are_hidden_in_time(table):
    begun = time.time()
    got = {r.doc_id: r.text for r in secret_scan.redacted(table).collect()}
    assert time.time() - begun < 90
    assert got[1] == "é\U0001f600 " + " ".join(["token=[SECRET]"] * 100_000)
    assert got[2] == "plain" and got[3] == "é\U0001f600 " + " ".join(["token=[SECRET]"] * 3)


def test_overlapping_values_become_one_mark_across_blocks(spark):
    """Values that lie over, beside and across the borders of the blocks of a text."""
    value = "Ab1" + "x9Yz8" * 12
    texts = ["p" * k + f" secret={value}" + " é " + f"api_key: '{value[::-1]}' end" for k in range(2020, 2060)]
    rows = [(i, t, "en", f"s{i}") for i, t in enumerate(texts)] + [(900, f"token={value[:40]}", "en", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.text for r in secret_scan.redacted(docs.filter("doc_id = 0 or doc_id = 900")).collect()}
    assert got[0] == "p" * 2020 + " secret=[SECRET] é api_key: '[SECRET]' end"
    for i in (3, 11, 17, 25, 39):
        alone = secret_scan.redacted(docs.filter(f"doc_id = {i}")).first().text
        assert alone == "p" * (2020 + i) + " secret=[SECRET] é api_key: '[SECRET]' end"


def test_repositories_change_the_verdict(spark, tmp_path):
    """One owner: a value of 2 repositories is live, of 3 undecided, of 4 an example; SQL agrees."""
    import duckdb
    from hexvault.llm.oracles import ORACLES
    value = lambda k: f"Zx{k}" + "q7Rt2Lp9" * 4
    rows = [(10 * k + i, f"see {value(k)} there", f"l{i}", "one", 1) for k in (2, 3, 4) for i in range(k)]
    rows += [(90, f"see {value(4)} there", None, "one", 1), (91, f"see {value(5)} there", None, None, 1)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1) \
        .write.parquet(path)
    got = {r.doc_id: (r.n_live, r.n_example) for r in secret_scan.secret_spans(spark.read.parquet(path)).collect()}
    assert [got[i] for i in (20, 21, 30, 31, 32, 40, 43, 90, 91)] == [
        (1, 0), (1, 0), (0, 0), (0, 0), (0, 0), (0, 1), (0, 1), (0, 1), (1, 0)]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = con.execute(f"SELECT doc_id, n_live, n_example FROM ({ORACLES['op1_secret_scan']})").fetchall()
    assert got == {i: (a, b) for i, a, b in want}
