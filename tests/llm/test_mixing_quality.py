"""Mixing against a plain solver and scheduler; quality rules against their SQL on planted tables."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import duckdb
import pytest

import brute
from hexvault.llm import mixing, quality_rules
from hexvault.llm.oracles import ORACLES
from hexvault.llm.queries import QUERIES


def solved(sizes, entropy_share, max_repeats):
    """Exponent by plain bisection, for a budget of the corpus."""
    total = sum(sizes)
    p = [s / total for s in sizes]
    def weights(a):
        z = sum(x ** a for x in p)
        return [x ** a / z for x in p]
    entropy = lambda a: -sum(w * math.log(w) for w in weights(a) if w)
    repeats = lambda a: max(w * total / s for w, s in zip(weights(a), sizes))
    lo, hi = 0.0, 256.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if entropy(mid) >= entropy_share * math.log(len(p)) else (lo, mid)
    a = lo
    if repeats(a) > max_repeats:
        near, far = 1.0, a
        for _ in range(80):
            mid = (near + far) / 2
            near, far = (mid, far) if repeats(mid) <= max_repeats else (near, mid)
        a = near
    return a, weights(a)


SIZES = [900, 500, 400, 300, 250, 120, 60]


def rows_of(sizes):
    return [(100 * k + i, " ".join(["w"] * 9), f"s{k}") for k, s in enumerate(sizes) for i in range(s // 10)]


@pytest.mark.parametrize("entropy_share, max_repeats, above", [(0.97, 9.0, False), (0.8, 9.0, True), (0.6, 9.0, True),
                                                              (0.98, 1.5, False), (0.6, 1.3, True)])
def test_weights_and_quotas_equal_a_plain_solver(spark, entropy_share, max_repeats, above):
    docs = spark.createDataFrame(rows_of(SIZES), "doc_id long, text string, source string").repartition(4)
    got = mixing.mixture(docs, entropy_share=entropy_share, max_repeats=max_repeats, budget="corpus",
                         block_tokens=50).collect()
    a, weights = solved(SIZES, entropy_share, max_repeats)
    assert (a > 1) == above and got[0].exponent == pytest.approx(a, abs=1e-4)
    spent, blocks = Counter(), defaultdict(set)
    for r in got:
        spent[r.source] += r.n_tokens
        blocks[r.source].add(r.block)
        assert r.weight == pytest.approx(weights[int(r.source[1:])], abs=1e-4)
    for k, w in enumerate(weights):
        quota = round(w * sum(SIZES))
        assert quota <= spent[f"s{k}"] < quota + 11 and spent[f"s{k}"] <= max_repeats * SIZES[k] + 11
    assert len(blocks["s0"]) > 5


def test_equal_sources_keep_their_shares(spark):
    docs = spark.createDataFrame(rows_of([200, 200, 200]), "doc_id long, text string, source string")
    assert {r.exponent for r in mixing.mixture(docs, entropy_share=0.5, budget="corpus").collect()} == {1.0}


def test_registered_mixing_goes_through_its_method(spark):
    got = QUERIES["op5_mixing"](spark, "/root/testdata/sf0.01").collect()
    assert abs(got[0].exponent - 1) > 0.01 and {0, 1} <= {r.epoch for r in got}
    epochs = defaultdict(list)
    for r in got:
        epochs[r.source, r.epoch].append((r.position, r.block, r.doc_id))
    assert max(len({b for _, b, _ in x}) for x in epochs.values()) > 2
    orders = []
    for (source, epoch), readings in epochs.items():
        readings.sort()
        order = [b for i, (_, b, _) in enumerate(readings) if not i or readings[i - 1][1] != b]
        assert len(order) == len(set(order)), "an epoch reads each block once, in one piece"
        assert len({d for *_, d in readings}) == len(readings)
        orders.append((source, epoch, tuple(order)))
    first = {s: o for s, e, o in orders if e == 0}
    again = [(s, o) for s, e, o in orders if e == 1]
    assert any(o != first[s][:len(o)] for s, o in again), "every epoch has an order of its own"


@pytest.mark.parametrize("documents, planted", [(1500, 150), (300, 25), (12, 8), (12, 5), (1500, 90)])
def test_quality_sql_states_all_three_rules(spark, tmp_path, documents, planted):
    """150 of 1500 pass only the rule of many documents, 8 of 12 only that of small hosts."""
    footer = "the same footer stands below all of these texts and is long enough to matter here"
    rows = [(i, f"number {i} has {' '.join(f'w{i}x{k}' for k in range(4 if i % 2 else 14))}"
             + (f"\n{footer}" if i < planted else ""), "en", "host", 1) for i in range(documents)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1) \
        .write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    cur = con.execute(ORACLES["op2_quality_rules"])
    names = [d[0] for d in cur.description]
    got = quality_rules.verdicts(spark.read.parquet(path)).select(*names).collect()
    want = cur.fetchall()
    assert Counter(map(tuple, got)) == Counter(want)
    share = planted / documents
    removed = planted > 100 or (planted > 20 and share > 0.1) or (planted > 5 and share > 0.5)
    assert sum(r.n_removed_lines for r in got) == (planted if removed else 0)
    assert brute.word_stats(rows[0][1])["n_words"] == next(r.n_words for r in got if r.doc_id == 0)
