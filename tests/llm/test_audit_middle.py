"""Filter audit and fill-in-middle against plain Python, over awkward rows."""

from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from hexvault.llm import fill_middle, filter_audit


def bag(rows):
    return Counter(map(repr, rows))


# --- filter audit ------------------------------------------------------------------------

LABELS = [(i, int(i % 2 == 0), int(i % 5 == 0), "clash") for i in range(0, 210, 3)] + [
    (3, 1, None, "x"), (3, 1, 0, "x"), (None, 1, 1, "x"), (200, None, None, "x")]


def audit_rows(doc_rows):
    """More awkward rows for the filters: capitals, symbols, distinct words, an empty language."""
    words = " ".join(f"w{i}" for i in range(120))
    return [*doc_rows,
            *[(i, t, lang, "s", 1, "c", 7, "c") for i, t, lang in (
                (300, words, ""), (301, words, None), (302, words, "de"), (299, words, "de"),
                (303, words.upper() + " #", "de"), (304, "ABCDEFGHIJ", "de"), (305, "Abcdefghij", "de"),
                (306, words + " w1" * 30, "fr"), (307, words + " w1" * 29, "fr"), (308, "é" * 9 + "A", "fr"),
                (309, " ".join(["x"] * 200), "fr"), (302, words, "de"), (None, words, "de"))]]


def audited(rows, labels):
    def fails(r):
        t = r[1] or ""
        words = brute.WORD.findall(t)
        same = [x[0] for x in rows if (x[1] or "") == t and x[0] is not None]
        return {k for k, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", t)) > 10 * len(t), re.search(r"[#$%&*|]", t) is not None,
            r[0] is not None and any(x < r[0] for x in same))) if bad}

    good = {x[0] for x in labels if x[1] == 1 and x[0] is not None}
    toxic = {x[0] for x in labels if x[2] == 1 and x[0] is not None}
    items = [(r[2] or "", fails(r), r[0] in good, r[0] in toxic) for r in rows]
    out = []
    for part in {x[0] for x in items}:
        mine, shapley = [x for x in items if x[0] == part], Counter()
        found = []
        for order in permutations("ABCDE"):
            alive = mine
            for k, f in enumerate(order):
                gone = [x for x in alive if f in x[1]]
                alive = [x for x in alive if f not in x[1]]
                shapley[f] += len(gone)
                found.append([part, "".join(order), k + 1, len(alive), len(gone),
                              sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine),
                              sum(x[2] for x in gone), sum(x[3] for x in gone)])
        out += [(*x, shapley[x[1][x[2] - 1]]) for x in found]
    return out


def test_filter_audit_equals_running_all_orders(spark, docs, doc_rows):
    rows = audit_rows(doc_rows)
    table = spark.createDataFrame(rows, docs.schema).repartition(5)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int, row string")
    got = filter_audit.interactions(table, labels).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley").collect()
    assert bag(map(tuple, got)) == bag(audited(rows, LABELS))


def test_filter_audit_without_labels_and_rows(spark, docs, doc_rows, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.interactions(no_docs, labels).collect() == []
    got = filter_audit.interactions(docs, labels)
    assert got.filter("good_lost > 0 or toxic_lost > 0").count() == 0
    assert got.count() == 600 * docs.select(F.coalesce("lang", F.lit(""))).distinct().count()


def test_filter_audit_joins_inside_buckets(docs, spark):
    """No join of the split shuffles: the id tables are bucketed by row."""
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int, row string")
    whole, fails, buckets = filter_audit.relations(docs, labels)
    plan = filter_audit.split(whole, fails, buckets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and "Cartesian" not in plan


# --- fill-in-middle ----------------------------------------------------------------------

def middled(doc_id, text, seed=1):
    t = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    h = [int(brute.sha(f"{seed}:{'' if doc_id is None else doc_id}")[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(tokens), "plain", None, None, t, t
    if h[3] % 100 < 20:
        return doc_id, len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", t
    return doc_id, len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", t


def test_fill_in_middle_equals_plain_python_and_restores(spark, docs, doc_rows):
    odd = ["<", "<P", "a<P>b", "<S>", "x<M>", "<<S<P<M>>", "é", "a\U0001f600b ñ<", "\n\r\n\0  ", "ab" * 50_000 + "ß" * 7,
           "\U0001f600" * 3000, "A<P   <S", "zß水𝄋" * 400]
    rows = [*doc_rows, *[(400 + 50 * k + i, t, "en", "s", 1, "c", 7, "c") for i, t in enumerate(odd) for k in range(12)]]
    out = fill_middle.fill_in_middle(spark.createDataFrame(rows, docs.schema).repartition(3))
    got = out.withColumn("restored", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    want = [middled(r[0], r[1]) for r in rows]
    assert bag(map(tuple, got)) == bag(want)
    assert {x[2] for x in want} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_no_rows(no_docs):
    assert fill_middle.fill_in_middle(no_docs).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZ <é水𝄋́\n"), max_size=60))
def test_exception_index_is_exact_both_ways(text):
    data = text.encode()
    index = fill_middle.ExceptionIndex(np.frombuffer(data, np.uint8))
    points = np.arange(len(text) + 1)
    want = np.array([len(text[:k].encode()) for k in points])
    assert index.points == len(text)
    assert (index.to_bytes(points) == want).all() and (index.to_points(want) == points).all()
    assert len(index.at_byte) == sum(ord(c) > 127 for c in text)
    tokens = [m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
    assert fill_middle.token_starts(np.frombuffer(data, np.uint8)).tolist() == want[tokens].tolist()


@pytest.mark.parametrize("seed", [1, 2])
def test_seed_changes_the_draws(seed):
    assert fill_middle.draws(7, seed) != fill_middle.draws(7, seed + 1)
