"""Repeated byte strings: prefix-free parsing against counting every string."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hexvault.llm import suffix_dedup as S


def bag(rows):
    return Counter(map(repr, rows))


def removed(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) by counting every string."""
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_equals_counting_every_string(docs, doc_rows):
    got = S.deduplicated(docs).collect()
    want = removed([r[:2] for r in doc_rows], 200)
    assert bag(map(tuple, got)) == bag(want)
    assert any(x[2] for x in want) and any(not x[2] for x in want)


@pytest.mark.parametrize("hot", [0, 10**9])
def test_short_strings_of_few_letters_gathered_or_by_hash(spark, hot):
    """Runs, periods, overlaps, multibyte characters cut in the middle, common phrases with many contexts."""
    rnd = random.Random(3)
    phrase = "".join(rnd.choice("abé") for _ in range(60))
    rows = [(i, "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 90)))) for i in range(60)]
    rows += [(100 + i, f"{i:03d}" * rnd.randint(0, 9) + phrase[rnd.randint(0, 20):rnd.randint(30, 60)] + f"{i:03d}"[::-1] * 4)
             for i in range(60)]
    rows += [(200, "a" * 500), (201, "ab" * 300), (202, "é" * 40), (203, "xé" * 40 + "é"), (None, phrase),
             (None, None), (204, None), (205, ""), (206, phrase), (206, phrase), (207, "q" * 23), (208, "z" * 24)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = S.deduplicated(table, length=24, span=9, hot=hot, with_kept=True).collect()
    assert bag(tuple(r)[:5] for r in got) == bag(removed(rows, 24))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_no_rows_and_clashing_columns(spark, no_docs):
    assert S.deduplicated(no_docs).collect() == []
    rows = [(f"d{i}", "same text here " * 20, 1, "k", 5) for i in range(3)]
    table = spark.createDataFrame(rows, "name string, body string, key int, marks string, context int")
    got = S.deduplicated(table, text="body", id_col="name", length=100, span=40).collect()
    assert [r.n_removed for r in got] == [300] * 3 and {r.doc_id for r in got} == {"d0", "d1", "d2"}


def test_triggers_depend_on_the_bytes_around_them_only():
    rnd = random.Random(5)
    middle = bytes(rnd.randrange(256) for _ in range(900))
    def keys(before, after):
        text = before + middle + after
        raw = np.frombuffer(text, np.uint8)
        _, trigger, *_ = S.parsed(raw, np.array([len(raw)]), np.zeros(len(raw), np.int64), 200, 96)
        return {t - len(before) for t in trigger.tolist() if 96 <= t - len(before) < 900 - 200}
    assert keys(b"x" * 77, b"") == keys(bytes(rnd.randrange(256) for _ in range(401)), b"tail" * 100) != set()


def test_pieces_hold_every_string_once(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 50)
    texts = [b"a" * 7, b"", bytes(range(200)), b"b" * 61, b"c" * 9]
    found = Counter()
    for raw, ends, doc, rows, offsets in S.pieces(texts, 10):
        assert len(raw) < 50 + 59
        begin = [0, *ends.tolist()]
        for k, (row, offset) in enumerate(zip(rows, offsets)):
            part = raw[begin[k]:begin[k + 1]].tobytes()
            assert part == texts[row][offset:offset + len(part)]
            found.update((row, offset + x) for x in range(len(part) - 9))
    assert found == Counter((r, x) for r, t in enumerate(texts) for x in range(len(t) - 9))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab\0", max_size=9).map(str.encode), min_size=1, unique=True))
def test_suffix_array_of_the_dictionary(tails):
    tails = sorted(tails)
    rank, start = S.suffix_ranks(tails)
    suffixes = [(int(rank[start[i] + k]), t[k:]) for i, t in enumerate(tails) for k in range(len(t) + 1)]
    order = {s: i for i, s in enumerate(sorted({s for _, s in suffixes}))}
    assert [r for r, _ in suffixes] == [order[s] for _, s in suffixes]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab\0", max_size=9).map(str.encode), min_size=1, unique=True))
def test_common_prefixes_of_the_parse(strings):
    ordered = sorted(strings)
    want = [0] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                  for a, b in zip(ordered, ordered[1:])]
    assert S.common_prefixes(ordered).tolist() == want
