"""Operators on documents against plain Python, over awkward rows."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from hexvault.llm import mixing, packing, pii, quality_rules, secret_scan, simhash, substring_dedup
from hexvault.llm.queries import vocabulary_files


def bag(rows):
    return Counter(map(repr, rows))


def test_secret_scan_base_spans_match_plain_regexes(docs, doc_rows):
    got = secret_scan.secret_spans(docs).collect()
    want = [(r[0], *list(brute.secrets(r[1]).values())[:4]) for r in doc_rows]
    assert bag((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == bag(want)


def test_secret_scan_ownership_separates_copied_from_live(docs, doc_rows):
    got = {r.doc_id: r for r in secret_scan.secret_spans(docs).collect()}
    text = {r[0]: r[1] for r in doc_rows}
    # The same token stands with all three owners: an example, its base spans stay.
    shared = got[0]
    assert shared.n_example >= 1 and "assign:" in shared.spans and "hex:" in shared.spans
    value = "3f9a0c5bd1e27788aa00bb11cc22dd33ee44ff55"
    at = text[0].index(value)
    assert f"example:{at}:{at + len(value)}" in shared.spans.split(",")
    # A long run of its own is live.
    own = next(x for x in text[11].split() if x.startswith("a011"))
    at = text[11].index(own)
    assert f"live:{at}:{at + len(own)}" in got[11].spans.split(",")
    for r in got.values():
        every = r.spans.split(",") if r.spans else []
        starts = [int(x.split(":")[1]) for x in every]
        assert starts == sorted(starts)
        assert set(brute.secrets(text[r.doc_id])["base"]) <= set(every) or r.doc_id is None


def test_redaction_hides_own_secrets_and_keeps_examples_and_rows(docs, doc_rows):
    out = secret_scan.redacted(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in doc_rows)
    by = {r.doc_id: r for r in rows}
    assert "[SECRET]" in by[11].text and "hunter20011" not in by[11].text
    assert "3f9a0c5bd1e27788aa00bb11cc22dd33ee44ff55" in by[10].text
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    plain = next(r[1] for r in doc_rows if r[0] == 2)
    assert by[2].text == plain


def test_quality_rules_statistics_and_verdicts(docs, doc_rows, monkeypatch):
    monkeypatch.setattr(quality_rules, "MIN_LINE_DOCUMENTS", 5)
    got = quality_rules.verdicts(docs).collect()
    kept = brute.quality_kept([(r[3], r[1]) for r in doc_rows], 5, quality_rules.MAX_LINE_SHARE,
                              quality_rules.MIN_LEFT_SHARE)
    want = [(r[0], *brute.word_stats(r[1]).values(), k) for r, k in zip(doc_rows, kept)]
    assert bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed, r.kept) for r in got) == bag(want)
    assert sum(r.n_removed_lines for r in got) > 10


def test_quality_cleaning_takes_out_boilerplate_lines(docs, doc_rows, monkeypatch):
    monkeypatch.setattr(quality_rules, "MIN_LINE_DOCUMENTS", 5)
    out = quality_rules.cleaned(docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    # Every third document has the line and a host of its own: only there it is frequent.
    assert "INVENTED" not in rows[3].text and rows[3].n_chars == len(rows[3].text)
    assert rows[1].text == doc_rows[1][1]
    assert 203 not in rows and 204 not in rows and 207 not in rows


def test_quality_rules_remove_lines_of_large_and_small_hosts(spark):
    """A line in 4 % of a hot host goes, one in 2 % of it stays; a footer of all eight documents goes."""
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    often, seldom, footer = "Share   this PAGE with all your friends", "a line of sixty documents", "small footer"
    rows = [(i, own(i) + (f"\n{often}" if i % 25 == 0 else "") + (f"\n{seldom}" if i % 50 == 1 else ""), "hot")
            for i in range(3000)]
    rows += [(4000 + i, f"{own(i)}\n{footer}", "small") for i in range(8)]
    rows += [(5000 + i, f"{own(i)}\n{footer}", "tiny") for i in range(4)]
    got = {r.doc_id: r for r in quality_rules.verdicts(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    removed = {i for i, r in got.items() if r.n_removed_lines}
    assert removed == {*range(0, 3000, 25), *range(4000, 4008)}
    assert all(r.kept for r in got.values())  # enough is left of each


def test_simhash_matches_pairwise_components(docs, doc_rows):
    got = simhash.components(docs).collect()
    prints = [brute.fingerprint(r[1]) for r in doc_rows]
    comp = brute.components([r[0] for r in doc_rows], prints)
    want = [(r[0], f"{p:016x}", c) for r, p, c in zip(doc_rows, prints, comp)]
    assert bag(map(tuple, got)) == bag(want)


@pytest.mark.parametrize("parts", [2, 3, 4])
def test_simhash_links_lose_no_pair_of_a_dense_group(spark, parts):
    """Hundreds of fingerprints around one, beside random ones, at every way to cut the bits."""
    rnd = np.random.default_rng(parts)
    base = int(rnd.integers(1 << 62))
    fps = {base}
    for _ in range(300):
        x = base
        for b in rnd.integers(0, 24, rnd.integers(1, 6)):
            x ^= 1 << int(b)
        fps.add(x)
    fps |= {int(x) for x in rnd.integers(-(1 << 63), (1 << 63) - 1, 300)}
    near = sorted(fps)[0]
    fps |= {near ^ 0b111, near ^ 0b1111 << 30}
    ordered = sorted(fps)
    frame = spark.createDataFrame([(x,) for x in ordered], "fp long")
    edges = simhash.links(frame, 3, parts, block=64).collect()
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 64 for a, b in edges)
    linked = brute.components(ordered, [x & (1 << 64) - 1 for x in ordered])
    from hexvault.llm.components import connected_components
    got = {r.node: r.root for r in connected_components(simhash.links(frame, 3, parts, block=64)).collect()}
    assert {x: got.get(x, x) for x in ordered} == dict(zip(ordered, linked))
    assert len(edges) < 4 * len(ordered) * parts  # a forest a bucket, not all pairs


def test_threshold_allocation_is_the_cheapest():
    rnd = np.random.default_rng(1)
    cost = np.zeros((3, 5, 20))
    cost[:, 1:] = np.cumsum(rnd.random((3, 4, 20)), axis=1)
    from itertools import product
    got = simhash.allocate(cost, 1)
    assert (got.sum(axis=0) == 1).all()
    for n in range(20):
        price = lambda t: sum(cost[p, x + 1, n] for p, x in enumerate(t))
        best = min(price(t) for t in product(range(-1, 4), repeat=3) if sum(t) == 1)
        assert price(got[:, n]) == pytest.approx(best)


def test_representatives_keep_one_row_of_each_group(docs, doc_rows):
    out = simhash.representatives(docs)
    assert out.columns == docs.columns
    prints = [brute.fingerprint(r[1]) for r in doc_rows]
    comp = brute.components(list(range(len(doc_rows))), prints)
    groups = defaultdict(list)
    for c, r in zip(comp, doc_rows):
        groups[c].append(r[0])
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    assert Counter(r.doc_id for r in out.collect()) == Counter(map(least, groups.values()))


def test_substring_dedup_matches_plain_windows(docs, doc_rows):
    got = substring_dedup.deduplicated(docs).collect()
    assert bag(map(tuple, got)) == bag(brute.substrings([(r[0], r[1]) for r in doc_rows]))
    assert sum(r.n_removed for r in got) > 500


def test_substring_dedup_across_flushes_and_a_full_sketch(docs, doc_rows, monkeypatch):
    """Many flushes of a task, and a sketch so narrow that everything is estimated repeated."""
    want = bag(brute.substrings([(r[0], r[1]) for r in doc_rows]))
    one = docs.coalesce(1)
    rows = one.select(F.coalesce("doc_id", F.lit(substring_dedup.NO_ID)).alias("id"),
                      substring_dedup.text_bits("text").alias("text_key"), "text")
    full = [(d, s, substring_dedup.pa.compress(b"\xff" * (1 << 17), codec="zstd", asbytes=True))
            for d in range(2) for s in range(1 << 9)]
    assert substring_dedup.flagged_windows(rows, full, 20).count() > 10_000
    monkeypatch.setattr(substring_dedup, "merged_sketch", lambda partials: full)
    assert bag(map(tuple, substring_dedup.deduplicated(docs).collect())) == want


@pytest.mark.parametrize("tasks", [1, 2, 5])
def test_substring_dedup_of_texts_that_share_an_id(spark, tasks):
    """Texts of one id (or of none) that tie for the earliest start go, or stay, together."""
    passage = " ".join(f"p{i}" for i in range(25))
    second = " ".join(f"q{i}" for i in range(30))
    # The earliest start of a passage is in a task of its own, behind and before the tied texts.
    rows = [(9, f"{second} tail{i}") for i in range(40)] + [(None, f"x {passage} end{i}") for i in range(40)]
    rows += [(4, second), (None, passage), (None, f"x {passage} end3"), (9, f"{second} tail5")]
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, tasks), "doc_id long, text string")
    got = substring_dedup.deduplicated(frame)
    assert bag(map(tuple, got.collect())) == bag(brute.substrings(rows))
    keyed = frame.select(F.coalesce("doc_id", F.lit(substring_dedup.NO_ID)).alias("id"),
                         substring_dedup.text_bits("text").alias("text_key"), "text")
    marks = substring_dedup.repeats(keyed, 20).collect()
    assert len(marks) == 80 and max(len(r.marks) for r in marks) <= 11 * tasks  # a row a text


def test_mixing_meets_entropy_limit_and_budget(docs, doc_rows):
    rows = mixing.measured(docs)
    sizes = Counter()
    for r in doc_rows:
        sizes[r[3]] += len(brute.WORD.findall(r[1] or "")) + 1
    total = sum(sizes.values())

    def weights(a):
        raw = {s: (n / total) ** a for s, n in sizes.items()}
        return {s: x / sum(raw.values()) for s, x in raw.items()}

    def entropy(a):
        return -sum(w * np.log(w) for w in weights(a).values())

    got = mixing.schedule(rows, entropy_share=0.9, budget="corpus", block_tokens=500).collect()
    a = got[0].exponent
    assert entropy(a) >= 0.9 * np.log(len(sizes)) - 1e-9 > entropy(a + 2e-7) - 1e-9
    spent, readings = Counter(), Counter()
    for r in got:
        assert r.weight == pytest.approx(weights(a)[r.source])
        spent[r.source] += r.tokens
        readings[r.row, r.epoch] += 1
    assert max(readings.values()) == 1  # a permutation reads a document once an epoch
    longest = max(len(brute.WORD.findall(r[1] or "")) + 1 for r in doc_rows)
    for s, n in spent.items():
        assert abs(n - total * weights(a)[s]) <= longest
    # Every full epoch holds the whole source.
    last = Counter()
    for r in got:
        last[r.source] = max(last[r.source], r.epoch)
    n_rows = Counter(r[3] for r in doc_rows)
    for s, e in last.items():
        for k in range(e):
            assert sum(1 for r in got if r.source == s and r.epoch == k) == n_rows[s]


def test_mixing_repetition_limit_and_cover(docs, doc_rows):
    got = mixing.schedule(mixing.measured(docs), max_repeats=2.0, budget="cover", block_tokens=500).collect()
    times = Counter(r.row for r in got)
    assert len(times) == len(doc_rows) and max(times.values()) <= 2
    out = mixing.mixed(docs, max_repeats=2.0, budget="cover")
    assert out.columns == docs.columns
    assert {repr(r.doc_id) for r in out.collect()} == {repr(r[0]) for r in doc_rows}


def test_packing_is_an_exact_partition_of_all_tokens(docs, doc_rows):
    from tokenizers import Tokenizer
    files = vocabulary_files()
    tokenizer = Tokenizer.from_file(files[0])
    got = packing.pack(docs, files, group=16, with_ids=True).collect()
    ids = [tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in doc_rows]
    want = Counter()
    for r, x in zip(doc_rows, ids):
        want[r[0], len(x), brute.crc(x[:2048])] += 1
    lengths = defaultdict(int)
    sequences = defaultdict(list)
    for r in got:
        lengths[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        options = [x for d, x in zip(doc_rows, ids) if d[0] == r.doc_id and len(x) == r.doc_tokens]
        part = [x[r.start:r.start + r.length] for x in options]
        assert r.ids_crc32 in [brute.crc(p) for p in part]
        assert r.ids is None or list(r.ids) in part
    total = Counter()
    for d, x in zip(doc_rows, ids):
        total[d[0]] += len(x)
    assert lengths == dict(total)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    # Each group of 16 rests wastes less than one sequence.
    assert len(sequences) * 2048 - sum(total.values()) < 2048 * (len(doc_rows) // 16 + 4)


def test_packed_ids_hold_the_whole_documents(spark):
    """Documents of several full pieces, and one without a rest."""
    from tokenizers import Tokenizer
    files = vocabulary_files()
    tokenizer = Tokenizer.from_file(files[0])
    texts = {1: " ".join(f"word{i}" for i in range(4000)), 2: "short one", 3: "a b c d " * 16 + "z " * 900, 4: None}
    want = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for k, t in texts.items()}
    capacity = len(want[3])  # exactly one full piece
    assert len(want[1]) > 5 * capacity
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for size in (capacity, 2048):
        parts = defaultdict(list)
        for r in packing.pack(frame, files, capacity=size, with_ids=True).collect():
            assert r.ids is not None and len(r.ids) == r.length and r.ids_crc32 == brute.crc(list(r.ids))
            parts[r.doc_id].append((r.start, list(r.ids)))
        assert {k: [x for _, p in sorted(v) for x in p] for k, v in parts.items()} == want
    assert "ids" not in packing.pack(frame, files).columns


def test_packing_assignment_is_balanced_and_full():
    lengths = np.random.default_rng(3).integers(1, 2048, 500)
    placed = packing.assign(lengths, 2048)
    back = Counter()
    for which, start, size, _, _ in placed:
        back[which] += size
    assert [back[i] for i in range(500)] == lengths.tolist()
    assert len({p[3] for p in placed}) == -(-int(lengths.sum()) // 2048)


def test_encoder_equals_the_tokenizer_file():
    from tokenizers import Tokenizer
    files = vocabulary_files()
    tokenizer, enc = Tokenizer.from_file(files[0]), packing.encoder(files)
    for text in ["", " ", "  two  spaces\n\n\tend ", "don't we'll éè 你好 12345 a_b \U0001f600​",
                 "x<|endoftext|>y  ", "\r\n a b　c", "²½Ⅷ ٠", "a" * 5000]:
        assert enc.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_personal_data_base_spans_match_plain_regexes(docs, doc_rows):
    got = pii.personal_data(docs).collect()
    want = [(r[0], *list(brute.personal(r[1]).values())[:5]) for r in doc_rows]
    assert bag(tuple(r)[:6] for r in got) == bag(want)


@pytest.mark.parametrize("text,kind,found", [
    ("write to jоhn.doe@exаmple.com now", "email", "jоhn.doe@exаmple.com"),
    ("john [at] example [dot] com", "email", "john [at] example [dot] com"),
    ("see john at example dot com, please", "email", "john at example dot com"),
    ("a.b(at)mail.example(dot)org.", "email", "a.b(at)mail.example(dot)org"),
    ("jo​hn@ex.com", "email", "jo​hn@ex.com"),
    ("john@example dot com", "email", "john@example dot com"),
    ("plus one four one five five five five zero one zero zero", "phone",
     "plus one four one five five five five zero one zero zero"),
    ("＋1 (415) 555-0100", "phone", "＋1 (415) 555-0100"),
    ("four one one one 1111 1111 1111", "card", "four one one one 1111 1111 1111"),
    ("4111\u00a01111\u00a01111\u00a01111", "card", "4111\u00a01111\u00a01111\u00a01111"),
    ("+1\u2011415\u2011555\u20110100", "phone", "+1\u2011415\u2011555\u20110100"),
    ("\u0661\u0669\u0662.168.1.\u0661", "ip", "\u0661\u0669\u0662.168.1.\u0661"),
    ("at one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one")])
def test_disguises_map_back_to_the_source(text, kind, found):
    _, every = pii.spans("é\U0001f600 " + text)
    at = ("é\U0001f600 " + text).index(found)
    assert (at, at + len(found)) in every[pii.KINDS.index(kind)]


@pytest.mark.parametrize("text,kind,found", [
    ("server one dot two dot three dot four", "ip", "one dot two dot three dot four"),
    ("10 dot zero dot zero dot five", "ip", "10 dot zero dot zero dot five"),
    ("10 point Zero point 0 point 7", "ip", "10 point Zero point 0 point 7"),
    ("john at example\u2024com", "email", "john at example\u2024com"),
    ("john_at_example\uff0ecom", "email", "john_at_example\uff0ecom"),
    ("\u017fix one two plus one four one five five five five zero one zero zero", "phone",
     "plus one four one five five five five zero one zero zero")])
def test_disguises_open_their_own_gate(text, kind, found):
    """Nothing else in the text calls for the transducer."""
    _, every = pii.spans(text)
    at = text.index(found)
    assert (at, at + len(found)) in every[pii.KINDS.index(kind)]


def test_gates_let_through_all_that_a_transducer_rewrites():
    rnd = np.random.default_rng(9)
    parts = ["one", "Two", "nine", "zero", "plus", "dot", "point", "at", "AT", "john", "example", "com", "7", "10",
             "\u2024", "\uff0e", "\u043e", "\u017f", "[", "]", "(at)", "@", "."]
    seen = 0
    for _ in range(20_000):
        text = "".join(parts[rnd.integers(len(parts))] + [" ", " ", "", "_", "-", "  "][rnd.integers(6)]
                       for _ in range(rnd.integers(3, 10)))
        whole = pii.plain_marks(pii.plain_digits(pii.plain_letters(pii.Mapped(text))))
        got = pii.deobfuscated(text)
        assert (text if got is None else got.text) == whole.text, text
        seen += got is not None
    assert 2_000 < seen < 20_000


@pytest.mark.parametrize("text", [
    "look at the dot on it", "meet me at example.com", "one two three of them", "plus one more", "",
    "the number nine (at) noon", "dot dot dot at one", "дом и сад"])
def test_plain_prose_gains_no_spans(text):
    base, every = pii.spans(text)
    assert base == every == [[], [], [], []]


def test_masking_replaces_identifiers(docs):
    out = pii.masked(docs)
    assert out.columns == docs.columns
    assert "[EMAIL]" in out.filter("doc_id = 10").first().text


def test_empty_tables(no_docs):
    assert secret_scan.secret_spans(no_docs).count() == 0
    assert secret_scan.redacted(no_docs).count() == 0
    assert quality_rules.verdicts(no_docs).count() == 0
    assert quality_rules.cleaned(no_docs).count() == 0
    assert simhash.components(no_docs).count() == 0
    assert simhash.representatives(no_docs).count() == 0
    assert mixing.mixture(no_docs, entropy_share=0.9).count() == 0
    assert substring_dedup.deduplicated(no_docs).count() == 0
    assert packing.pack(no_docs, vocabulary_files()).count() == 0
    assert pii.personal_data(no_docs).count() == 0
