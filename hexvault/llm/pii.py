"""Personal data, with offset-preserving deobfuscation.

The base detectors find plain identifiers. Three transducers then rewrite disguises:
homoglyphs and invisible characters, spelled digits, and at/dot words or brackets.
Every character of a rewritten text knows the source span it came from, so an
identifier found there maps back to source offsets. Identifiers that hold something
rewritten are added, unless a base span of the kind covers them already.

Spelled digits and sign words are those of English, French, German and Spanish. An
address has a local part of at most 64 and labels of at most 63 characters, as mail
allows; runs of blanks and zeros have any length.

Defined cases: a null or empty text has no spans; repeated rows give one output row
each; a null id stays null; an empty table gives no rows; other columns are ignored.
All detectors run in time linear in the text.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# --- base detectors (fixed patterns) -----------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match always begins at the start of a run of digits, so the lookbehind changes nothing
# but the cost of long runs.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping matches, found from their at signs."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        if at >= free:
            run = text[free:at]
            start = free + len(run.rstrip(_LOCAL))
            domain = _DOMAIN.match(text, at + 1) if start < at else None
            # The local part cannot hold an at sign, so none is looked at twice.
            free = domain.end() if domain else at + 1
            if domain:
                out.append((start, free))
        at = text.find("@", at + 1)
    return out


def ips(text: str) -> list[Span]:
    def small(part: str) -> bool:
        digits = part.lstrip("0")  # a part may hold any number of zeros
        return len(digits) <= 3 and int(digits or "0") <= 255

    return [m.span() for m in _IP.finditer(text) if all(map(small, m.groups()))]


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(map(m.group().count, "0123456789")) <= 15]


DETECT = (emails, ips, cards, phones)


def detected(text: str) -> list[list[Span]]:
    """Spans of each kind."""
    digits = _DIGIT.search(text) is not None
    return [emails(text) if "@" in text else [], ips(text) if digits else [], cards(text) if digits else [],
            phones(text) if digits and "+" in text else []]


# --- transducers -------------------------------------------------------------------------

class Mapped:
    """A rewritten text: for each character its source span, and whether it was rewritten."""

    def __init__(self, text: str, starts=None, ends=None, changed=None):
        self.text = text
        self.starts = range(len(text)) if starts is None else starts
        self.ends = range(1, len(text) + 1) if ends is None else ends
        self.changed = changed

    def rewritten(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Apply ordered, disjoint ``(start, end, replacement)`` edits; a removal marks what follows it."""
        if not edits:
            return self
        text, starts, ends, changed, at, mark = [], [], [], [], 0, False

        def copy(a, b):
            nonlocal mark
            if a < b:
                text.append(self.text[a:b])
                starts.extend(self.starts[a:b])
                ends.extend(self.ends[a:b])
                flags = [False] * (b - a) if self.changed is None else list(self.changed[a:b])
                flags[0] = flags[0] or mark
                changed.extend(flags)
                mark = False

        for a, b, new in edits:
            copy(at, a)
            for c in new:
                text.append(c)
                starts.append(self.starts[a])
                ends.append(self.ends[b - 1])
                changed.append(True)
            mark = not new or mark
            at = b
        copy(at, len(self.text))
        return Mapped("".join(text), starts, ends, changed)


#: Letters that look like Latin ones (fixed values).
LOOKALIKES = dict(zip(
    "аеорсухіјѕԁһԛԝкмтвнАВЕКМНОРСТУХІЈЅ" "αονρτικυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ı" "﹫。․",
    "aeopcyxijsdhqwkmtbhABEKMHOPCTYXIJS" "aovptikuxABEZHIKMNOPTYX" "i" "@..", strict=True))
#: Blanks and dashes that stand for the plain ones (fixed values).
LOOKALIKES |= dict.fromkeys("\u00a0\u2007\u2009\u202f", " ") | dict.fromkeys(
    "\u2010\u2011\u2012\u2013\u2212", "-")
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
_ODD = re.compile(f"[{''.join(LOOKALIKES)}{INVISIBLE}\uff01-\uff5e\U0001d400-\U0001d7ff]|(?![0-9])\\d")


def plain_letters(t: Mapped) -> Mapped:
    """Homoglyphs, full-width and mathematical letters, other scripts' digits to ASCII; invisible characters go."""
    def new(c: str) -> str:
        if c in INVISIBLE:
            return ""
        digit = unicodedata.decimal(c, None)
        return LOOKALIKES.get(c) or (unicodedata.normalize("NFKC", c) if digit is None else str(digit))

    return t.rewritten([(m.start(), m.end(), new(m.group())) for m in _ODD.finditer(t.text)])


#: Digits as words in English, French, German and Spanish (fixed values).
DIGITS = {word: str(d) for d, words in enumerate((
    "zero zéro null cero", "one un eins uno", "two deux zwei dos", "three trois drei tres",
    "four quatre vier cuatro", "five cinq fünf fuenf cinco", "six sechs seis", "seven sept sieben siete",
    "eight huit acht ocho", "nine neuf neun nueve")) for word in words.split()}
#: Words for the dot and the at sign in the same languages (fixed values). "at" is also an English
#: word, the others stand for the sign only.
DOTS, ATS = "dot|point|punkt|punto", "at|arroba|arobase|klammeraffe"
_LETTER = "A-Za-zéüÉÜ"
_NUMBER = "(?:" + "|".join(sorted(DIGITS, key=len, reverse=True)).replace("é", "[éÉ]").replace("ü", "[üÜ]") + ")"
_SPELLED = re.compile(rf"(?<![{_LETTER}])(?:(plus)[ -]?)?({_NUMBER}(?:[ -]{_NUMBER})*)(?![{_LETTER}])"
                      rf"|(?<![{_LETTER}])(plus)[ -]?(?=[0-9])", re.I | re.A)
#: Lower-case hints find all that their transducer can rewrite, and more.
_SPELLED_HINT = re.compile(rf"{_NUMBER}(?:[ -]{_NUMBER}| +(?:{DOTS}) )|plus| (?:{DOTS}) +{_NUMBER}")
_WORD = re.compile(f"[{_LETTER}]+")
_DOT_BEFORE = re.compile(rf" (?:{DOTS}) +$", re.I)
_DOT_AFTER = re.compile(rf" +(?:{DOTS}) ", re.I)
#: A dot word and its blanks looked for before a digit word: so many characters, or all blanks before it.
_NEAR = 12


def _dot_before(text: str, at: int) -> bool:
    """Whether a dot word and blanks stand right before ``at``."""
    if at == 0 or text[at - 1] != " ":
        return False
    blanks = at
    while blanks and text[blanks - 1] == " ":
        blanks -= 1
    return _DOT_BEFORE.search(text, max(0, blanks - _NEAR), at) is not None


def plain_digits(t: Mapped) -> Mapped:
    """Runs of two or more spelled digits (one beside "plus" or "dot") to digits without separators."""
    edits = []
    for m in _SPELLED.finditer(t.text):
        if m.group(3):
            edits.append((m.start(), m.end(), "+"))
            continue
        words = list(_WORD.finditer(t.text, m.start(2), m.end(2)))
        dotted = _dot_before(t.text, m.start()) or _DOT_AFTER.match(t.text, m.end())
        if len(words) < 2 and not m.group(1) and not dotted:
            continue
        if m.group(1):
            edits.append((m.start(), m.start(2), "+"))
        at = m.start(2)
        for w in words:
            edits.append((at, w.end(), DIGITS[w.group().lower()]))
            at = w.end()
    return t.rewritten(edits)


#: Words before a dot that make no host name of a bare "at ... dot ...", as in "at the dot" (fixed values).
NO_HOST = set("the a an this that its his her their my your le la un une der die das ein eine el los las una".split())
# Runs of blanks are taken whole from where they begin, so their length costs no more than itself.
# Labels and local parts are as long as an address allows them to be (63 and 64 characters).
_BRACKETS = re.compile(rf"(?<! ) *+[\[({{<] *+({ATS}|{DOTS}|@|\.) *+[\])}}>] *+", re.I)
_LABEL = "[A-Za-z0-9-]{1,63}"
_DOTTED = rf"(?: ++(?:{DOTS}) ++|[_-](?:{DOTS})[_-]|\.)"
_BARE = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}( ++(?:{ATS}) ++|[_-](?:{ATS})[_-])"
                   rf"{_LABEL}(?:{_DOTTED}{_LABEL})+", re.I)
_AFTER_AT = re.compile(rf"@{_LABEL}(?:(?: ++(?:{DOTS}) ++|\.){_LABEL})+", re.I)
_BARE_DOT = re.compile(rf"(?: ++(?:{DOTS}) ++|[_-](?:{DOTS})[_-])", re.I)
_DIGIT_DOT = re.compile(rf"(?<=[0-9])(?: ++(?:{DOTS}) ++)(?=[0-9])", re.I)
_DOT_HINT = re.compile(rf"{DOTS}|arroba|arobase|klammeraffe|[\[({{<] *+(?:at|@|\.) *+[\])}}>]")
#: A bare "at" counts without a dot word if something was rewritten before.
_AT_HINT = re.compile(r"[ _-]at[ _-]")


def plain_marks(t: Mapped) -> Mapped:
    """At and dot in brackets or as words to signs.

    A bare "at" counts only if the whole reads as an address: with a bare or rewritten
    dot, a host that is no article, and a last label of two letters or more. Words that
    stand for the sign only need no other evidence.
    """
    sign = lambda w: "@" if w.lower() in ("@", *ATS.split("|")) else "."
    t = t.rewritten([(m.start(), m.end(), sign(m.group(1))) for m in _BRACKETS.finditer(t.text)])
    edits = []
    for m in _BARE.finditer(t.text):
        dots = list(_BARE_DOT.finditer(t.text, m.end(1), m.end()))
        seen = t.changed is not None and any(t.changed[m.end(1):m.end()])
        labels = re.split(_DOTTED, t.text[m.end(1):m.end()], flags=re.I)
        sure = m.group(1).strip(" _-").lower() != "at"
        if (dots or seen or sure) and labels[0].lower() not in NO_HOST and labels[-1].isalpha() and len(labels[-1]) > 1:
            edits.append((m.start(1), m.end(1), "@"))
            edits += [(d.start(), d.end(), ".") for d in dots]
    t = t.rewritten(edits)
    edits = []
    for m in _AFTER_AT.finditer(t.text):
        last = re.split(_DOTTED, m.group(), flags=re.I)[-1]
        if last.isalpha() and len(last) > 1:
            edits += [(d.start(), d.end(), ".") for d in _BARE_DOT.finditer(t.text, m.start(), m.end())
                      if d.group()[0] == " "]
    t = t.rewritten(edits)
    return t.rewritten([(m.start(), m.end(), ".") for m in _DIGIT_DOT.finditer(t.text)])


def deobfuscated(text: str) -> Mapped | None:
    """The text after all transducers, or None if nothing was rewritten."""
    t = Mapped(text)
    if not text.isascii() and _ODD.search(text):
        t = plain_letters(t)
    lower = t.text.lower()
    if _SPELLED_HINT.search(lower):
        t = plain_digits(t)
    if _DOT_HINT.search(lower) or (t.changed is not None and _AT_HINT.search(lower)):
        t = plain_marks(t)
    return None if t.changed is None else t


def spans(text: str | None) -> tuple[list[list[Span]], list[list[Span]]]:
    """(base spans, all spans) of each kind, in order."""
    text = text or ""
    base = detected(text)
    t = deobfuscated(text)
    if t is None:
        return base, base
    touched = list(accumulate(t.changed, initial=0))
    every = []
    for kind, plain, found in zip(KINDS, base, detected(t.text)):
        added = set()
        for a, b in found:
            if touched[a] == touched[b]:
                continue
            if kind == "email" and not t.text[a:b].rpartition(".")[2].isalpha():
                continue
            span = (t.starts[a], t.ends[b - 1])
            if not any(x <= span[0] and span[1] <= y for x, y in plain):
                added.add(span)
        every.append(sorted({*plain, *added}))
    return base, every


def _joined(found: list[list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, s in zip(KINDS, found) for a, b in s)


def personal_data(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: base counts, digest of the base spans, all spans, ``n_added``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column("text"):
                base, every = spans(t.as_py())
                counts = [len(s) for s in base]
                out.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every),
                            sum(map(len, every)) - sum(counts)))
            columns = list(zip(*out)) or [[]] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added long")


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every identifier of ``text`` replaced by its kind in brackets."""
    column = docs.columns.index(text)

    def mask(value: str | None) -> str | None:
        if not value:
            return value
        _, every = spans(value)
        found = sorted((a, b, k) for k, s in zip(KINDS, every) for a, b in s)
        out, at = [], 0
        for a, b, k in found:
            if a >= at:
                out += [value[at:a], f"[{k.upper()}]"]
            at = max(at, b)
        return "".join([*out, value[at:]])

    def run(batches):
        for batch in batches:
            new = pa.array([mask(t.as_py()) for t in batch.column(column)], pa.string())
            yield batch.set_column(column, batch.schema.names[column], new)

    return docs.mapInArrow(run, docs.schema)
