"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- secrets -----------------------------------------------------------------------------

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def secrets(text: str | None) -> dict:
    t = text or ""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 8]
    found += [("access", *m.span()) for m in ACCESS.finditer(t) if len(m.group()) >= 16]
    found += [("hex", *m.span()) for m in HEX.finditer(t) if len(m.group()) >= 32]
    order = {"assign": 0, "access": 1, "hex": 2}
    found.sort(key=lambda x: (x[1], order[x[0]]))
    n = lambda k: sum(x[0] == k for x in found)
    base = [f"{k}:{a}:{b}" for k, a, b in found]
    return {"n_assign": n("assign"), "n_access": n("access"), "n_hex": n("hex"),
            "base_sha256": sha(",".join(base)), "base": base}


# --- quality rules -----------------------------------------------------------------------

def word_stats(text: str | None) -> dict:
    t = text or ""
    words = WORD.findall(t)
    seen = defaultdict(list)
    for i in range(len(words) - 4):
        seen[tuple(words[i:i + 5])].append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(words)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": n < 10 or 100 * len(covered) > 20 * n}


def normal_lines(text: str | None) -> list[str]:
    return [" ".join(WORD.findall(x)).lower() for x in (text or "").split("\n") if WORD.search(x)]


def quality_kept(rows: list[tuple], minimum: int, share: float, left: float) -> list[bool]:
    """rows: (host, text) -> verdicts by line frequency over distinct texts of a host."""
    texts = defaultdict(set)
    for host, text in rows:
        texts[host].add(text or "")
    frequent = set()
    for host, own in texts.items():
        count = defaultdict(int)
        for t in own:
            for line in set(normal_lines(t)):
                count[line] += 1
        frequent |= {(host, x) for x, c in count.items() if c > minimum and c > len(own) * share}
    out = []
    for host, text in rows:
        lines = normal_lines(text)
        total = sum(map(len, lines))
        rest = sum(len(x) for x in lines if (host, x) not in frequent)
        out.append(not word_stats(text)["base_failed"] and rest >= left * total)
    return out


# --- simhash -----------------------------------------------------------------------------

def fingerprint(text: str | None, n: int = 3) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids: list, prints: list[int], bits: int = 3) -> list:
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    p = np.array(prints, dtype=np.uint64)
    for i in range(len(p)):
        for j in np.flatnonzero(np.bitwise_count(p[i + 1:] ^ p[i]) <= bits):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    least: dict = {}
    for i, x in enumerate(ids):
        r = find(i)
        if x is not None and (least.get(r) is None or x < least[r]):
            least[r] = x
    return [least.get(find(i)) for i in range(len(ids))]


# --- neighbours --------------------------------------------------------------------------

def neighbours(rows: list[tuple], every: int, k: int) -> dict:
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, x in good:
        if q % every == 0:
            scored = sorted((-float(x @ y / np.linalg.norm(x) / np.linalg.norm(y)), i)
                            for i, y in good if i != q and len(y) == len(x))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


# --- archives ----------------------------------------------------------------------------

def pages(rows: list[tuple]) -> list[tuple]:
    """rows: (page_id, html) -> (page_id, bytes, digest, type, refers_to)."""
    last: dict = {}
    for i, html in rows:
        if i is not None:
            last[html or ""] = max(i, last.get(html or "", i))
    out = []
    for i, html in rows:
        data = (html or "").encode()
        to = last.get(html or "")
        to = None if to == i else to
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if to is None else "revisit", to))
    return out


# --- substrings --------------------------------------------------------------------------

def substrings(rows: list[tuple], window: int = 20) -> list[tuple]:
    """rows: (doc_id, text) -> (doc_id, words, removed, sha of the kept words)."""
    low = lambda i: -(1 << 63) if i is None else i
    first: dict = {}
    for i, text in rows:
        words = WORD.findall(text or "")
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            first[key] = min(first.get(key, (low(i), s)), (low(i), s))
    out = []
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] < (low(i), s):
                gone |= set(range(s, s + window))
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((i, len(words), len(gone), sha(kept)))
    return out


# --- packing -----------------------------------------------------------------------------

def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


# --- personal data -----------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    twice = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(digits[::-1])]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def personal(text: str | None) -> dict:
    t = text or ""
    only = lambda m: re.sub(r"[^0-9]", "", m.group())
    found = {"email": [m.span() for m in EMAIL.finditer(t)],
             "ip": [m.span() for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))],
             "card": [m.span() for m in CARD.finditer(t) if 13 <= len(only(m)) <= 19 and luhn(only(m))],
             "phone": [m.span() for m in PHONE.finditer(t) if 9 <= len(only(m)) <= 15]}
    base = [f"{k}:{a}:{b}" for k, s in found.items() for a, b in s]
    return {**{f"n_{k}": len(s) for k, s in found.items()}, "base_sha256": sha(",".join(base)), "base": base}
