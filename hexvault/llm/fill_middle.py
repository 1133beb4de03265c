"""Fill-in-middle transformation with a sparse exception index.

A text is cut at two token borders. Cuts are kept in code points, texts in UTF-8; the
index that converts them records only the multibyte characters, by position, with the
excess bytes up to each. ``searchsorted`` finds how many of them stand before a cut, so
a code point is a byte less that excess and the other way round, and ASCII spans cost
no memory at all.

Defined cases: a null text counts as empty and comes out as an empty text; a null id is
hashed as an empty string; a text that is empty or holds a sentinel stays plain;
repeated rows give equal rows; an empty table gives no rows; other columns are ignored.
Long texts are handled whole, with a few bytes of memory for each of their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Shares in per cent: texts to transform, and transformed texts whose suffix stands first.
RATE, SUFFIX_FIRST = 90, 20


class ExceptionIndex:
    """Positions of multibyte characters, in bytes and code points, and the excess bytes before them."""

    def __init__(self, raw: np.ndarray):
        self.at_byte = np.flatnonzero(raw >= 0xC0)
        lead = raw[self.at_byte]
        more = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(more)])
        self.at_point = self.at_byte - self.excess[:-1]
        self.points = len(raw) - int(self.excess[-1])

    def to_points(self, cuts: np.ndarray) -> np.ndarray:
        return cuts - self.excess[np.searchsorted(self.at_byte, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        return cuts + self.excess[np.searchsorted(self.at_point, cuts)]


def token_starts(raw: np.ndarray) -> np.ndarray:
    """First bytes of the tokens: runs of ASCII letters, and every other character alone."""
    letter = ((raw | 0x20) - np.uint8(97)) < 26
    start = (raw & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def draws(doc_id, seed: int) -> list[int]:
    """Four numbers of 32 bits for a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def transformed(data: bytes, doc_id, seed: int = 1) -> tuple[int, str, int | None, int | None, bytes]:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text."""
    raw = np.frombuffer(data, np.uint8)
    starts = token_starts(raw)
    n = len(starts)
    h = draws(doc_id, seed)
    if not data or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= RATE:
        return n, "plain", None, None, data
    index = ExceptionIndex(raw)
    tokens = np.sort(np.array([h[0] % (n + 1), h[1] % (n + 1)]))
    cuts = index.to_points(np.append(starts, len(raw))[tokens])
    a, b = (int(x) for x in index.to_bytes(cuts))
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if h[3] % 100 < SUFFIX_FIRST:
        form, out = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    else:
        form, out = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    return n, form, int(cuts[0]), int(cuts[1] - cuts[0]), b"".join(out)


def fill_in_middle(docs: DataFrame, text: str = "text", id_col: str = "doc_id", seed: int = 1) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            found = [transformed(t.as_py() or b"", i, seed)
                     for i, t in zip(ids, batch.column("text").cast(pa.binary()))]
            n, form, prefix, middle, out = zip(*found) if found else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                 pa.array(out, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, "
                                "output string")


def restored(output: Column, form: Column) -> Column:
    """The exact text, from output and form alone.

    Neither a text of a form other than plain nor a border of its parts holds a sentinel,
    so the sentinels in the output are those put in.
    """
    part = F.split(output, "|".join(s.decode() for s in (PREFIX, SUFFIX, MIDDLE)), -1)
    return (F.when(form == "plain", output)
            .when(form == "spm", F.concat(part[2], part[3], part[1]))
            .otherwise(F.concat(part[1], part[3], part[2])))
