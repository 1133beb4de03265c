"""Cost-balanced packing of tokenised documents into fixed-length sequences.

Texts are tokenised per Arrow batch. Full-length pieces are sequences of their own;
the rest of each document joins a group of a fixed number of rests (by hash), and
each group is packed in one task: rests in descending length go to the sequence with
the lowest estimated cost (linear plus quadratic attention inside each piece) that
has room. A rest that fits nowhere is cut to fill the sequence with most room, so a
group wastes less than one sequence.

Defined cases: a null or empty text is the end token alone; repeated rows are
documents of their own; a null id stays null; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexvault.llm.common import stored

CAPACITY = 2048
END_ID = 1
#: Cost of a piece of l tokens: LINEAR * l + QUADRATIC * l * l.
LINEAR, QUADRATIC = 1.0, 1.0 / CAPACITY
#: Rests packed together by one task.
GROUP = 4096
#: Words kept in a worker's memory (bounded; it starts anew when full).
CACHE = 400_000

#: Word pattern of the byte-level vocabularies (fixed value).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters of the common Latin blocks, and the characters for which the quick split holds.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_UNCOMMON = re.compile(f"[^\\t-\\r -~{_LATIN}]")
#: The byte-level vocabularies' pattern on those characters, for the faster standard module.
_COMMON_SPLIT = re.compile(f" ?[{_LATIN}]++|'(?:[stmd]|re|ve|ll)| ?[0-9]++| ?[^ \\t-\\r0-9{_LATIN}]++"
                           "|[ \\t-\\r]+(?![^ \\t-\\r])|[ \\t-\\r]+")

_ENCODERS: dict = {}


class Encoder:
    """Ids of a byte-level BPE vocabulary, with a bounded memory of words.

    Texts are split by the vocabulary's own pattern and each word is encoded once.
    Texts that hold a special token's string go through the tokenizer file itself.
    """

    def __init__(self, tokenizer_file: str, ranks_file: str, pattern: str):
        import base64

        import tiktoken
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(tokenizer_file)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.quick = pattern == BYTE_LEVEL

        class Memory(dict):
            def __missing__(self, word):
                if len(self) >= CACHE:
                    self.clear()
                value = self[word] = array("I", words.encode_ordinary(word)).tobytes()
                return value

        self.memory = Memory()

    def ids(self, text: str | None) -> np.ndarray:
        text = text or ""
        if any(s in text for s in self.special):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        split = _COMMON_SPLIT if self.quick and not _UNCOMMON.search(text) else self.pattern
        if len(text) < 1 << 20:
            words = split.findall(text)
        else:
            words = (m.group() for m in split.finditer(text))
        return np.frombuffer(b"".join(map(self.memory.__getitem__, words)), dtype=np.uint32)


def encoder(files: tuple[str, str, str]) -> Encoder:
    if files not in _ENCODERS:
        _ENCODERS[files] = Encoder(*files)
    return _ENCODERS[files]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _unpacked(ids: bytes, length: int) -> np.ndarray:
    return np.frombuffer(ids, dtype="<u2" if len(ids) == 2 * length else "<u4")


def pieces(docs: DataFrame, files: tuple[str, str, str], text: str = "text", id_col: str = "doc_id",
           capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Stored pieces of at most ``capacity`` tokens: full ones, and the rest of each document with its ids.

    ``with_ids`` stores the ids of full pieces too.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(files)
        for batch in batches:
            names = batch.column("doc_id")
            out: list[tuple] = []
            for at, t in enumerate(batch.column("text")):
                ids = np.append(enc.ids(t.as_py()), np.uint32(end_id))
                for start in range(0, len(ids), capacity):
                    part = ids[start:start + capacity]
                    kept = None
                    if with_ids or len(part) < capacity:
                        kept = part.astype("<u2" if part.max() < 1 << 16 else "<u4").tobytes()
                    out.append((at, start, len(part), crc(part), len(ids), kept))
            at, start, length, crcs, tokens, rest = zip(*out) if out else ([],) * 6
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(at, pa.int64())), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crcs, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array(rest, pa.binary())], ["doc_id", "start", "length", "crc", "tokens", "ids"])

    made = rows.mapInArrow(
        run, f"doc_id {kind}, start long, length long, crc long, tokens long, ids binary")
    return stored(made.withColumn("piece", F.monotonically_increasing_id()), "packing")


def assign(lengths: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(rest, start in it, length, sequence, offset) for every piece of the rests of one group."""
    count = -(-int(lengths.sum()) // capacity)
    room = np.full(count, capacity, dtype=np.int64)
    cost = np.zeros(count)
    out = []
    for which in np.argsort(-lengths, kind="stable"):
        start, left = 0, int(lengths[which])
        while left:
            fits = room >= left
            if fits.any():
                to, size = int(np.argmin(np.where(fits, cost, np.inf))), left
            else:
                to = int(np.argmax(room))
                size = int(room[to])
            out.append((int(which), start, size, to, capacity - int(room[to])))
            room[to] -= size
            cost[to] += LINEAR * size + QUADRATIC * size * size
            start, left = start + size, left - size
    return out


def pack(docs: DataFrame, files: tuple[str, str, str], text: str = "text", id_col: str = "doc_id",
         capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP,
         with_ids: bool = False) -> DataFrame:
    """One row per piece with its place; ``with_ids`` adds the token ids (array) of every piece."""
    cut = pieces(docs, files, text, id_col, capacity, end_id, with_ids)
    rests = cut.filter(F.col("length") < capacity)
    groups = max(1, -(-rests.count() // group))
    kind = cut.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long" + (", ids array<long>" if with_ids else ""))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        lengths = g["length"].to_numpy()
        ids = [_unpacked(b, l) for b, l in zip(g["ids"], lengths)]
        placed = assign(lengths, capacity)
        which = [p[0] for p in placed]
        number = int(g["g"].iloc[0])
        out = {"doc_id": g["doc_id"].array.take(which),
               "start": [int(g["start"].iat[w]) + s for w, s, _, _, _ in placed],
               "length": [n for _, _, n, _, _ in placed],
               "ids_crc32": [crc(ids[w][s:s + n]) for w, s, n, _, _ in placed],
               "doc_tokens": g["tokens"].to_numpy()[which],
               "sequence_id": [(number << 32) + q for _, _, _, q, _ in placed],
               "offset": [o for _, _, _, _, o in placed]}
        if with_ids:
            out["ids"] = [ids[w][s:s + n].astype(np.int64).tolist() for w, s, n, _, _ in placed]
        return pd.DataFrame(out)

    numbered = rests.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    packed = numbered.groupBy("g").applyInPandas(run, schema)
    full = cut.filter(F.col("length") == capacity).select(
        "doc_id", "start", "length", F.col("crc").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"),
        (F.lit(1 << 62) + F.col("piece")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        *(["ids"] if with_ids else []))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index("ids")
            ids = [_unpacked(b.as_py(), capacity).astype(np.int64) for b in batch.column(at)]
            yield batch.set_column(at, "ids", pa.array(ids, pa.list_(pa.int64())))

    return packed.unionByName(full.mapInArrow(listed, schema) if with_ids else full)
