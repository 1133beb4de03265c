"""Quality classifier: a byte-level convolutional network in numpy.

A filter spans ``TAPS`` bytes; its weights are a table by tap and byte, so a
convolution is a sum of table rows. A document is covered by overlapping chunks of
bytes, each filter is rectified and max-pooled over a chunk, the chunks are combined
by their mean and maximum, and a logistic layer gives one probability. Training runs
on a bounded, documented sample of labelled documents (``TRAIN_DOCUMENTS``, of each up
to ``TRAIN_CHUNKS`` chunks spread over the whole text); scoring covers whole texts.

Defined cases: a null or empty text is one blank chunk and gets a score; documents
whose labels contradict each other are not learned; without labels of both classes the
score is the share of good labels (0.5 without any); rows with a null id are scored
and not held out; repeated rows give one output row each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAPS, FILTERS = 6, 16
CHUNK, STRIDE = 512, 384
#: Bound of the training sample, and its course.
TRAIN_DOCUMENTS, TRAIN_CHUNKS = 3000, 12
EPOCHS, BATCH, RATE, DECAY = 14, 64, 0.015, 1e-4
THRESHOLD, FOLDS, SEED = 0.3, 5, 42
#: Bytes convolved at once.
SEGMENT = 1 << 14


@dataclass
class Network:
    """Filter tables [tap, byte, filter], filter biases, and the logistic layer over mean and maximum."""

    tables: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    @classmethod
    def constant(cls, share: float) -> Network:
        p = min(max(share, 1e-6), 1 - 1e-6)
        return cls(np.zeros((TAPS, 256, FILTERS), np.float32), np.zeros(FILTERS, np.float32),
                   np.zeros(2 * FILTERS), float(np.log(p / (1 - p))))


def chunk_starts(size: int) -> np.ndarray:
    """Starts of the chunks that cover ``size`` bytes; the last one ends with them."""
    if size <= CHUNK:
        return np.zeros(1, dtype=np.int64)
    starts = np.arange(0, size - CHUNK, STRIDE)
    return np.append(starts, size - CHUNK)


def _padded(text: bytes) -> bytes:
    return text if len(text) >= TAPS else text.ljust(TAPS, b"\0")


def convolved(data: np.ndarray, net: Network) -> np.ndarray:
    """Filter outputs before rectifying, at every position of ``data``."""
    n = len(data) - TAPS + 1
    out = np.take(net.tables[0], data[:n], axis=0)
    part = np.empty_like(out)
    for k in range(1, TAPS):
        out += np.take(net.tables[k], data[k:k + n], axis=0, out=part, mode="clip")
    return out


def pooled(texts: list[bytes], net: Network) -> tuple[np.ndarray, np.ndarray]:
    """(document of each chunk, its max-pooled filters) over whole texts, a segment at a time."""
    texts = [_padded(t) for t in texts]
    joined = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    starts = [chunk_starts(int(n)) for n in sizes]
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
    begin = np.concatenate(starts) + first[owner]
    stop = np.minimum(begin + CHUNK, (first + sizes)[owner])  # exclusive, in bytes
    out = np.empty((len(begin), FILTERS), np.float32)
    at = 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(stop, begin[at] + SEGMENT, side="right")))
        lo, hi = int(begin[at]), int(stop[at:to].max())
        conv = convolved(joined[lo:hi], net)
        a, b = begin[at:to] - lo, stop[at:to] - lo - TAPS + 1  # positions a .. b - 1
        # reduceat over (a, b) pairs; every second result is the one wanted.
        edges = np.stack([a, b], axis=1).ravel()
        if edges[-1] == len(conv):
            edges = edges[:-1]
        out[at:to] = np.maximum.reduceat(conv, edges, axis=0)[::2]
        at = to
    return owner, np.maximum(out + net.bias, 0)


def _combined(owner: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
    """[mean, maximum] of the chunks of each document (every document has a chunk)."""
    cuts = np.searchsorted(owner, np.arange(n))
    count = np.diff(np.append(cuts, len(owner)))[:, None]
    return np.concatenate([np.add.reduceat(features, cuts, axis=0) / count,
                           np.maximum.reduceat(features, cuts, axis=0)], axis=1)


def probabilities(texts: list[bytes], net: Network) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    owner, features = pooled(texts, net)
    z = _combined(owner, features, len(texts)).astype(np.float64) @ net.weights + net.offset
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


# --- training ----------------------------------------------------------------------------

def as_chunks(data: bytes) -> tuple[np.ndarray, int]:
    """(chunks [chunk, CHUNK], bytes that count in each) of joined chunks; one short chunk is padded."""
    valid = min(len(data), CHUNK)
    return np.frombuffer(data.ljust(CHUNK, b"\0"), np.uint8).reshape(-1, CHUNK), valid


def fitted(documents: list[bytes], labels: np.ndarray, seed: int = SEED) -> Network:
    """A network trained on documents given as their joined chunks."""
    if not len(labels) or labels.min() == labels.max():
        return Network.constant(float(labels.mean()) if len(labels) else 0.5)
    rng = np.random.default_rng(seed)
    chunks, valid = zip(*map(as_chunks, documents))
    net = Network(rng.normal(0, 0.1, (TAPS, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                  rng.normal(0, 0.3, 2 * FILTERS), 0.0)
    names = ("tables", "bias", "weights", "offset")
    first = {k: 0.0 for k in names}
    second = {k: 0.0 for k in names}
    step, columns = 0, np.arange(FILTERS)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            docs = order[at:at + BATCH]
            data = np.concatenate([chunks[d] for d in docs])
            owner = np.repeat(np.arange(len(docs)), [len(chunks[d]) for d in docs])
            n = CHUNK - TAPS + 1
            conv = net.tables[0][data[:, :n]]
            for k in range(1, TAPS):
                conv += net.tables[k][data[:, k:k + n]]
            for i, d in enumerate(docs):  # padding takes no part
                if valid[d] < CHUNK:
                    conv[np.searchsorted(owner, i), valid[d] - TAPS + 1:] = -np.inf
            place = conv.argmax(axis=1)
            peak = np.take_along_axis(conv, place[:, None, :], axis=1)[:, 0, :] + net.bias
            features = np.maximum(peak, 0)
            x = _combined(owner, features, len(docs)).astype(np.float64)
            p = 1 / (1 + np.exp(-np.clip(x @ net.weights + net.offset, -40, 40)))
            slope = (p - labels[docs]) / len(docs)
            grads = {"weights": x.T @ slope + DECAY * net.weights, "offset": slope.sum()}
            down = slope[:, None] * net.weights[None, :]
            count = np.bincount(owner, minlength=len(docs))
            back = (down[:, :FILTERS] / count[:, None])[owner]
            back += down[:, FILTERS:][owner] * (features == x[:, FILTERS:][owner].astype(np.float32))
            back *= peak > 0
            grads["bias"] = back.sum(axis=0)
            tables = np.zeros_like(net.tables)
            rows = np.arange(len(data))[:, None]
            for k in range(TAPS):
                np.add.at(tables[k], (data[rows, place + k], columns[None, :]), back)
            grads["tables"] = tables + DECAY * net.tables
            step += 1
            for name in names:
                g = grads[name]
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                move = rate * (first[name] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)
                new = getattr(net, name) - move
                setattr(net, name, new.astype(np.float32) if name in ("tables", "bias") else new)
    net.offset = float(net.offset)
    return net


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % FOLDS == 0, F.lit(False))


def training_chunks(docs: DataFrame, labels: DataFrame, documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """``label, chunks``: up to ``documents`` labelled documents outside the held-out fold.

    The choice is by hash of the id; of a long text, chunks are taken evenly from
    beginning to end.
    """
    usable = (labels.select("doc_id", F.col("quality").cast("int").alias("label"))
              .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
              .filter("label = most").drop("most"))
    chosen = usable.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(documents)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column("text"):
                data = _padded(t.as_py().encode())
                starts = chunk_starts(len(data))
                if len(starts) > TRAIN_CHUNKS:
                    starts = starts[np.linspace(0, len(starts) - 1, TRAIN_CHUNKS).astype(np.int64)]
                out.append(b"".join(data[s:s + CHUNK] for s in starts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"),
                                              pa.array(out, pa.binary())], ["doc_id", "label", "chunks"])

    cut = rows.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, chunks binary")
    # Repeated rows of one id are one document.
    return cut.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("chunks").alias("chunks"))


def train(docs: DataFrame, labels: DataFrame, documents: int = TRAIN_DOCUMENTS) -> Network:
    """Fits the network on the driver: at most documents * TRAIN_CHUNKS * CHUNK bytes reach it."""
    sample = sorted((r.doc_id, r.label, bytes(r.chunks))
                    for r in training_chunks(docs, labels, documents).collect())
    return fitted([c for _, _, c in sample], np.array([x for _, x, _ in sample], dtype=np.float64))


def scored(docs: DataFrame, net: Network, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            scores, group, size = [], [], 0
            for t in batch.column("text").cast(pa.binary()):
                group.append(t.as_py())
                size += len(group[-1])
                if size > 1 << 22:
                    scores.append(probabilities(group, model))
                    group, size = [], 0
            scores = np.concatenate([*scores, probabilities(group, model)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores),
                 pa.array((scores >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labels outside the held-out fold, then score every document."""
    return scored(docs, train(docs, labels))
