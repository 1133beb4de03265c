"""WARC records in ZIP-packaged archives: writer, and a reader by ranges.

The writer makes one WARC record per page, gzip member by gzip member, and packs the
records of a task into ZIP archives of bounded size with two stored members: the WARC
file and its index. Archives are rows of a table (number, bytes), so they are written
and read by Spark alone, whatever store is behind it. The reader never extracts: it
reads the end record, the ZIP64 records if there are any, the central directory and
the index, then fetches each record by its range.

Of pages with equal payloads the one with the largest id is the response, the others
are revisits that refer to it and carry no payload, only its length and digest.

Defined cases: a null html is an empty payload; a null url is left out; line breaks in
a url are percent-encoded; a null page id is kept as null and never the response of
other pages with an id (it is the response of a group without any id); repeated rows
give one record each, and all rows with the group's largest id are responses; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexvault.llm.common import salted_lookup, stored

#: Compressed bytes of records after which an archive is closed.
ARCHIVE_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing -----------------------------------------------------------------------------

def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    text = name.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           revisit: bool) -> bytes:
    """One WARC record; a revisit holds the response's head only, with the full payload's length."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(page_id)),
              ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    fields.append(("WARC-Payload-Digest", "sha1:" + payload_digest(payload)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def archive(records: list[tuple[int | None, bytes]]) -> bytes:
    """A ZIP archive with the (page id, gzip member) records and their index, both stored."""
    out, at, lines = io.BytesIO(), 0, []
    for page_id, packed in records:
        lines.append(json.dumps({"page": page_id, "filename": DATA, "offset": at, "length": len(packed)}))
        at += len(packed)
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as member:
            for _, packed in records:
                member.write(packed)
        z.writestr(zipfile.ZipInfo(INDEX), "\n".join(lines).encode())
    return out.getvalue()


def marked(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``: revisits refer to the largest id with an equal payload."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"),
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= min_bytes
    # Only payloads that occur again need a lookup: a small table unless copies abound.
    again = stored(rows.filter(large).groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("last"))
                   .filter((F.col("n") > 1) & F.col("last").isNotNull()).select("digest", "last"), "warc-copies")
    return (salted_lookup(rows, again, ["digest"], "page_id", "left")
            .withColumn("refers_to", F.when(large & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")))
            .select("page_id", "url", "payload", "refers_to"))


def written(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Stored archives: ``archive`` (bytes), ``records`` (their number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple[int | None, bytes]] = []
        size = 0

        def close():
            return pa.RecordBatch.from_pydict({"archive": pa.array([archive(gathered)], pa.binary()),
                                               "records": pa.array([len(gathered)], pa.int64())})

        for batch in batches:
            for page, url, payload, refers in zip(*batch.columns):
                page, refers = page.as_py(), refers.as_py()
                raw = record(page, url.as_py(), payload.as_py(), refers, refers is not None)
                packed = gzip.compress(raw, compresslevel=4, mtime=0)
                gathered.append((page, packed))
                size += len(packed)
                if size >= archive_bytes:
                    yield close()
                    gathered, size = [], 0
        if gathered:
            yield close()

    return stored(marked(pages, min_bytes).mapInArrow(run, "archive binary, records long"), "warc")


# --- reading -----------------------------------------------------------------------------

Fetch = Callable[[int, int], bytes]


def central_directory(fetch: Fetch, size: int) -> dict[str, tuple[int, int]]:
    """(offset, length) of the data of every stored member of a ZIP file, read by ranges.

    ``fetch(offset, length)`` returns bytes of the file. Sizes, counts and offsets that
    overflow their fields are taken from the ZIP64 records.
    """
    tail_at = max(0, size - (22 + 0xFFFF + 20))
    tail = fetch(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    locator = end - 20
    if locator >= 0 and tail[locator:locator + 4] == b"PK\x06\x07":
        at, = struct.unpack_from("<Q", tail, locator + 8)
        far = fetch(at, 56)
        if far[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", far, 32)
    directory, at, members = fetch(start, length), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        header, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + n_name].decode()
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        # The ZIP64 extra field holds, in this order, only the fields that overflow.
        while len(extra) >= 4:
            tag, n = struct.unpack_from("<HH", extra)
            if tag == 1:
                values = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                packed = next(values) if packed == 0xFFFFFFFF else packed
                header = next(values) if header == 0xFFFFFFFF else header
            extra = extra[4 + n:]
        if method == zipfile.ZIP_STORED:
            local = fetch(header, 30)
            if local[:4] != b"PK\x03\x04":
                raise ValueError(f"damaged local header of {name}")
            a, b = struct.unpack_from("<HH", local, 26)
            members[name] = (header + 30 + a + b, packed)
        at += 46 + n_name + n_extra + n_comment
    return members


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, block) of one uncompressed WARC record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("WARC record of a wrong length")
    return fields, rest[:length]


def records(fetch: Fetch, size: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Every record that the archive's index lists, fetched by its range."""
    members = central_directory(fetch, size)
    index = fetch(*members[INDEX])
    for line in index.splitlines():
        entry = json.loads(line)
        start, length = members[entry["filename"]]
        if entry["offset"] + entry["length"] > length:
            raise ValueError("index entry outside its member")
        yield parsed(zlib.decompress(fetch(start + entry["offset"], entry["length"]), wbits=31))


PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record; ``with_payload`` adds url and payload (null for a revisit).

    A response whose payload does not have its recorded digest raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column("archive"):
                held = memoryview(cell.as_buffer())
                out: list[tuple] = []
                for fields, block in records(lambda a, n: bytes(held[a:a + n]), len(held)):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = fields["WARC-Type"]
                    if kind == "response" and payload_digest(payload) != digest:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
                    length = next(int(x[16:]) for x in head.decode().split("\r\n")
                                  if x.startswith("Content-Length: "))
                    refers = _number(fields["WARC-Refers-To"]) if kind == "revisit" else None
                    row = (_number(fields["WARC-Record-ID"]), length, digest, kind, refers)
                    if with_payload:
                        row += (fields.get("WARC-Target-URI"), payload if kind == "response" else None)
                    out.append(row)
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                names = [x.split()[0] for x in PAGE.split(", ")] + ["url", "payload"]
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                                 names[:len(columns)])

    return archives.select("archive").mapInArrow(
        run, PAGE + (", url string, payload binary" if with_payload else ""))


def archived_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages into archives, read them back: one row per page."""
    return read(written(pages, min_bytes))
