"""Dictionary-compressed WARC archives: written by the executors, read back record by record.

Of the pages with equal payloads (by SHA-1) the one with the largest page_id is
written as a response, every other as a revisit that names it and carries no
payload.  A task collects records up to ``archive_bytes``, trains a Zstandard
dictionary on just these records, and writes one archive: a skippable frame with
the dictionary, then each record as a frame of its own, so that a reader can
start at any record.  Archives that are too small to train on have an empty
dictionary frame and plain frames.

Payloads are reduced to one for each digest before they are shuffled; revisits
are rows of ids, digests and URLs.  A group of copies that holds a third of all
pages costs one payload a task, and its revisits meet their response in a join
that adaptive execution can split.  Archives lie under new names in the shared
folder; the manifest names those of the task attempts that Spark counted, so a
lost executor leaves at most files that nothing refers to.  Files are written
with ``pyarrow.fs``, which knows local, HDFS and object store paths.

Defined results: a null html is the empty payload; a null page_id ranks below
all others and reads back as null, and so does a reference to it; a null URL has
no header; of rows that repeat the response's page_id one is the response (the
one with the largest URL) and the others revisit it; control characters,
blanks and letters beyond ASCII of a URL are percent-encoded; an empty table
gives no archive and no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import string
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismiq.llm.common import bounded_batches, materialise, slices, text_or_empty
from seismiq.session import fresh_path

# ---- fixed values of the formats ---------------------------------------------
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# -------------------------------------------------------------------------------

ARCHIVE_BYTES, DICTIONARY_BYTES, LEVEL, COPIES_A_ROW = 32 << 20, 64 << 10, 3, 100_000
#: Tasks that read archives, at most; more archives than that share tasks.
MOST_READERS = 20_000
MANIFEST = "path string, records long, raw_bytes long, dictionary_bytes long, archive_bytes long"
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record_rows(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html (null for revisits), digest, n_bytes, copy, to_id, to_url, revisit: a row for each record."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        text_or_empty("html").cast("binary").alias("html"))
    rows = rows.select("*", F.sha1("html").alias("digest"), F.octet_length("html").cast("long").alias("n_bytes"))
    shared = rows.where(F.col("n_bytes") >= min_bytes)
    # nulls are the least of a struct's values, so a page with an id wins over one without
    responses = shared.groupBy("digest", "n_bytes").agg(F.max(F.struct("page_id", "url", "html")).alias("r")).select(
        "r.page_id", "r.url", "r.html", "digest", "n_bytes", F.lit(0).cast("long").alias("copy"),
        F.lit(None).cast("long").alias("to_id"), F.lit(None).cast("string").alias("to_url"), F.lit(False).alias("revisit"))
    keys = materialise(shared.groupBy("digest", "n_bytes", "page_id", "url").agg(F.count("*").alias("n")), "warc-keys")
    chosen = keys.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("to"))
    same = F.col("page_id").eqNullSafe(F.col("to.page_id")) & F.col("url").eqNullSafe(F.col("to.url"))
    # sort-merge: the table of responses grows with the input, and a hot digest is split by adaptive execution
    others = (keys.hint("merge").join(chosen, "digest").withColumn("from", F.when(same, 1).otherwise(0).cast("long"))
              .where("n > from"))
    runs = others.withColumn("run", F.explode(F.sequence("from", F.col("n") - 1, F.lit(COPIES_A_ROW).cast("long"))))
    revisits = runs.withColumn("copy", F.explode(F.sequence("run", F.least(F.col("run") + COPIES_A_ROW, F.col("n")) - 1))).select(
        "page_id", "url", F.lit(None).cast("binary").alias("html"), "digest", "n_bytes", "copy",
        F.col("to.page_id").alias("to_id"), F.col("to.url").alias("to_url"), F.lit(True).alias("revisit"))
    out = responses.unionByName(revisits)
    if min_bytes > 0:
        out = out.unionByName(rows.where(F.col("n_bytes") < min_bytes).select(
            "page_id", "url", "html", "digest", "n_bytes", F.monotonically_increasing_id().alias("copy"),
            F.lit(None).cast("long").alias("to_id"), F.lit(None).cast("string").alias("to_url"), F.lit(False).alias("revisit")))
    return out


def _record_id(page_id: int | None, digest: str, url: str | None, copy: int) -> str:
    mark = hashlib.md5((url or "").encode("utf-8", "surrogateescape")).hexdigest()[:12] if url is not None else ""
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}:{mark}:{copy}>"


def _page_of(record_id: str) -> int | None:
    page = record_id.split(":")[2]
    return int(page) if page else None


def warc_record(row: dict, date: str) -> bytes:
    """The bytes of a record: header, the HTTP head with the payload's full length, the payload of a response."""
    digest, payload = base32(row["digest"]), row["html"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n_bytes']}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if row['revisit'] else 'response'}",
            f"WARC-Record-ID: {_record_id(row['page_id'], digest, row['url'], row['copy'])}", f"WARC-Date: {date}"]
    if row["url"] is not None:
        head.append("WARC-Target-URI: " + quote(row["url"], safe=string.punctuation))
    if row["revisit"]:
        head += [f"WARC-Refers-To: {_record_id(row['to_id'], digest, row['to_url'], 0)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(http) + len(payload)}"]
    return b"".join(["\r\n".join(head).encode(), b"\r\n\r\n", http, payload, b"\r\n\r\n"])


def parse_record(data: bytes) -> dict:
    """The columns of RECORD from a record's bytes; a damaged record is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    length = int(fields["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"{fields['WARC-Record-ID']} does not have its length")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    full = int(next(x for x in http.decode().split("\r\n") if x.lower().startswith("content-length:")).split(":")[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != full or base32(hashlib.sha1(payload).hexdigest()) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']} does not have its payload")
    return {"page_id": _page_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "refers_to": _page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None,
            "payload_digest": digest, "payload_bytes": full, "payload": payload if kind == "response" else None}


def trained(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the archive's own records; None if there are too few of them."""
    # no larger than a hundredth of what it is for
    size = min(size, sum(map(len, records)) // 100)
    if size < 256:
        return None
    try:
        return zstandard.train_dictionary(size, records, k=1024, d=8)
    except zstandard.ZstdError:
        return None


def archive(records: list[bytes], dictionary: zstandard.ZstdCompressionDict | None, level: int = LEVEL) -> Iterator[bytes]:
    """The frames of an archive: the dictionary's, then one for each record."""
    data = dictionary.as_bytes() if dictionary else b""
    yield struct.pack("<II", DICTIONARY_FRAME, len(data)) + data
    if dictionary:
        dictionary.precompute_compress(level=level)
    compress = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=True, write_checksum=True).compress
    for r in records:
        yield compress(r)


def frames(read, chunk: int = 16 << 10) -> Iterator[bytes]:
    """The records of an archive, one after the other, from ``read(n) -> bytes``."""
    start = read(8)
    magic, size = struct.unpack("<II", start)
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame")
    machine = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(read(size)) if size else None)
    rest = read(chunk)
    while rest:
        one, parts = machine.decompressobj(), []
        while not one.eof:
            if not rest:
                raise ValueError("the last record is cut off")
            parts.append(one.decompress(rest))
            rest = one.unused_data or read(chunk) if one.eof else read(chunk)
        yield b"".join(parts)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
                   date: str | None = None) -> DataFrame:
    """Write the pages as archives below ``folder``; returns the manifest: a row for each archive."""
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        held: list[bytes] = []
        raw = 0

        def close() -> pa.RecordBatch:
            dictionary = trained(held)
            path, written = f"{root}/{uuid.uuid4().hex}.warc.zst", 0
            with store.open_output_stream(path) as out:
                for frame in archive(held, dictionary):
                    out.write(frame)
                    written += len(frame)
            return pa.RecordBatch.from_pylist([{"path": path, "records": len(held), "raw_bytes": raw, "archive_bytes": written,
                                                "dictionary_bytes": len(dictionary.as_bytes()) if dictionary else 0}],
                                              pa.schema([("path", pa.string()), *((c, pa.int64()) for c in ("records", "raw_bytes", "dictionary_bytes", "archive_bytes"))]))

        for part in (x for b in batches for x in slices(b)):
            for row in part.to_pylist():
                held.append(warc_record(row, date))
                raw += len(held[-1])
                if raw >= archive_bytes:
                    yield close()
                    held.clear()
                    raw = 0
        if held:
            yield close()

    return materialise(bounded_batches(record_rows(pages, min_bytes)).mapInArrow(run, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the archives that the manifest names (columns of RECORD); revisits have a null payload.

    An archive is one task's work at most; each record's length, digest and
    checksum are compared.
    """
    fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for path in (p for b in batches for p in b.column(0).to_pylist()):
            with store.open_input_stream(path) as f:
                rows, size = [], 0
                for data in frames(f.read):
                    rows.append(parse_record(data))
                    size += len(data)
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, fields)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, fields)

    # a number of partitions that adaptive execution does not reduce: the manifest is small, the archives are not
    spread = manifest.repartition(max(1, min(manifest.count(), MOST_READERS)), "path").select("path")
    return spread.mapInArrow(run, RECORD)


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write, then read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = fresh_path(pages.sparkSession, "llm-warc")
    found = read_archives(write_archives(pages, folder, min_bytes), folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT *, sha1(b) AS hex, row_number() OVER (PARTITION BY b ORDER BY page_id DESC NULLS LAST) AS k, max(page_id) OVER (PARTITION BY b) AS top FROM p),
n AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789abcdef', substr(hex, i, 1)) - 1), 4, '0')), '') AS bits FROM h)
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST('0b' || substr(bits, 1 + 5 * i, 5) AS INT), 1)), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN top END AS refers_to
FROM n"""
