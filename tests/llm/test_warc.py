import hashlib
import base64
import io
import random

import pyarrow.fs as pafs
import pytest
import zstandard
from pyspark.sql import functions as F

from seismiq.llm import warc
from seismiq.session import fresh_path

SCHEMA = "page_id long, url string, html string, digest string, n_bytes string, copy string"


def brute(rows, least=0):
    """The contract's rows, sorted."""
    out, groups = [], {}
    for p, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(p)
    for payload, pages in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        pages = sorted(pages, key=lambda p: (p is not None, p), reverse=True)
        for k, p in enumerate(pages):
            again = k and len(payload) >= least
            out.append((p, len(payload), digest, "revisit" if again else "response", pages[0] if again else None))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def some_pages():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(300)]
    body = lambda n: "<html><head><title>t</title></head><body><p>" + " ".join(rng.choices(words, k=n)) + "</p></body></html>"
    hot = body(200)
    rows = [(i, f"http://h{i % 7}.example/a b/{i}?q=é", hot if i % 3 == 0 else body(rng.randint(1, 300))) for i in range(900)]
    rows += [(7, "http://twice.example", "same"), (7, "http://twice.example", "same"), (7, "http://other.example", "same"), (3, None, "same")]
    rows += [(None, "u", None), (None, None, ""), (None, "u\r\nWARC-Type: x", "only null ids"), (None, None, "only null ids")]
    rows += [(5000, "http://long.example", "x é " * 300_000), (5001, "u", "\x00\r\n\r\nWARC/1.1\r\n")]
    return rows


@pytest.mark.parametrize("least", [0, 5])
def test_records_by_brute_force(spark, least):
    rows = some_pages()
    assert got(warc.archived(table(spark, rows), least)) == brute(rows, least)


def test_payloads_come_back(spark):
    rows = some_pages()
    folder = fresh_path(spark, "warc-test")
    manifest = warc.write_archives(table(spark, rows), folder, archive_bytes=200_000)
    files = manifest.collect()
    assert len(files) > 3 and sum(f.records for f in files) == len(rows) and any(f.dictionary_bytes for f in files)
    back = warc.read_archives(manifest, folder)
    payloads = {r.payload.decode() for r in back.where("record_type = 'response'").collect()}
    assert payloads == {h or "" for _, _, h in rows}
    assert back.where("record_type = 'revisit' and payload is not null").isEmpty()
    urls = {r.url for r in back.where("page_id = 1").collect()}
    assert urls == {"http://h1.example/a%20b/1?q=%C3%A9"}


def test_archives_are_the_public_format(spark):
    """A skippable frame with a dictionary, then frames that each decompress alone and start a WARC record."""
    folder = fresh_path(spark, "warc-test")
    one = warc.write_archives(table(spark, some_pages()[:900]).coalesce(1), folder).orderBy(F.desc("dictionary_bytes")).first()
    store, _ = pafs.FileSystem.from_uri(folder)
    data = store.open_input_stream(one.path).read()
    assert data[:4] == b"\x5d\x2a\x4d\x18" and data[8:12] == b"\x37\xa4\x30\xec"
    size = int.from_bytes(data[4:8], "little")
    assert size == one.dictionary_bytes and len(data) == one.archive_bytes
    # a reader that knows nothing of archives skips the first frame
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    whole = plain.stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole.count(b"WARC-Record-ID: ") == one.records and len(whole) == one.raw_bytes
    records = list(warc.frames(io.BytesIO(data).read))
    assert len(records) == one.records and all(r.startswith(b"WARC/1.1\r\n") for r in records) and b"".join(records) == whole


def test_a_dictionary_makes_archives_smaller():
    rows = [warc.warc_record({"digest": hashlib.sha1(h.encode()).hexdigest(), "html": h.encode(), "n_bytes": len(h.encode()), "revisit": False,
                              "page_id": p, "url": u, "copy": 0, "to_id": None, "to_url": None}, "2024-01-01T00:00:00Z") for p, u, h in some_pages()[1:900]]
    size = lambda d: sum(map(len, warc.archive(rows, d)))
    assert size(warc.trained(rows)) < size(None)
    assert warc.trained(rows[:1]) is None


def test_damage_is_an_error():
    row = {"digest": hashlib.sha1(b"abc").hexdigest(), "html": b"abc", "n_bytes": 3, "revisit": False, "page_id": 1, "url": "u", "copy": 0, "to_id": None, "to_url": None}
    record = warc.warc_record(row, "2024-01-01T00:00:00Z")
    assert warc.parse_record(record)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        warc.parse_record(record[:-5])
    data = b"".join(warc.archive([record], None))
    with pytest.raises(ValueError):
        list(warc.frames(io.BytesIO(data[:-3]).read))


def test_copies_are_reduced_before_they_meet(spark):
    """Rows of one page that repeat many times become records in runs."""
    rows = spark.range(2500).select(F.lit(9).alias("page_id"), F.lit("u").alias("url"), F.lit("h").alias("html"))
    warc_rows = warc.record_rows(rows)
    assert warc_rows.count() == 2500 and warc_rows.where("revisit").select("copy").distinct().count() == 2499
    out = warc.archived(rows).groupBy("record_type", "refers_to").count().collect()
    assert sorted((r.record_type, r.refers_to, r["count"]) for r in out) == [("response", None, 1), ("revisit", 9, 2499)]


def test_empty_table(spark):
    assert got(warc.archived(table(spark, []))) == []
