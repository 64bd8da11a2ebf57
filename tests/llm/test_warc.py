import hashlib
import io
import struct

import pytest
import zstandard

from metaloom.llm import warc
from metaloom.llm.store import new_folder, read_stream

PAGES = "page_id bigint, url string, html string"


def sample(spark):
    big, other = "<p>" + "x" * 1200, "é" * 600
    rows = [
        (1, "http://a/", big), (2, "http://b/\r\nWARC-Type: x", big), (7, None, big), (7, "http://c/", big), (None, "http://d/", big),
        (3, "http://e/", "small"), (4, "http://f/", "small"), (5, "http://g/", None), (6, None, ""), (8, "http://h/", other), (9, "http://i/", other),
        (10, "http://j/", "z" * 3_000_000), (None, None, None),
    ]
    return spark.createDataFrame(rows, PAGES), rows


def expected(rows):
    first = {}
    for page, _, html in rows:
        if html and len(html.encode()) >= 1000 and page is not None:
            first[html] = max(page, first.get(html, page))
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        to = first.get(html) if html in first and first[html] != page else None
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=repr)


def test_round_trip(spark):
    pages, rows = sample(spark)
    folder = new_folder(spark, "warc")
    files = warc.write_archives(pages, folder, archive_bytes=2000)
    assert files.count() > 1 and files.agg({"n_records": "sum"}).first()[0] == len(rows)
    got = warc.read_archives(files).collect()
    assert sorted(((r.record_id and int(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in got), key=repr) == expected(rows)
    payloads = {r.payload_digest: r.payload for r in got if r.record_type == "response"}
    assert all(hashlib.sha1(p).hexdigest() == d for d, p in payloads.items())
    assert {r.url for r in got} >= {None, "http://b/%0D%0AWARC-Type: x"}


def test_extra_columns_and_empty_table(spark):
    pages, rows = sample(spark)
    from pyspark.sql import functions as F
    more = pages.select("*", *[F.lit(1).alias(c) for c in ("HTML", "sha1", "first", "page", "of", "n")])
    assert warc.round_trip(spark, more).count() == len(rows)
    assert warc.round_trip(spark, spark.createDataFrame([], PAGES)).count() == 0


def archive(records, dictionary=b"", tail=b""):
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    c = zstandard.ZstdCompressor(dict_data=trained)
    head = struct.pack("<II", warc.SKIPPABLE, len(dictionary)) + dictionary if dictionary else b""
    return head + b"".join(c.compress(r) for r in records) + tail


def good(n=1):
    body = b"body%d" % n
    return warc.record(str(n), "http://x/", body, hashlib.sha1(body).digest(), None)


def read(data):
    return list(warc.read_archive(io.BytesIO(data)))


def test_dictionary_frame():
    samples = [good(i) * 3 for i in range(400)]
    dictionary = zstandard.train_dictionary(2048, samples).as_bytes()
    assert [r["record_id"] for r in read(archive([good(1), good(2)], dictionary))] == ["1", "2"]
    packed = zstandard.ZstdCompressor().compress(dictionary)
    data = archive([good(3)], dictionary)
    data = struct.pack("<II", warc.SKIPPABLE, len(packed)) + packed + data[8 + len(dictionary) :]
    assert [r["payload"] for r in read(data)] == [b"body3"]
    assert "no dictionary" in read(struct.pack("<II", warc.SKIPPABLE, 4) + b"abcd")[0]["error"]
    assert "cut off" in read(struct.pack("<II", warc.SKIPPABLE, 400) + b"abcd")[0]["error"]


@pytest.mark.parametrize("change, what", [
    (lambda r: r.replace(b"WARC/1.1", b"HTTP/1.1", 1), "no WARC header"),
    (lambda r: r.replace(b"WARC-Date", b"WARC-Data", 1), "no warc-date"),
    (lambda r: r.replace(b"WARC-Type: ", b"WARC-Type ", 1), "colon"),
    (lambda r: r[:-4] + b"x\r\n\r\n", "content-length"),
    (lambda r: r.replace(b"body", b"BODY"), "digest"),
    (lambda r: r.replace(b"utf-8\r\nContent-Length: 5", b"utf-8\r\nContent-Length: 6"), "payload has 5"),
])
def test_damaged_records_are_reported_and_others_read(change, what):
    got = read(archive([good(1), change(good(2)), good(3)]))
    assert [r.get("record_id") for r in got] == ["1", None, "3"] and what in got[1]["error"]


def test_damaged_frames_end_an_archive():
    whole = archive([good(1), good(2)])
    assert "cut off" in read(whole[:-3])[1]["error"]
    assert "decoded" in read(archive([good(1)], tail=b"junk and more"))[1]["error"]
    assert read(b"") == []


def test_an_archive_is_one_frame_per_record(spark):
    pages, rows = sample(spark)
    paths = [r.path for r in warc.write_archives(pages, new_folder(spark, "warc")).collect()]
    with read_stream(paths[0]) as stream:
        for frame in warc.frames(stream):
            assert frame.startswith(b"WARC/1.1\r\n") and frame.count(b"WARC-Record-ID") == 1
