"""WARC archives compressed with Zstandard.

An archive begins with a skippable frame that holds the dictionary; each record after it is one frame, compressed
with that dictionary. Tasks write archives of bounded size side by side, and read them one archive a task, one frame at
a time: the dictionary is loaded from the leading frame, and each record's version line, headers, lengths and digest are
checked.

Of pages with equal payloads of at least ``min_revisit`` bytes, that with the largest id is kept as a response and the
others become revisits; pages that share the largest id are all responses. Null html is an empty payload, a null URL
leaves the header out, and a null id is kept as no id (such a page is a revisit if an equal one has an id).
Empty tables give no archives.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaloom.llm.common import cut, pick
from metaloom.llm.store import create, new_folder, read_stream

MIN_REVISIT = 1000
#: Compressed bytes after which a task begins the next archive.
ARCHIVE_BYTES = 64 << 20
#: The dictionary is trained on so many pages, the first by hash, and so many bytes of each.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 512, 8192, 32768
DATE = "2020-01-01T00:00:00Z"

#: Fixed values of the formats: magic numbers of the dictionary's skippable frame, a frame, and a dictionary.
SKIPPABLE, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
_SCHEMA = "record_id string, record_type string, url string, refers_to string, payload_digest string, payload_bytes bigint, payload binary, error string"


def train_dictionary(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> bytes:
    """A dictionary from a bounded sample of pages; empty if there is too little to train on."""
    rows = pick(pages, page=id_col, url=url_col, html=html_col).withColumn("turn", F.xxhash64("page", "url"))
    turns = [r[0] for r in rows.select("turn").distinct().orderBy("turn").limit(SAMPLE_PAGES).collect()]
    if not turns:
        return b""
    some = rows.where((F.col("turn") <= turns[-1]) & (F.length("html") > 0)).groupBy("turn").agg(F.min(F.substring("html", 1, SAMPLE_BYTES)).alias("html"))
    samples = [r["html"].encode()[:SAMPLE_BYTES] for r in some.orderBy("turn").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _urn(page: str | None) -> str:
    return "<urn:page>" if page is None else f"<urn:page:{quote(page, safe='')}>"


def _page(urn: str | None) -> str | None:
    return unquote(urn[10:-1]) if urn and urn.startswith("<urn:page:") else None


def record(page: str | None, url: str | None, payload: bytes, digest: bytes, refers_to: str | None) -> bytes:
    """One WARC record; with ``refers_to``, a revisit without the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(quote(c) if c in "\r\n" else c for c in url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Archives:
    """Writes records to archives of bounded size in a folder."""

    def __init__(self, folder: str, dictionary: bytes, archive_bytes: int):
        self.folder, self.dictionary, self.most = folder, dictionary, archive_bytes
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
        self.file, self.done = None, []

    def write(self, data: bytes) -> None:
        if self.file is None:
            self.path = f"{self.folder}/{uuid.uuid4()}.warc.zst"
            self.file, self.records, self.size = create(self.path), 0, 0
            if self.dictionary:
                self._put(struct.pack("<II", SKIPPABLE, len(self.dictionary)) + self.dictionary)
        self._put(self.compressor.compress(data))
        self.records += 1
        if self.size >= self.most:
            self.close()

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.size += len(data)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.done.append((self.path, self.records, self.size))
            self.file = None


def write_archives(
    pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes a record per page; returns the manifest (path, n_records, n_bytes) of the archives that count."""
    rows = pick(pages, page=id_col, url=url_col, html=html_col)
    rows = rows.withColumn("html", F.coalesce("html", F.lit("")).cast("binary")).withColumn("sha1", F.sha1("html"))
    large = rows.where(F.length("html") >= min_revisit)
    kept = large.groupBy(F.col("sha1").alias("of")).agg(F.max("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = rows.join(kept, (F.col("sha1") == F.col("of")) & (F.length("html") >= min_revisit), "left")
    again = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    out = joined.select(F.col("page").cast("string").alias("page"), F.col("url").cast("string").alias("url"), "html", "sha1",
                        F.when(again, F.col("first").cast("string")).alias("refers_to"))
    dictionary = train_dictionary(pages, id_col, url_col, html_col)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = Archives(folder, dictionary, archive_bytes)
        for batch in batches:
            columns = [batch.column(c) for c in ("page", "url", "html", "sha1", "refers_to")]
            for i in range(batch.num_rows):
                page, url, html, sha1, refers_to = (c[i].as_py() for c in columns)
                archives.write(record(page, url, html, bytes.fromhex(sha1), refers_to))
        archives.close()
        paths, records, sizes = zip(*archives.done) if archives.done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())], names=["path", "n_records", "n_bytes"])

    return cut(out.mapInArrow(write, "path string, n_records bigint, n_bytes bigint"))


class Damaged(ValueError):
    """An archive or record that breaks the format."""


def _exactly(stream, n: int, begun: bytes = b"") -> bytes:
    data = begun
    while len(data) < n and (more := stream.read(n - len(data))):
        data += more
    return data


def frames(stream) -> Iterator[bytes]:
    """The decoded frames of an archive; the dictionary is taken from its leading skippable frame."""
    begun = _exactly(stream, 8)
    dictionary = None
    if len(begun) == 8 and struct.unpack("<I", begun[:4])[0] == SKIPPABLE:
        size = struct.unpack("<I", begun[4:])[0]
        held = _exactly(stream, size)
        if len(held) < size:
            raise Damaged("the dictionary frame is cut off")
        if held[:4] == struct.pack("<I", FRAME):
            held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
        if held[:4] != struct.pack("<I", DICTIONARY):
            raise Damaged("the leading frame holds no dictionary")
        dictionary, begun = zstandard.ZstdCompressionDict(held), b""
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while begun or (begun := stream.read(1 << 18)):
        one, parts = decompressor.decompressobj(), []
        while True:
            try:
                parts.append(one.decompress(begun))
            except zstandard.ZstdError as e:
                raise Damaged(f"a frame can't be decoded: {e}") from e
            if one.eof:
                begun = one.unused_data
                break
            if not (begun := stream.read(1 << 18)):
                raise Damaged("the last frame is cut off")
        yield b"".join(parts)


def parse(data: bytes, payload: bool = True) -> dict:
    """The fields of one record. Raises Damaged if its headers, lengths or digest are wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or not version.startswith(b"WARC/1."):
        raise Damaged("no WARC header")
    headers = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged(f"header without a colon: {line[:60]!r}")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise Damaged(f"no {name} header")
    length = headers["content-length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise Damaged(f"content-length is {length}, but the record has {len(rest) - 4} bytes")
    out = dict.fromkeys(x.split()[0] for x in _SCHEMA.split(", "))
    out |= {"record_id": _page(headers["warc-record-id"]), "record_type": headers["warc-type"], "url": headers.get("warc-target-uri"), "refers_to": _page(headers.get("warc-refers-to"))}
    kind, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if kind == "sha1":
        out["payload_digest"] = base64.b32decode(digest).hex() if len(digest) == 32 else digest.lower()
    if headers.get("content-type", "").startswith("application/http"):
        http, gap, body = rest[:-4].partition(b"\r\n\r\n")
        sizes = [line[15:].strip() for line in http.lower().split(b"\r\n") if line.startswith(b"content-length:")]
        if not gap or len(sizes) != 1 or not sizes[0].isdigit():
            raise Damaged("the HTTP part has no content-length")
        out["payload_bytes"] = int(sizes[0])
        if out["record_type"] == "response":
            if len(body) != out["payload_bytes"]:
                raise Damaged(f"the payload has {len(body)} bytes, not {out['payload_bytes']}")
            if out["payload_digest"] not in (None, hashlib.sha1(body).hexdigest()):
                raise Damaged("the payload's digest differs")
            out["payload"] = body if payload else None
    return out


def read_archive(stream, payload: bool = True) -> Iterator[dict]:
    """The records of one archive. A damaged one comes with its error; a damaged frame ends the archive."""
    try:
        for data in frames(stream):
            try:
                yield parse(data, payload)
            except Damaged as e:
                yield {"error": str(e)}
    except Damaged as e:
        yield {"error": str(e)}


def read_archives(archives: DataFrame, *, path_col: str = "path", payload: bool = True, on_error: str = "raise") -> DataFrame:
    """The records of the archives named in a table, one archive a task at a time.

    ``on_error``: "raise" fails on a damaged record, "row" returns a row with its error.
    """
    paths = pick(archives, path=path_col)
    spread = paths.repartition(max(1, paths.count()))
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    types = [{"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in _SCHEMA.split(", ")]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterable[dict]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with read_stream(path) as stream:
                    for found in read_archive(stream, payload):
                        if found.get("error") and on_error == "raise":
                            raise Damaged(f"{path}: {found['error']}")
                        yield found

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for found in records(batches):
            held.append(found)
            size += len(found.get("payload") or b"")
            if len(held) >= 2000 or size >= 8 << 20:
                yield made(held)
                held, size = [], 0
        if held:
            yield made(held)

    def made(held: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in held], t) for n, t in zip(names, types)], names=names)

    return spread.mapInArrow(read, _SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads them back, without payloads."""
    return read_archives(write_archives(pages, new_folder(spark, "warc")), payload=False)
