"""Token ids of whole documents in files compressed with rANS, in ascending order of the documents' ids.

First pass: texts become ids, kept in the shared folder. The ids of the whole corpus are counted; the counts, at most one
per entry of the vocabulary, become one frequency table for all files. Second pass: documents are range-partitioned by id,
and each task writes files of independent blocks. A file ends with its documents' ids and lengths. Files are read
back one a task; every block, the documents' list and the table have checksums.

Null text is empty and has the end id alone. A null id comes first. Rows with equal ids are put in order of a hash of
their ids' bytes and then these, so reruns agree. An empty table gives no files.
"""

from __future__ import annotations

import json
import os
import string
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaloom.llm import rans
from metaloom.llm.common import cut, pick, utf8
from metaloom.llm.store import create, new_folder, read_random

END_ID = 2
#: Ids after which a task begins the next file.
FILE_IDS = 64 << 20
MAGIC = b"RANSTOK1"
#: Pieces of text whose ids a worker remembers; of half as many it keeps those that come again.
REMEMBERED = 800_000


#: The characters by which a byte-level model writes bytes: printable ones for themselves, others from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _PRINTED} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_MARKS = frozenset(".,;:!?")
#: Marks that stay together after letters; an apostrophe may stand with the letters that follow it.
_TAILS = frozenset(string.punctuation) - {"'"}
#: Letters below are such in every version of Unicode.
_PLAIN_BELOW = "\u0250"


class Beside(Exception):
    """White space stands beside a space."""


class Pieces(dict):
    """Ids of pieces that stand after ``before`` (a space or nothing), remembered: those of late, and older ones until then."""

    def __init__(self, encoder: Encoder, before: str):
        super().__init__()
        self.encoder, self.before, self.older = encoder, before, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            found = self.of(piece)
        if "\n" not in piece:  # two words, which are remembered by themselves
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found

    def of(self, piece: str) -> bytes:
        encoder = self.encoder
        if self.before and (not piece or piece[0] in _WHITE):
            raise Beside
        if piece.isalpha() and (piece.isascii() or max(piece) < _PLAIN_BELOW):
            return encoder.word(self.before + piece)
        if piece[-1:] in encoder.tails:
            letters = piece.rstrip(encoder.tail_marks)
            if letters.isalpha() and (letters.isascii() or max(letters) < _PLAIN_BELOW):
                return self[letters] + encoder.bare[piece[len(letters) :]]
        if piece[-1:] in _MARKS and piece[:-1].isalpha():
            return self[piece[:-1]] + encoder.bare_marks[piece[-1]]
        if 0 < (at := piece.find("\n")) < len(piece) - 1 and not piece[at - 1].isspace() and not piece[at + 1].isspace():
            return self[piece[:at]] + encoder.newline + encoder.bare[piece[at + 1 :]]
        return encoder.encode(self.before + piece)


class Packers(dict):
    """By their number, what packs ids as little-endian bytes."""

    def __init__(self, code: str):
        super().__init__()
        self.code = code

    def __missing__(self, n: int) -> Callable[..., bytes]:
        found = struct.Struct(f"<{n}{self.code}").pack
        if n < 100:
            self[n] = found
        return found


class Encoder:
    """Ids of a text as little-endian bytes, by the tokenizers library.

    A byte-level tokenizer always parts a text before a space that follows something else than white space, or that
    something else follows; likewise at a line feed between two such, and between letters and a mark after them. So the
    pieces can be encoded, and remembered, one by one; a word of letters goes to the model directly. Texts with other white
    space beside a space, and other tokenizers, are encoded whole.
    """

    def __init__(self, path: str, width: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.whole = not self.parts(config)
        self.tails = _TAILS.difference(*[t["content"] for t in config.get("added_tokens", [])])
        self.tail_marks = "".join(self.tails)
        self.tokenizer, self.packers = Tokenizer.from_file(path), Packers({"<u2": "H", "<u4": "I"}[width])
        self.model = self.tokenizer.model
        self.bare, self.spaced = Pieces(self, ""), Pieces(self, " ")
        self.newline, self.bare_marks = self.encode("\n"), {c: self.encode(c) for c in _MARKS}

    @staticmethod
    def parts(config: dict) -> bool:
        split = config.get("pre_tokenizer") or {}
        plain = all(not (t.get("lstrip") or t.get("rstrip") or t["content"].isalpha() or not _MARKS.isdisjoint(t["content"]) or any(c.isspace() for c in t["content"]))
                    for t in config.get("added_tokens", []))
        return plain and config.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)

    def packed(self, ids: list[int]) -> bytes:
        return self.packers[len(ids)](*ids)

    def encode(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, text: str) -> bytes:
        """Ids of letters, perhaps after a space; ASCII letters are written by themselves."""
        if text.isascii():
            printed = _BYTES[32] + text[1:] if text[0] == " " else text
        else:
            printed = text.encode().decode("latin-1").translate(_BYTES)
        ids = [t.id for t in self.model.tokenize(printed)]
        return self.packers[len(ids)](*ids)

    def ids(self, text: str) -> bytes:
        if self.whole:
            return self.encode(text)
        first, *rest = text.split(" ")
        try:
            return (self.bare[first] if first else b"") + b"".join(map(self.spaced.__getitem__, rest))
        except Beside:
            return self.encode(text)


#: White space but the space itself.
_WHITE = frozenset("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, width: str) -> Encoder:
    """The worker's encoder; it outlives a task."""
    if (path, width) not in _ENCODERS:
        _ENCODERS[path, width] = Encoder(path, width)
    return _ENCODERS[path, width]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _width(path: str, end_id: int) -> str:
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def tokenize(documents: DataFrame, *, id_col: str, text_col: str, tokenizer: str, end_id: int, width: str) -> DataFrame:
    """doc_id and ids (bytes compressed by themselves), the end id included.

    Each task adds a row with ``counts`` alone: how often it has seen which id, as pairs of 64-bit numbers.
    """
    rows = pick(documents, doc_id=id_col, body=text_col)
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("ids", T.BinaryType()), T.StructField("counts", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = _encoder(tokenizer, width), zstandard.ZstdCompressor(level=1)
        end, total, id_type = encoder.packed([end_id]), np.zeros(0, np.int64), None
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                ids = [(encoder.ids(t.decode("utf-8", "replace")) if t else b"") + end for t in utf8(part, "body")]
                seen = np.bincount(np.frombuffer(b"".join(ids), width), minlength=len(total))
                seen[: len(total)] += total
                total, id_type = seen, part.column("doc_id").type
                packed = pa.array(map(packer.compress, ids), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), packed, pa.nulls(len(ids), pa.binary())], names=schema.names)
        if id_type is not None:
            found = np.flatnonzero(total)
            pairs = np.stack([found, total[found]]).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.binary()), pa.array([pairs], pa.binary())], names=schema.names)

    return rows.mapInArrow(encode, schema)


def _unpacked(batch: pa.RecordBatch, width: str) -> list[np.ndarray]:
    opener = zstandard.ZstdDecompressor()
    return [np.frombuffer(opener.decompress(b), width) for b in batch.column("ids").to_pylist()]


def count_ids(tokens: DataFrame) -> DataFrame:
    """(id, n) over the whole corpus, from what each task has counted."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs in batch.column("counts").to_pylist():
                ids, n = np.frombuffer(pairs, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "n"])

    counted = tokens.where("counts IS NOT NULL").select("counts")
    return counted.mapInArrow(opened, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


class Writer:
    """Writes documents' ids to files of independent blocks."""

    def __init__(self, folder: str, table: rans.Table, id_type: pa.DataType, file_ids: int, block: int):
        self.folder, self.table, self.id_type, self.most, self.block = folder, table, id_type, file_ids, block
        self.file, self.done = None, []

    def add(self, doc_id, ids: np.ndarray) -> None:
        if self.file is None:
            self.path = f"{self.folder}/{uuid.uuid4()}.rans"
            self.file, self.docs, self.lengths, self.pending, self.waiting, self.n, self.blocks, self.at = create(self.path), [], [], [], 0, 0, [], len(MAGIC)
            self.file.write(MAGIC)
        self.docs.append(doc_id)
        self.lengths.append(len(ids))
        self.pending.append(ids)
        self.waiting += len(ids)
        self.n += len(ids)
        if self.waiting >= self.block:
            self._blocks(self.block)
        if self.n >= self.most:
            self.close()

    def _blocks(self, least: int) -> None:
        ids = np.concatenate(self.pending)
        while len(ids) >= max(1, least):
            data = rans.encode(ids[: self.block], self.table)
            self.blocks.append((self.at, min(self.block, len(ids))))
            self.file.write(data)
            self.at += len(data)
            ids = ids[self.block :]
        self.pending, self.waiting = [ids], len(ids)

    def close(self) -> None:
        if self.file is None:
            return
        self._blocks(1)
        sink = pa.BufferOutputStream()
        listed = pa.table({"doc_id": pa.array(self.docs, self.id_type), "n": pa.array(self.lengths, pa.int64())})
        with pa.ipc.new_file(sink, listed.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(listed)
        blocks = np.array(self.blocks, "<u8").tobytes()
        foot = struct.pack("<Q", len(blocks)) + blocks + sink.getvalue().to_pybytes()
        self.file.write(foot + struct.pack("<QI", len(foot), zlib.crc32(foot)) + MAGIC)
        self.file.close()
        self.done.append((self.path, len(self.docs), self.n))
        self.file = None


def write_token_files(
    documents: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
    end_id: int = END_ID, file_ids: int = FILE_IDS, block: int = rans.BLOCK,
) -> DataFrame:
    """Writes the files; returns the manifest (path, start, n_docs, n_ids), in the documents' order by start."""
    tokenizer = tokenizer or default_tokenizer()
    width = _width(tokenizer, end_id)
    tokens = cut(tokenize(documents, id_col=id_col, text_col=text_col, tokenizer=tokenizer, end_id=end_id, width=width))
    counts = count_ids(tokens).collect()
    table = rans.Table.of([r["id"] for r in counts], [r["n"] for r in counts])
    with create(f"{folder}/table.bin") as f:
        f.write(table.to_bytes())
    known = documents.sparkSession.sparkContext.broadcast(table.to_bytes())
    tokens = tokens.where("ids IS NOT NULL").select("doc_id", "ids")
    ordered = tokens.withColumn("spot", F.xxhash64("ids")).repartitionByRange("doc_id", "spot").sortWithinPartitions("doc_id", "spot", "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            writer = writer or Writer(folder, rans.Table.from_bytes(known.value), batch.column("doc_id").type, file_ids, block)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), _unpacked(batch, width)):
                writer.add(doc_id, ids)
        if writer:
            writer.close()
            paths, docs, n = zip(*writer.done)
            part = [TaskContext.get().partitionId()] * len(paths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array(range(len(paths)), pa.int64()), pa.array(paths), pa.array(docs, pa.int64()), pa.array(n, pa.int64())],
                names=["part", "turn", "path", "n_docs", "n_ids"])

    files = cut(ordered.mapInArrow(write, "part bigint, turn bigint, path string, n_docs bigint, n_ids bigint"))
    return files.selectExpr(
        "path", "coalesce(sum(n_ids) OVER (ORDER BY part, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start", "n_docs", "n_ids")


def _foot(file) -> tuple[np.ndarray, pa.Table]:
    """Blocks (offset, ids) and documents of a file."""
    size = file.size()
    if size < 2 * len(MAGIC) + 12 or file.read_at(len(MAGIC), 0) != MAGIC:
        raise rans.Corrupt("no token file")
    end = file.read_at(12 + len(MAGIC), size - 12 - len(MAGIC))
    length, crc = struct.unpack_from("<QI", end)
    foot = file.read_at(length, size - 12 - len(MAGIC) - length) if length <= size else b""
    if end[12:] != MAGIC or zlib.crc32(foot) != crc:
        raise rans.Corrupt("the documents' list is damaged")
    n = struct.unpack_from("<Q", foot)[0]
    return np.frombuffer(foot, "<u8", n // 8, 8).reshape(-1, 2).astype(np.int64), pa.ipc.open_file(pa.py_buffer(foot[8 + n :])).read_all()


def _block(file, at: int) -> bytes:
    head = file.read_at(rans.HEAD_BYTES, at)
    return head + file.read_at(rans.block_size(head)[1], at + rans.HEAD_BYTES)


def read_range(file, table: rans.Table, first: int, last: int) -> np.ndarray:
    """Ids [first, last) of a file, from the checkpoints before them."""
    out, begin = [np.zeros(0, np.uint32)], 0
    for at, n in _foot(file)[0].tolist():
        if begin < last and begin + n > first:
            out.append(rans.decode(_block(file, at), table, max(0, first - begin), min(n, last - begin)))
        begin += n
    return np.concatenate(out)


def read_file(file, table: rans.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(place in the documents' list, ids) of every document, block by block."""
    blocks, docs = _foot(file)
    rest, place, lengths = np.zeros(0, np.uint32), 0, docs.column("n").to_pylist()
    for at, _ in blocks.tolist():
        rest = np.concatenate([rest, rans.decode(_block(file, at), table)])
        used = 0
        while place < len(lengths) and used + lengths[place] <= len(rest):
            yield place, rest[used : used + lengths[place]]
            used += lengths[place]
            place += 1
        rest = rest[used:]
    if place < len(lengths) or len(rest):
        raise rans.Corrupt("the blocks don't fit the documents' list")


def read_token_files(spark: SparkSession, manifest: DataFrame, folder: str, id_type: T.DataType, *, tokens: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and tokens (array of ids, or null) of every document, from the files."""
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType())),
    ])
    files = manifest.select("path", "start")
    spread = files.repartition(max(1, files.count()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            if table is None:
                with read_random(f"{folder}/table.bin") as f:
                    table = rans.Table.from_bytes(f.read())
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                with read_random(path) as file:
                    docs = _foot(file)[1].column("doc_id").combine_chunks()
                    rows, size, begin = [], 0, 0
                    for place, ids in read_file(file, table):
                        rows.append((start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), ids if tokens else None))
                        start += len(ids)
                        size += len(ids)
                        if len(rows) >= 20_000 or tokens and size >= 1 << 20:
                            yield made(docs.slice(begin, len(rows)), rows)
                            begin, rows, size = place + 1, [], 0
                    if rows:
                        yield made(docs.slice(begin, len(rows)), rows)

    def made(docs, rows) -> pa.RecordBatch:
        starts, n, crc, ids = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [docs if isinstance(docs, pa.Array) else docs.combine_chunks(), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(ids, pa.list_(pa.int64()))],
            names=schema.names)

    return spread.mapInArrow(read, schema)


def round_trip(spark: SparkSession, documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes all documents to token files in the shared folder and reads them back, without the ids themselves."""
    folder = new_folder(spark, "tokens")
    manifest = write_token_files(documents, folder, id_col=id_col, text_col=text_col)
    return read_token_files(spark, manifest, folder, documents.schema[id_col].dataType, tokens=False)
