"""Repeated passages across a corpus, found with a sparse suffix array.

Of every ``WINDOW`` neighbouring word positions, that with the smallest hash of the next ``GRAM`` words is kept. What is
kept depends on the words alone, so copies of a passage keep the same places: a passage of ``min_words`` words is led by the
place chosen among its first ``WINDOW`` positions, and the ``core`` = min_words - WINDOW + 1 words from there lie in it.

1. The kept suffixes are sorted by their core, by range, and compared with their neighbours. Those equal to none are left out.
2. The others are extended to the left and to the right, in their text, to all the passages of ``min_words`` words that they
   lead: each passage of a text is led by one place. The stretch of text that these cover is the place's surroundings.
3. Places with equal surroundings are one class, with the first of its members by document id and position. The passages of
   each class are compared by two hashes, of 128 bits together: a passage recurs if its class has two members or another
   class has it, and is later if it occurs at a place before its own.
4. Passages that recur are joined where they overlap. Each one is found, and nothing is reported but words of such passages.

Copies collapse into classes before passages are spread out, so that the work follows the different texts. Sorting is by
range, counting combines on the map side, and joins on what very many share are split by adaptive execution. Where two
tasks' ranges meet, one row of each is compared on the driver. A document's own places are gathered in one row.

Words are parted by white space and compared as they are. Null and empty texts have no words. Rows equal in id and text
repeat each other; both are reported, and neither is later than the other. A null id comes first. Passages repeated
inside one document count. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaloom.llm.common import count_words, cut, drop, pick, utf8

MIN_WORDS = 50
GRAM, WINDOW = 8, 17
#: Words that a worker remembers the hash of; it forgets all when it has so many.
REMEMBERED = 400_000

_SPANS = "array<struct<start:int,end:int>>"
_BASES = (np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xC2B2AE3D27D4EB4F | 1))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = _Hashes()


def word_hashes(text: bytes | None) -> np.ndarray:
    words = text.split() if text else []
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Hashes of any run of words of a text, in a step each: polynomials with an odd base modulo 2^64."""

    def __init__(self, words: np.ndarray, base: np.uint64):
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(words), base, np.uint64)]), dtype=np.uint64)
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(0, len(words) - 1), inverse, np.uint64)]), dtype=np.uint64)[: len(words)]
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(words * down, dtype=np.uint64)])

    def of(self, starts: np.ndarray, n: int) -> np.ndarray:
        return _mixed((self.sums[starts + n] - self.sums[starts]) * self.powers[starts])

    def of_any(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The same for runs of several sizes; the size is part of the hash."""
        return _mixed(self.of(starts, sizes) + sizes.astype(np.uint64))


def leading_positions(words: np.ndarray) -> np.ndarray:
    """For each of the first positions of windows: the first position in it with the smallest k-gram hash. They never fall."""
    n = len(words) - GRAM + 1
    if n < WINDOW:
        return np.zeros(0, np.int64)
    grams = Rolling(words, _BASES[0]).of(np.arange(n), GRAM)
    return np.lib.stride_tricks.sliding_window_view(grams, WINDOW).argmin(axis=1) + np.arange(n - WINDOW + 1)


def kept_positions(words: np.ndarray) -> np.ndarray:
    """The positions that lead a window."""
    return np.unique(leading_positions(words))


def suffixes(documents: DataFrame, core: int) -> DataFrame:
    """(doc_id, spot, pos, key) of every kept suffix with ``core`` words or more. ``documents``: doc_id, spot, body."""
    schema = T.StructType([documents.schema["doc_id"], documents.schema["spot"], T.StructField("pos", T.IntegerType()), T.StructField("key", T.LongType())])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                owner, places, keys = [], [], []
                for n, text in enumerate(utf8(part, "body")):
                    words = word_hashes(text)
                    at = kept_positions(words)
                    at = at[at + core <= len(words)]
                    if len(at):
                        owner.append(np.full(len(at), n))
                        places.append(at)
                        keys.append(Rolling(words, _BASES[1]).of(at, core))
                if owner:
                    rows = pa.array(np.concatenate(owner))
                    yield pa.RecordBatch.from_arrays([
                        part.column("doc_id").take(rows), part.column("spot").take(rows),
                        pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(keys).view(np.int64)),
                    ], names=schema.names)

    return documents.mapInArrow(take, schema)


def surroundings(documents: DataFrame, min_words: int) -> DataFrame:
    """The passages that given places lead. ``documents``: doc_id, spot, body, places (positions).

    Returns doc_id, spot, pos, start (of the first passage), one and two (hashes of the surroundings), and ones and twos (those
    of the passages from ``start`` on). Places that lead no passage are left out.
    """
    schema = T.StructType([
        documents.schema["doc_id"], documents.schema["spot"], *[T.StructField(c, T.IntegerType()) for c in ("pos", "start")],
        *[T.StructField(c, T.LongType()) for c in ("one", "two")], *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("ones", "twos")]])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                columns = [[np.zeros(0, np.int64)] for _ in range(8)]
                for n, (text, places) in enumerate(zip(utf8(part, "body"), part.column("places").to_pylist())):
                    words = word_hashes(text)
                    if len(words) < min_words:
                        continue
                    starts = np.arange(len(words) - min_words + 1)
                    leads = leading_positions(words)[: len(starts)]
                    rolling = [Rolling(words, base) for base in _BASES]
                    hashes = [r.of(starts, min_words).view(np.int64) for r in rolling]
                    at = np.unique(np.array(places, np.int64))
                    first, end = np.searchsorted(leads, at), np.searchsorted(leads, at, side="right")
                    at, first, end = (x[first < end] for x in (at, first, end))
                    # The number of passages is part of what must be equal.
                    around = [r.of_any(first, min_words + end - first - 1) for r in rolling]
                    index = np.repeat(first, end - first) + np.arange((end - first).sum()) - np.repeat(np.cumsum(end - first) - (end - first), end - first)
                    rows = [np.full(len(at), n), at, first, around[0].view(np.int64), (around[1] + (end - first).astype(np.uint64)).view(np.int64),
                            end - first, hashes[0][index], hashes[1][index]]
                    for column, x in zip(columns, rows):
                        column.append(x)
                owner, at, first, one, two, size, ones, twos = (np.concatenate(c) for c in columns)
                offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(owner)), part.column("spot").take(pa.array(owner)), pa.array(at.astype(np.int32)),
                    pa.array(first.astype(np.int32)), pa.array(one), pa.array(two),
                    *[pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (ones, twos)],
                ], names=schema.names)

    return documents.mapInArrow(take, schema)


def equal_to_a_neighbour(rows: DataFrame, key: str, then: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The rows that have the same key as the row before or after them, in the order of ``key`` and ``then``.

    Also returns the table that they are read from, to be dropped after use.
    """
    order = [key, *then]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("same", T.BooleanType()), T.StructField("part", T.IntegerType()), T.StructField("edge", T.BooleanType())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carried = TaskContext.get().partitionId(), None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            begun = last is not None
            if begun:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            link = keys[1:] == keys[:-1]
            # The last row waits for the one after it.
            n = len(link)
            before = np.concatenate([[carried], link])
            edge = np.zeros(n, bool)
            edge[:1] = not begun
            yield made(batch.slice(0, n), before[:n] | link, edge, part)
            last, carried = batch.slice(n, 1), bool(before[-1])
        if last is not None:
            yield made(last, np.array([carried]), np.array([True]), part)

    def made(batch, same: np.ndarray, edge: np.ndarray, part: int) -> pa.RecordBatch:
        use = pa.array(np.flatnonzero(same | edge))
        taken = batch.take(use)
        return pa.RecordBatch.from_arrays([
            *taken.columns, pa.array(same).take(use), pa.array(np.full(len(use), part, np.int32)), pa.array(edge).take(use)], names=schema.names)

    found = cut(ordered.mapInArrow(compare, schema))
    # Two rows of each task: where its range begins and ends.
    edges = sorted(found.where("edge").collect(), key=lambda r: (r["part"], r[key]))
    joined = [tuple(r[c] for c in kept) for a, b in zip(edges, edges[1:]) if a["part"] != b["part"] and a[key] == b[key] for r in (a, b) if not r["same"]]
    return found.where("same").select(*kept).unionByName(rows.sparkSession.createDataFrame(joined, rows.schema)), found


def _joined(min_words: int):
    """Places with the passages that recur and are later, one bit each, -> spans."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def spans(starts: np.ndarray) -> list[dict]:
        if not len(starts):
            return []
        first = np.flatnonzero(np.diff(starts, prepend=starts[0] - min_words) >= min_words)
        ends = np.append(starts[first[1:] - 1], starts[-1]) + min_words
        return [{"start": int(a), "end": int(b)} for a, b in zip(starts[first], ends)]

    def starts_of(start: np.ndarray, bits: np.ndarray) -> np.ndarray:
        row, k = np.nonzero(bits[:, None] >> np.arange(WINDOW) & 1)
        return np.sort(start[row] + k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("places")
            flat, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            start, recurs, later = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
            out = [[spans(starts_of(start[a:b], bits[a:b])) for a, b in zip(offsets, offsets[1:])] for bits in (recurs, later)]
            yield pa.RecordBatch.from_arrays([batch.column("of"), batch.column("at"), *[pa.array(x, kind) for x in out]], names=["of", "at", "spans", "later"])

    return run


def _repeated_places(rows: DataFrame, core: int, min_words: int) -> DataFrame:
    """The surroundings of all places whose core is equal to another's; what leads there is removed."""
    kept = cut(suffixes(rows, core))
    equal, compared = equal_to_a_neighbour(kept, "key", ("doc_id", "spot", "pos"))
    asked = equal.groupBy("doc_id", "spot").agg(F.collect_set("pos").alias("places")).withColumnsRenamed({"doc_id": "of", "spot": "at"})
    texts = rows.join(asked, F.expr("spot = at AND doc_id <=> of")).select("doc_id", "spot", "body", "places")
    around = cut(surroundings(texts, min_words))
    del equal, asked, texts
    drop(kept, compared)
    return around


def repeated_passages(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, spans and later (arrays of (start, end) in words, end exclusive), n_repeated, n_later of every document.

    ``spans`` hold the passages of ``min_words`` words that occur elsewhere, joined where they overlap; ``later`` those that
    also occur before, which a deduplication removes.
    """
    core = min_words - WINDOW + 1
    if core < GRAM:
        raise ValueError(f"passages have {GRAM + WINDOW - 1} words at least")
    rows = pick(documents, doc_id=id_col, body=text_col).withColumn("spot", F.xxhash64("doc_id", "body"))
    around = _repeated_places(rows, core, min_words)
    place, same = F.struct("doc_id", "spot", "pos"), ["one", "two"]
    classes = cut(around.groupBy(*same).agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("first"), F.first("ones").alias("ones"), F.first("twos").alias("twos")))
    places = cut(around.select("doc_id", "spot", "pos", "start", *same))
    drop(around)
    passages = classes.select(*same, "n", "first", F.posexplode(F.arrays_zip("ones", "twos")).alias("k", "p")).select(
        *same, "n", "first", "k", F.col("p.ones").alias("a"), F.col("p.twos").alias("b"))
    # Written down, so that the join reads both sides from shuffles and can split what very many share.
    found = cut(passages.groupBy("a", "b").agg(F.sum("n").alias("all"), F.min("first").alias("least")).where("all > 1"))
    bit = F.expr("shiftleft(1, k)")
    bits = passages.join(found, ["a", "b"]).groupBy(*same).agg(
        F.sum(bit).alias("recurs"), F.sum(F.when(F.col("least") < F.col("first"), bit).otherwise(0)).alias("earlier"))
    judged = cut(classes.select(*same, "first").join(bits, same))
    del passages, bits
    drop(classes, found)
    # What a member of a class shares with the first one occurs before it.
    joined = places.join(judged, same)
    later = F.when(F.col("first") < place, F.col("recurs")).otherwise(F.col("earlier"))
    listed = joined.groupBy(F.col("doc_id").alias("of"), F.col("spot").alias("at")).agg(
        F.collect_set(F.struct("start", F.col("recurs").cast("int").alias("recurs"), later.cast("int").alias("later"))).alias("places"))
    schema = T.StructType([listed.schema["of"], listed.schema["at"], *[T.StructField(c, T.DataType.fromDDL(_SPANS)) for c in ("spans", "later")]])
    spans = listed.mapInArrow(_joined(min_words), schema)
    counted = rows.select("doc_id", "spot", count_words(F.col("body")).alias("n_words"))
    whole = counted.join(spans, F.expr("spot = at AND doc_id <=> of"), "left")
    none = F.array().cast(_SPANS)
    size = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    filled = whole.select("doc_id", "n_words", F.coalesce("spans", none).alias("spans"), F.coalesce("later", none).alias("later"))
    return filled.select("*", size("spans").alias("n_repeated"), size("later").alias("n_later"))
