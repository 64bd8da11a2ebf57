"""Near-duplicates by SimHash fingerprints, found with anchor points of covering codes.

A perfect code covers its space: every point lies within the covering radius R of just one code word, its home
anchor. If two points differ in at most t bits, the second lies within R + t of the first one's home. So each
fingerprint is put at all anchors within R + t, and at an anchor, those at home are compared with all.

One code over all 64 bits would need over a thousand copies of each fingerprint for useful buckets. So the fingerprint
is cut into segments of 23, 23 and 15 bits with the binary Golay code (R = 3) and the Hamming code (R = 1) as anchors, and
the threshold is shared out: if two fingerprints differ in at most 4 bits, they differ in at most 1, 1 or 0 bits of
the first, second or third segment. That takes 5.3 + 5.3 + 1 copies on average, and loses no link.

Equal fingerprints are one point. What an anchor finds leaves it as a star, not as pairs; components are found over
these. An anchor with many points is cut into blocks of homes and guests, each pair of blocks a group of its own.

Null and empty texts have the fingerprint zero and are linked like others. Rows without an id belong to components but
cannot name one. Repeated rows stay. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaloom.llm.common import cut, joined_by_row, pick, utf8
from metaloom.llm.components import roots

SHINGLE = 4
SEED = 42
THRESHOLD = 4
#: Points of one anchor that are compared in one group; more are dealt to several groups.
BLOCK = 4096

#: Generator polynomial of the binary Golay code of length 23: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
_GOLAY = 0b110001110101


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text as a signed 64-bit number. ``bytes`` methods change and split ASCII only."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    first = [0, *(ends[: n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(first[i : i + (1 << 16)], last[i : i + (1 << 16)])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


class Code:
    """A perfect linear code. ``columns``: the syndrome of each single bit."""

    def __init__(self, columns: list[int], checks: int, radius: int):
        self.bits, self.radius, self.checks = len(columns), radius, checks
        half = self.bits // 2
        self.half = half
        self.low = self._table(columns[:half])
        self.high = self._table(columns[half:])
        self.columns = columns

    @staticmethod
    def _table(columns: list[int]) -> np.ndarray:
        out = np.zeros(1 << len(columns), np.int64)
        for i, c in enumerate(columns):
            out[1 << i : 2 << i] = out[: 1 << i] ^ c
        return out

    def syndromes(self, points: np.ndarray) -> np.ndarray:
        return self.low[points & ((1 << self.half) - 1)] ^ self.high[points >> self.half]

    @cache  # noqa: B019
    def patterns(self, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """For each syndrome, the changes that lead to an anchor within radius + threshold, home first; their number."""
        found: list[list[int]] = [[] for _ in range(1 << self.checks)]
        for weight in range(self.radius + threshold + 1):
            for places in combinations(range(self.bits), weight):
                change = syndrome = 0
                for p in places:
                    change |= 1 << p
                    syndrome ^= self.columns[p]
                found[syndrome].append(change)
        out = np.zeros((1 << self.checks, max(map(len, found))), np.int64)
        for s, changes in enumerate(found):
            out[s, : len(changes)] = changes
        return out, np.array([len(c) for c in found])


def _golay() -> Code:
    columns, value = [], 1
    for _ in range(23):
        columns.append(value)
        value <<= 1
        if value >> 11:
            value ^= _GOLAY
    return Code(columns, 11, 3)


@cache
def segments() -> list[tuple[int, Code]]:
    """First bit and code of each segment."""
    golay = _golay()
    return [(0, golay), (23, golay), (46, Code(list(range(1, 16)), 4, 1))]


def shares(threshold: int) -> list[int]:
    """Bits that may differ in a segment, such that any two within ``threshold`` are within one of them."""
    spare = max(0, threshold - 2)
    return [spare - spare // 2, spare // 2, 0]


def anchors(prints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, fingerprint, whether it is the home anchor) for every anchor that a fingerprint is put at."""
    out = []
    for n, ((first, code), share) in enumerate(zip(segments(), shares(threshold))):
        points = (prints.view(np.uint64) >> np.uint64(first)).astype(np.int64) & ((1 << code.bits) - 1)
        changes, count = code.patterns(share)
        syndromes = code.syndromes(points)
        take = np.arange(changes.shape[1]) < count[syndromes][:, None]
        at = (points[:, None] ^ changes[syndromes])[take]
        home = np.zeros(take.shape, bool)
        home[:, 0] = True
        out.append(((n << 32) | at, np.repeat(prints, count[syndromes]), home[take]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _stars(homes: np.ndarray, guests: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints, and the smallest that each is linked with through this group."""
    points, where = np.unique(np.concatenate([homes, guests]), return_inverse=True)
    label = np.arange(len(points))
    mine, theirs = where[: len(homes)], where[len(homes) :]
    step = max(1, (1 << 20) // max(1, len(guests)))
    for i in range(0, len(homes), step):
        apart = np.bitwise_count(homes[i : i + step, None] ^ guests[None, :])
        a, b = np.nonzero(apart <= threshold)
        a, b = mine[i + a], theirs[b]
        while True:
            la, lb = label[a], label[b]
            differ = la != lb
            if not differ.any():
                break
            la, lb = la[differ], lb[differ]
            low = np.minimum(la, lb)
            np.minimum.at(label, la, low)
            np.minimum.at(label, lb, low)
            while (label != label[label]).any():
                label = label[label]
    hung = np.flatnonzero(label != np.arange(len(points)))
    return points[hung], points[label[hung]]


def links(prints: DataFrame, threshold: int = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """For distinct fingerprints (column fp): edges (u, v) that connect all within ``threshold`` of each other."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                fp = batch.column("fp").slice(i, 4096).to_numpy(zero_copy_only=False)
                at, own, home = anchors(fp, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own), pa.array(home)], names=["anchor", "fp", "home"])

    placed = cut(prints.mapInArrow(place, "anchor bigint, fp bigint, home boolean"))
    counts = placed.groupBy("anchor").agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("guests"))
    # Anchors without a home, or with one point alone, link nothing.
    blocks = counts.where("homes > 0 AND guests > 1").select(
        "anchor", F.ceil(F.col("homes") / block).cast("int").alias("rows"), F.ceil(F.col("guests") / block).cast("int").alias("cols"),
    )
    dealt = placed.join(blocks, "anchor").withColumn("spot", F.xxhash64("fp"))
    row, col = F.pmod("spot", "rows").cast("int"), F.pmod("spot", "cols").cast("int")
    to_cells = lambda role, cells: dealt.where("home" if role else "true").select(
        "anchor", "fp", F.lit(role).alias("home"), F.explode(cells).alias("cell"))
    guests = to_cells(False, F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda r: r * F.col("cols") + col))
    homes = to_cells(True, F.transform(F.sequence(F.lit(0), F.col("cols") - 1), lambda c: row * F.col("cols") + c))
    cells = homes.union(guests).repartition("anchor", "cell").sortWithinPartitions("anchor", "cell")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "cell", "fp", "home")]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now)]
            ends = np.flatnonzero((np.diff(now[0]) != 0) | (np.diff(now[1]) != 0)) + 1
            yield from groups(now, ends)
            rest = [x[ends[-1] if len(ends) else 0 :] for x in now]
        if rest is not None:
            yield from groups(rest, np.array([len(rest[0])]))

    def groups(now: list[np.ndarray], ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        us, vs, start = [], [], 0
        for end in ends.tolist():
            home = now[3][start:end].astype(bool)
            fp = now[2][start:end].view(np.uint64)
            if home.any():
                u, v = _stars(fp[home], fp[~home], threshold)
                us.append(u.view(np.int64))
                vs.append(v.view(np.int64))
            start = end
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    return cells.mapInArrow(compare, "u bigint, v bigint")


def fingerprints(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, spot (a hash of id and text) and fp (signed) of each document."""
    rows = pick(documents, doc_id=id_col, body=text_col).withColumn("spot", F.xxhash64("doc_id", "body"))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["spot"], T.StructField("fp", T.LongType())])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                found = [fingerprint(t, shingle) for t in utf8(part, "body")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("spot"), pa.array(found, pa.int64())], names=schema.names)

    return rows.mapInArrow(take, schema)


def near_duplicates(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
    threshold: int = THRESHOLD, block: int = BLOCK,
) -> DataFrame:
    """doc_id, spot, fp, root, component_id (smallest doc_id that links lead to, itself included) of each document."""
    prints = cut(fingerprints(documents, id_col=id_col, text_col=text_col, shingle=shingle))
    points = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    hung = roots(links(points.select("fp"), threshold, block))
    rooted = points.join(hung, points.fp == hung.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = cut(rooted)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    names = rooted.join(named, "root").select("fp", "root", "component_id")
    return prints.join(names, "fp").select("doc_id", "spot", "fp", "root", "component_id")


def one_of_each(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns."""
    found = near_duplicates(documents, id_col=id_col, text_col=text_col, threshold=threshold)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "spot")).alias("first"))
    rows, names = joined_by_row(documents, id_col, text_col, first.select("first.doc_id", "first.spot"))
    return rows.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
