"""Hard negatives by a vertical scan with branch and bound (BOND).

An anchor's positives are its best rows of the same label by inner product; a positive's hard negatives are the best rows of
other labels whose score lies in a window below the positive's.

1. *Vertical blocks.* Components become integers, floor(scale * x), so that scores are exact. Rows are dealt by range of (label,
   id) and packed into blocks of ``BLOCK`` rows, each dimension contiguous, with the least and largest value of each. The
   blocks are a table in the shared folder, written once.
2. *Scan.* A task takes some anchors and reads the blocks one after the other. In a block, it reads the dimensions in the order
   of the anchor's components by size, the largest first, and adds up the partial scores of all rows at once. What the
   dimensions still unread can add is bounded by their least and largest values. Every ``STEP`` dimensions, rows that
   cannot count any more leave the candidate bitmap, and once few are left only they are read.
3. *Positives.* Rows of the anchor's label count while their upper bound reaches the score of the k-th best row so far.
4. *Windows.* With the positives' scores exact, rows of other labels count while their bounds still meet a window: above its
   lower end and its k-th best score so far, and not above its upper end. Windows of equal scores are one.

Every task reads all blocks for its ``ANCHORS`` anchors, so nothing is shuffled by pairs, and there are no rows of pairs but the
result. Blocks of other labels than the anchors' are not opened for positives. Memory is one group of blocks and the
anchors of a task, whatever a label holds. The work is anchors x rows x dimensions read.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part. A vector shorter
than another counts as padded with zeros; an empty one is all zeros. "Other rows" are rows with another id. Repeated rows
count each; an id that is there twice as an anchor gives its rows twice. Ties in score go to the lesser id. A positive
without negatives gives no row. A component whose integer does not fit 32 bits, or a score that could exceed 63, is refused.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaloom.llm.common import checkpoint_dir, cut, pick
from metaloom.llm.store import new_folder, read_random

BLOCK, STEP, ANCHORS = 8192, 8, 64
#: Rows that are scanned at once: blocks smaller than this are put together.
LEAST_ROWS = 4096

RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
_BLOCK = "least_label bigint, largest_label bigint, ids binary, labels binary, dims binary"


def integer_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part, with integer components."""
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    fits = F.forall("w", lambda x: F.abs(x) < float(1 << 31))
    kept = rows.select("id", F.col("label").cast("bigint").alias("label"), F.transform("v", lambda x: x.cast("double")).alias("v")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(whole, F.lit(False)))
    scaled = kept.select("id", "label", F.transform("v", lambda x: F.lit(float(scale)) * x).alias("w"))
    checked = F.when(fits, F.transform("w", lambda x: F.floor(x).cast("int"))).otherwise(
        F.raise_error(F.concat(F.lit("a component of this row does not fit 32 bits: "), F.col("id").cast("string"))))
    return scaled.select("id", "label", checked.alias("v"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch as rows, padded with zeros."""
    lists = batch.column("v")
    sizes = np.diff(lists.offsets.to_numpy())
    wide = int(sizes.max()) if len(sizes) else 0
    out = np.zeros((len(sizes), wide), np.int32)
    out[np.arange(wide) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows with contiguous dimensions, in the order in which the rows come."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            labels = part.column("label").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(labels.min())]), pa.array([int(labels.max())]), pa.array([part.column("id").to_numpy().tobytes()], pa.binary()),
                 pa.array([labels.tobytes()], pa.binary()), pa.array([np.ascontiguousarray(_matrix(part).T).tobytes()], pa.binary())],
                names=["least_label", "largest_label", "ids", "labels", "dims"])


class Block:
    """Rows with their dimensions one after the other, and what each dimension can add at least and at most."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, dims: np.ndarray, width: int):
        self.ids, self.labels = ids, labels
        self.dims = dims if len(dims) >= width else np.concatenate([dims, np.zeros((width - len(dims), len(ids)), np.int32)])
        self.least, self.largest = self.dims.min(1).astype(np.int64), self.dims.max(1).astype(np.int64)
        self.size = np.maximum(-self.least, self.largest).astype(np.float64)
        self._typed: dict = {}

    def typed(self, kind) -> np.ndarray:
        """The dimensions as numbers of a kind that holds all sums exactly."""
        if kind not in self._typed:
            self._typed[kind] = self.dims.astype(kind)
        return self._typed[kind]


def read_blocks(files: list[str], width: int, wanted=None) -> Iterator[Block]:
    """The blocks of a table, small ones put together; with ``wanted``, those that may hold one of these sorted labels."""
    ids, labels, dims = [], [], []

    def joined() -> Block:
        wide = max(len(d) for d in dims)
        padded = [d if len(d) == wide else np.concatenate([d, np.zeros((wide - len(d), d.shape[1]), np.int32)]) for d in dims]
        return Block(np.concatenate(ids), np.concatenate(labels), np.concatenate(padded, 1), width)

    for uri in files:
        with read_random(uri) as source, pq.ParquetFile(source) as table:
            for batch in table.iter_batches(batch_size=1):
                if wanted is not None:
                    at = bisect.bisect_left(wanted, batch.column("least_label")[0].as_py())
                    if at == len(wanted) or wanted[at] > batch.column("largest_label")[0].as_py():
                        continue
                own = np.frombuffer(batch.column("ids")[0].as_buffer(), np.int64)
                ids.append(own)
                labels.append(np.frombuffer(batch.column("labels")[0].as_buffer(), np.int64))
                dims.append(np.frombuffer(batch.column("dims")[0].as_buffer(), np.int32).reshape(-1, len(own)))
                if sum(map(len, ids)) >= LEAST_ROWS:
                    yield joined()
                    ids, labels, dims = [], [], []
    if ids:
        yield joined()


class Anchor:
    """One query vector, with its dimensions in the order in which they are read, and what it has found."""

    def __init__(self, anchor_id: int, label: int, vector: np.ndarray):
        self.id, self.label, self.vector = anchor_id, label, vector
        self.order = np.argsort(-np.abs(vector), kind="stable")
        self.order = self.order[: int(np.count_nonzero(vector))]  # zeros come last and add nothing
        self.positives: list[tuple[int, int]] = []  # (-score, id), best first
        self.windows: list[tuple[int, int, int]] = []  # (score of the positive, lower, upper)
        self.found: list[list[tuple[int, int]]] = []

    def scan(self, block: Block, candidates: np.ndarray, alive) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, exact scores) of the candidates that no bound excludes.

        ``alive`` tells from lower and upper bounds on the scores which rows may still count.
        """
        size = float(np.abs(self.vector[self.order]).astype(np.float64) @ block.size[self.order])
        if size >= 2.0**63:
            raise ValueError(f"scores of anchor {self.id} may exceed 63 bits")
        kind = np.float32 if size < 2**24 else np.float64 if size < 2**53 else np.int64
        dims, q = block.typed(kind), self.vector[self.order]
        ends = np.stack([q * block.least[self.order], q * block.largest[self.order]])
        left = np.concatenate([np.cumsum(np.stack([ends.min(0), ends.max(0)])[:, ::-1], 1)[:, ::-1], np.zeros((2, 1), np.int64)], 1)
        rows = None if len(candidates) * 2 > len(block.ids) else candidates
        mask = candidates if rows is None else None
        partial = np.zeros(len(block.ids) if rows is None else len(rows), kind)
        for at, d in enumerate(self.order.tolist()):
            if at % STEP == 0:
                low, high = left[:, at].tolist()
                if rows is None:
                    ok = alive(partial + kind(low), partial + kind(high))
                    kept = mask[ok[mask]]
                    if len(kept) * 4 < len(block.ids):
                        rows, partial = kept, partial[kept]
                    mask = kept
                else:
                    ok = alive(partial + kind(low), partial + kind(high))
                    if not ok.all():
                        rows, partial = rows[ok], partial[ok]
                if rows is not None and not len(rows):
                    break
            column = dims[d] if rows is None else dims[d][rows]
            partial += column * kind(q[at])
        if rows is None:
            rows, partial = mask, partial[mask]
        ok = alive(partial, partial)
        return rows[ok], partial[ok].astype(np.int64)


def _best(old: list[tuple[int, int]], scores: np.ndarray, ids: np.ndarray, most: int) -> list[tuple[int, int]]:
    """The first ``most`` of old and new rows, by score, then id."""
    if len(scores) > most:  # rows below the last that can count are not worth sorting
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        near = scores >= least
        scores, ids = scores[near], ids[near]
        first = np.lexsort((ids, -scores))[:most]
        scores, ids = scores[first], ids[first]
    return sorted(old + list(zip((-scores).tolist(), ids.tolist())))[:most]


def find_positives(anchor: Anchor, block: Block, most: int) -> None:
    same = np.flatnonzero((block.labels == anchor.label) & (block.ids != anchor.id))
    if not len(same):
        return
    least = -anchor.positives[-1][0] if len(anchor.positives) == most else None
    rows, scores = anchor.scan(block, same, lambda low, high: high >= least if least is not None else np.ones(len(high), bool))
    anchor.positives = _best(anchor.positives, scores, block.ids[rows], most)


def set_windows(anchor: Anchor, low: int, high: int) -> None:
    """The scores s of negatives with low * p <= 100 * s <= high * p, for the scores p of the positives."""
    for p in sorted({-s for s, _ in anchor.positives}, reverse=True):
        ends = -(-low * p // 100), high * p // 100
        if ends[0] <= ends[1]:
            anchor.windows.append((p, *ends))
            anchor.found.append([])


def find_negatives(anchor: Anchor, block: Block, most: int) -> None:
    other = np.flatnonzero(block.labels != anchor.label)
    if not anchor.windows or not len(other):
        return
    needs = [max(low, -found[-1][0]) if len(found) == most else low for (_, low, _), found in zip(anchor.windows, anchor.found)]
    limits = [high for _, _, high in anchor.windows]
    # Windows of falling positives: bounds of the whole first, which most rows miss.
    least, largest = min(needs), max(limits)

    def alive(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        ok = (high >= least) & (low <= largest)
        if len(needs) > 1 and ok.any():
            some = np.flatnonzero(ok)
            ok[some] = np.logical_or.reduce([(high[some] >= n) & (low[some] <= m) for n, m in zip(needs, limits)])
        return ok

    rows, scores = anchor.scan(block, other, alive)
    ids = block.ids[rows]
    for k, (need, limit) in enumerate(zip(needs, limits)):
        inside = (scores >= need) & (scores <= limit)
        if inside.any():
            anchor.found[k] = _best(anchor.found[k], scores[inside], ids[inside], most)


def mine(
    embeddings: DataFrame, *, anchor_every: int = 50, scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Hard negatives (see ``RESULT``) of the rows whose id is divisible by ``anchor_every``.

    For each of an anchor's first ``positives`` rows of its label, with score p: the first ``negatives`` rows of other labels
    whose score is between ``low`` and ``high`` percent of p.
    """
    spark = embeddings.sparkSession
    rows = cut(integer_vectors(pick(embeddings, id=id_col, v=vector_col, label=label_col), scale))
    known = rows.agg(
        F.count(F.when(F.col("id") % anchor_every == 0, 1)).alias("anchors"), F.max(F.size("v")).alias("width")).first()
    checkpoint_dir(spark)
    folder = new_folder(spark, "blocks")
    dealt = rows.repartitionByRange("label", "id").sortWithinPartitions("label", "id")
    dealt.mapInArrow(_pack, _BLOCK).write.parquet(folder)
    # Names of part files sort like the ranges.
    files = sorted(spark.read.schema(_BLOCK).parquet(folder).inputFiles())
    width = known["width"] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ANCHORS):
                part = batch.slice(at, ANCHORS)
                matrix = np.zeros((part.num_rows, width), np.int64)
                own = _matrix(part)
                matrix[:, : own.shape[1]] = own
                anchors = [Anchor(i, lab, v) for i, lab, v in zip(part.column("id").to_pylist(), part.column("label").to_pylist(), matrix)]
                for block in read_blocks(files, width, sorted({a.label for a in anchors})):
                    for anchor in anchors:
                        find_positives(anchor, block, positives)
                for anchor in anchors:
                    set_windows(anchor, low, high)
                for block in read_blocks(files, width):
                    for anchor in anchors:
                        find_negatives(anchor, block, negatives)
                out = []
                for a in anchors:
                    best = {p: found for (p, _, _), found in zip(a.windows, a.found)}
                    out += [(a.id, i, rank, n, -s, -ns) for s, i in a.positives for rank, (ns, n) in enumerate(best.get(-s, []), 1)]
                columns = list(zip(*out)) or [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    parts = max(1, -(-known["anchors"] // ANCHORS))
    anchors = rows.where(F.col("id") % anchor_every == 0).repartitionByRange(parts, "label", "id")
    return anchors.mapInArrow(run, RESULT)
