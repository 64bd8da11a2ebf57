"""Benchmark decontamination with suffix arrays over the training documents.

A shard is a run of whole documents inside one Spark task. Its suffix array holds the word positions at which a
benchmark window could begin, sorted by the words that follow. Every suffix of every benchmark item is then searched
in it by bisection, and the equal range gives all places of the match. Neighbouring hits of one item on one diagonal
are one longer verbatim match. Documents are never shuffled: a shard answers for its own documents.

Null and empty texts have no words and no hits; null item texts are no items. Items without an id mark words but are
not listed. Repeated rows are answered one by one. Empty tables give empty or clean results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaloom.llm.common import kept_by, pick, utf8

WINDOW = 10
#: Words in one shard's suffix array; bounds a task's memory, not what is searched.
SHARD_WORDS = 2_000_000
#: The benchmark goes to every task; a larger one is refused rather than cut.
MAX_BENCHMARK_BYTES = 256 << 20

_NOT_WORD = [b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122)]
#: Lower-cases A-Z, and turns every byte that is no part of a word into a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b in _NOT_WORD else b for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Queries:
    """The benchmark's windows, as packed integer keys.

    A word outside the benchmark's vocabulary is 0, and so is the gap between two documents, so that no match
    runs across either. ``width`` bits hold a word, ``per`` words a 64-bit key, ``keys`` keys a window.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.window = window
        self.ids = [i for i, _ in items]
        split = [words_of(t) for _, t in items]
        self.vocabulary = {w: n for n, w in enumerate(dict.fromkeys(w for ws in split for w in ws), 1)}
        self.width = max(1, len(self.vocabulary).bit_length())
        self.per = 64 // self.width
        self.keys = -(-window // self.per)
        starts, lengths, owner, at, packed = [], [], [], [], []
        for n, ws in enumerate(split):
            size = min(window, len(ws))
            numbers = np.array([self.vocabulary[w] for w in ws], np.uint64)
            for i in range(len(ws) - size + 1 if ws else 0):
                packed.append(self._pack(np.concatenate([numbers[i : i + size], np.zeros(window, np.uint64)])))
                owner.append(n)
                at.append(i)
                lengths.append(size)
        self.owner, self.at, self.lengths = (np.array(x, np.int64) for x in (owner, at, lengths))
        self.packed = np.array(packed, np.uint64).reshape(len(packed), self.keys)
        self.shortest = int(self.lengths.min()) if lengths else 0

    def _pack(self, numbers: np.ndarray) -> list:
        out = []
        for k in range(self.keys):
            key = np.uint64(0)
            for j in range(self.per):
                i = k * self.per + j
                word = numbers[i] if i < self.window else np.uint64(0)
                key |= word << np.uint64(self.width * (self.per - 1 - j))
            out.append(key)
        return out

    def suffix_array(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start positions in sorted order, and their keys. ``words`` ends with ``window`` zeros."""
        n = len(words) - self.window
        known = words != 0
        fits = known[:n].copy()
        for j in range(1, self.shortest):
            fits &= known[j : n + j]
        places = np.flatnonzero(fits)
        keys = np.zeros((self.keys, len(places)), np.uint64)
        for j in range(self.window):
            k, i = divmod(j, self.per)
            keys[k] |= words[places + j] << np.uint64(self.width * (self.per - 1 - i))
        order = np.lexsort(keys[::-1])
        return places[order], keys[:, order]

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window number, word position) at which the window's words stand."""
        if not len(self.packed):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        places, keys = self.suffix_array(words)
        first = self._range(0)
        low = np.searchsorted(keys[0], first[0], "left")
        high = np.searchsorted(keys[0], first[1], "right")
        numbers, found = [], []
        for q in np.flatnonzero(low < high):
            lo, hi = low[q], high[q]
            for k in range(1, -(-self.lengths[q] // self.per)):
                least, most = self._range(k, q)
                part = keys[k, lo:hi]
                lo, hi = lo + np.searchsorted(part, least, "left"), lo + np.searchsorted(part, most, "right")
                if lo == hi:
                    break
            if lo < hi:
                found.append(places[lo:hi])
                numbers.append(np.full(hi - lo, q))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(numbers), np.concatenate(found)

    def _range(self, k: int, q: int | None = None):
        """Smallest and largest key ``k`` of a suffix that begins with the window (``q``, or all)."""
        lengths = self.lengths if q is None else self.lengths[q]
        least = self.packed[:, k] if q is None else self.packed[q, k]
        free = self.width * (self.per - np.clip(lengths - k * self.per, 0, self.per))
        ones = (np.uint64(1) << np.minimum(free, 63).astype(np.uint64)) - np.uint64(1)
        return least, least | ones


def _shard(queries: Queries, documents: list[np.ndarray]) -> list[dict]:
    """Hits of each document of one shard."""
    sizes = np.array([len(d) for d in documents], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.zeros(starts[-1] + queries.window, np.uint64)
    for s, d in zip(starts, documents):
        words[s : s + len(d)] = d
    out = [{"n_hit": 0, "items": [], "longest": 0, "matches": []} for _ in documents]
    number, place = queries.search(words)
    if not len(place):
        return out
    length = queries.lengths[number]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + length, -1)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(edge)[: len(words)] > 0)])
    document = np.searchsorted(starts, place, "right") - 1
    item, at = queries.owner[number], queries.at[number]
    order = np.lexsort((at, place - at, item, document))
    document, item, at, place, length = (x[order] for x in (document, item, at, place, length))
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(document) != 0) | (np.diff(item) != 0) | (np.diff(place - at) != 0) | (np.diff(at) != 1)
    head = np.flatnonzero(new)
    run = np.diff(np.append(head, len(at)))
    for d, i, a, p, n in zip(
        document[head].tolist(), item[head].tolist(), at[head].tolist(), place[head].tolist(),
        (run + length[head] - 1).tolist(),
    ):
        out[d]["matches"].append({"item_id": queries.ids[i], "item_start": a, "doc_start": p - int(starts[d]), "n_words": n})
    for d in np.unique(document).tolist():
        found = out[d]
        found["n_hit"] = int(hit[starts[d] + sizes[d]] - hit[starts[d]])
        found["longest"] = max(m["n_words"] for m in found["matches"])
        found["items"] = sorted({m["item_id"] for m in found["matches"]} - {None})
    return out


def search_texts(queries: Queries, texts: list[bytes | None], shard_words: int = SHARD_WORDS) -> tuple[list[int], list[dict]]:
    """Words and hits of each text, in shards of whole texts."""
    number = queries.vocabulary.get
    counts, found, shard, held = [], [], [], 0
    for text in texts:
        words = np.array([number(w, 0) for w in words_of(text)], np.uint64)
        counts.append(len(words))
        shard.append(words)
        held += len(words)
        if held >= shard_words:
            found += _shard(queries, shard)
            shard, held = [], 0
    if shard:
        found += _shard(queries, shard)
    return counts, found


MATCH = T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("item_start", T.LongType()),
    T.StructField("doc_start", T.LongType()), T.StructField("n_words", T.LongType()),
])
_MATCH = pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()), ("n_words", pa.int64())])


def benchmark_items(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> list[tuple[str | None, bytes]]:
    """The benchmark's items, for every task. Raises if they are larger than ``limit`` bytes."""
    items = pick(benchmark, item=item_col, body=text_col).where("body IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    if size > limit:
        raise ValueError(f"the benchmark has {size} bytes, more than the {limit} that go to every task; split it")
    return [(r[0], r[1].encode()) for r in items.select(F.col("item").cast("string"), "body").collect()]


def _shared(documents: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, window: int, limit: int):
    return documents.sparkSession.sparkContext.broadcast(Queries(benchmark_items(benchmark, item_col, item_text_col, limit), window))


def without_contaminated(
    documents: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, max_benchmark_bytes: int = MAX_BENCHMARK_BYTES,
) -> DataFrame:
    """The documents without any match, with all their columns."""
    queries = _shared(documents, benchmark, item_col, item_text_col, window, max_benchmark_bytes)
    return kept_by(documents, text_col, lambda: lambda texts: [not f["n_hit"] for f in search_texts(queries.value, texts)[1]])


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
    shard_words: int = SHARD_WORDS, max_benchmark_bytes: int = MAX_BENCHMARK_BYTES,
) -> DataFrame:
    """Verbatim matches of at least ``window`` words (or a whole shorter item) in each document.

    Returns a row per document: doc_id, n_words, n_hit (words inside a match), items (ids, sorted as text), longest
    (words of the longest match), matches (item, first word in the item and in the document, words).
    """
    queries = _shared(documents, benchmark, item_col, item_text_col, window, max_benchmark_bytes)
    rows = pick(documents, doc_id=id_col, body=text_col)
    schema = T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("longest", T.LongType()), T.StructField("matches", T.ArrayType(MATCH)),
    ])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = queries.value
        for batch in batches:
            counts, found = search_texts(known, utf8(batch, "body"), shard_words)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array([f["n_hit"] for f in found], pa.int64()),
                pa.array([f["items"] for f in found], pa.list_(pa.string())),
                pa.array([f["longest"] for f in found], pa.int64()),
                pa.array([f["matches"] for f in found], pa.list_(_MATCH)),
            ], names=schema.names)

    return rows.mapInArrow(search, schema)
