"""Periodic runs of words, found with an enhanced suffix array and the branching-tandem test.

A run is a stretch of words with smallest period q and at least max(12, 2q) words that no neighbouring word extends keeping
that period. For every text:

1. *Stretches.* A run of 12 words or more with period q repeats at least six words at distance q, so each of its words lies
   in a six-word window that occurs twice in the run. Words outside such windows are left out, and what is left falls into
   stretches. A run is whole within one stretch, so each stretch is a text of its own; windows are then looked for within the
   stretches alone, until nothing more falls out. This loses no run: equal windows have equal hashes.
2. *Suffix array.* Prefix doubling over all stretches of a batch at once; the ranks of each level are kept. They give the
   longest common prefix (LCP) of neighbours, and later the longest common suffix of two positions, by halving steps.
3. *Branching tandems.* For each LCP interval of depth l, all suffixes i of all children but the largest are asked whether
   i + l and i - l are in the interval too, by their place in the suffix array (ISA), and in another child. Then the words at
   the lesser of the two begin a square of period l that the next word breaks. No tree is built: an interval is a
   range of the suffix array between smaller LCP values.
4. *Rotation.* A square is moved left for as long as the word that enters equals the one that leaves: by as much as the
   longest common suffix of its two halves' starts. Squares with the same first and last word are one run, and the least of
   their periods is its smallest one. Each run ends in a square of its own smallest period, so none is missed.

The work is n log n in the words of the stretches, linear in all others. A task holds one batch of texts (some 2 MB, or
one text), and for a text with long repeats four bytes a word of its stretches for each doubling of the longest repeat.
Texts are dealt with apart from each other, so nothing is shuffled, and no key can be hot.

Defined results: a null text or one without words has no runs and the empty collapsed text. Each row stands for itself,
so repeated rows give repeated results. A null id is kept. Runs are listed by start, then period.

With ``planted``, texts get known runs first: let h = crc32 of the decimal id and g = h div 10; if h mod 10 = 0, the words
from a = g mod n on repeat the first p = 1 + (n - a) div (3 + g mod 8) of them. Rows with a null id stay as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaloom.llm.common import pick, utf8

#: Words of the shortest run.
LEAST = 12
#: Words that recur in every run, at the distance of its period.
WINDOW = LEAST // 2
#: Bytes of text that are dealt with at once; a longer text is a batch of its own.
BATCH = 2 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _recurring(words: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Which words lie in a window that occurs more than once in its part; a chance equality of hashes only adds words."""
    n = len(words) - WINDOW + 1
    hashed = part[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(WINDOW):
        hashed = (hashed ^ (hashed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n].astype(np.uint64)
    hashed ^= hashed >> np.uint64(32)
    at = np.flatnonzero(part[:n] == part[WINDOW - 1 :])
    order = at[np.argsort(hashed[at])]
    same = np.flatnonzero(hashed[order[1:]] == hashed[order[:-1]])
    twice = np.zeros(n, bool)
    twice[order[same]] = twice[order[same + 1]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += twice
    edges[WINDOW:] -= twice
    return np.cumsum(edges[:-1]) > 0


def stretches(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, number of the stretch of each) of all words that can be in a run."""
    at, part = np.arange(len(words)), doc
    while len(at) >= LEAST:
        inside = _recurring(words[at], part)
        kept, of = at[inside], part[inside]
        # A stretch ends where words were left out.
        first = np.ones(len(kept), bool)
        first[1:] = (np.diff(kept) > 1) | (np.diff(of) > 0)
        part = np.cumsum(first) - 1
        long = np.bincount(part)[part] >= LEAST if len(part) else np.zeros(0, bool)
        same = len(kept) == len(at) and long.all()
        at, part = kept[long], part[long]
        if same:
            return at, part
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def _bounds(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end position of the part of each position."""
    first = np.flatnonzero(np.diff(part, prepend=-1))
    size = np.diff(first, append=len(part))
    return np.repeat(first, size), np.repeat(first + size, size)


def suffix_levels(words: np.ndarray, part: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by part and their first 1, 2, 4, ... words, until no two are equal.

    A rank is the place in the suffix array of the first suffix that is equal so far. Each level has one more entry, -1, for
    the position past the last word.
    """
    n = len(words)
    key = np.unique(part.astype(np.int64) * (int(words.max()) + 1) + words, return_inverse=True)[1]
    active, levels, rank, reach = np.arange(n), [], np.zeros(n, np.int64), 1
    while True:
        order = np.argsort(key, kind="stable")
        who, sorted_key, old = active[order], key[order], rank[active[order]]
        index = np.arange(len(who))
        fresh = np.diff(sorted_key, prepend=-1) != 0
        group = np.diff(old, prepend=-1) != 0
        begins = np.maximum.accumulate(np.where(fresh, index, 0))
        rank = rank.copy()
        rank[who] = old + begins - np.maximum.accumulate(np.where(group, index, 0))
        levels.append(np.append(rank, -1).astype(np.int32 if n < 1 << 31 else np.int64))
        size = np.diff(np.flatnonzero(fresh), append=len(who))
        active = who[np.repeat(size > 1, size)]
        if not len(active):
            return levels
        after = active + reach
        follow = np.where(after < end[active], rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + follow
        reach *= 2


def _common_prefix(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    length = np.zeros(len(i), np.int64)
    for k in reversed(range(len(levels))):
        length += (levels[k][i + length] == levels[k][j + length]).astype(np.int64) << k
    return length


def _common_suffix(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words that the text before i shares with the text before j > i, within the part that starts at ``first``."""
    length = np.zeros(len(i), np.int64)
    for k in reversed(range(len(levels))):
        a, b = i - length - (1 << k), j - length - (1 << k)
        fits = a >= first
        length += (fits & (levels[k][np.where(fits, a, 0)] == levels[k][np.where(fits, b, 0)])).astype(np.int64) << k
    return length


def _intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each boundary, the nearest boundaries with a smaller LCP value, before and after it."""
    m = len(lcp)
    before, after, open_, values = [-1] * m, [m] * m, [], lcp.tolist()
    for b, v in enumerate(values):
        while open_ and values[open_[-1]] > v:
            after[open_.pop()] = b
        if open_:
            top = open_[-1]
            before[b] = before[top] if values[top] == v else top
        open_.append(b)
    return np.array(before, np.int64), np.array(after, np.int64)


def branching_tandems(levels: list[np.ndarray], end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares that the word after them does not continue."""
    isa = levels[-1][:-1].astype(np.int64)
    n = len(isa)
    sa = np.empty(n, np.int64)
    sa[isa] = np.arange(n)
    near = np.flatnonzero(levels[0][sa[:-1]] == levels[0][sa[1:]])
    lcp = np.zeros(n - 1, np.int64)
    lcp[near] = _common_prefix(levels, sa[near], sa[near + 1])
    before, after = _intervals(lcp)
    # Boundaries of one interval side by side: its children lie between them.
    edge = near[np.argsort(before[near] * (n + 1) + after[near], kind="stable")]
    if not len(edge):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    group = np.flatnonzero((np.diff(before[edge], prepend=-2) != 0) | (np.diff(after[edge], prepend=-2) != 0))
    low, high, depth = before[edge[group]] + 1, after[edge[group]], lcp[edge[group]]
    child_low = np.insert(edge + 1, group, low)
    child_high = np.insert(edge, np.append(group[1:], len(edge)), high)
    children = np.diff(group, append=len(edge)) + 1
    of = np.repeat(np.arange(len(group)), children)
    size = child_high - child_low + 1
    largest = np.flatnonzero(size == np.maximum.reduceat(size, np.cumsum(children) - children)[of])
    smaller = np.ones(len(size), bool)
    smaller[largest[np.diff(of[largest], prepend=-1) > 0]] = False
    child = np.repeat(np.flatnonzero(smaller), size[smaller])
    step = np.arange(len(child)) - np.repeat(np.cumsum(size[smaller]) - size[smaller], size[smaller])
    at, interval = sa[child_low[child] + step], of[child]
    found = []
    for other, start in ((at + depth[interval], at), (at - depth[interval], at - depth[interval])):
        fits = (other >= 0) & (other < n)
        place = isa[np.where(fits, other, 0)]
        fits &= (place >= low[interval]) & (place <= high[interval]) & ((place < child_low[child]) | (place > child_high[child]))
        found.append((start[fits], depth[interval][fits]))
    return np.concatenate([s for s, _ in found]), np.concatenate([d for _, d in found])


def find(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, sorted, in texts that stand one after the other; ``doc`` numbers them."""
    at, part = stretches(words, doc)
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none, none
    first, end = _bounds(part)
    levels = suffix_levels(words[at], part, end)
    i, period = branching_tandems(levels, end)
    start = i - _common_suffix(levels, i, i + period, first[i])
    stop = i + 2 * period
    long = stop - start >= LEAST
    start, stop, period = start[long], stop[long], period[long]
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    one = (np.diff(start, prepend=-1) != 0) | (np.diff(stop, prepend=-1) != 0)
    return at[start[one]], (stop - start)[one], period[one]


def plant(words: list[bytes], doc_id: object) -> list[bytes]:
    """The words with the run that the id stands for; see the module."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def _batch(texts: list[bytes | None], ids: list) -> tuple[list[int], pa.Array, list[bytes]]:
    """(number of words, runs, collapsed text) of each text."""
    number: dict[bytes, int] = {}
    split = [plant((t or b"").split(), i) for t, i in zip(texts, ids)] if ids else [(t or b"").split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    first = np.cumsum(sizes) - sizes
    words = np.array([number.setdefault(w, len(number)) for own in split for w in own], np.int64)
    doc = np.repeat(np.arange(len(split)), sizes)
    start, length, period = find(words, doc)
    of = doc[start]
    offsets = np.searchsorted(of, np.arange(len(split) + 1))
    dropped = np.zeros(len(words) + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    dropped = np.cumsum(dropped) > 0
    collapsed = []
    for k, own in enumerate(split):
        if offsets[k] < offsets[k + 1]:
            gone = dropped[first[k] : first[k] + sizes[k]].tolist()
            own = [w for w, g in zip(own, gone) if not g]
        collapsed.append(b" ".join(own))
    rows = pa.StructArray.from_arrays([pa.array(start - first[of]), pa.array(length), pa.array(period)], fields=list(_RUN))
    return sizes.tolist(), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows), collapsed


def periodic_runs(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", planted: bool = False) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length, period) by start, and the ``collapsed`` text of every row.

    The collapsed text keeps a word unless a run holds it after the run's first period; one space joins what is kept.
    """
    rows = pick(documents, doc_id=id_col, body=text_col)
    schema = T.StructType([
        rows.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.DataType.fromDDL(RUNS)),
        T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch, "body")
            ids = batch.column("doc_id").to_pylist() if planted else []
            begin, held = 0, 0
            for k, text in enumerate(texts):
                held += len(text or b"")
                if held >= BATCH or k + 1 == len(texts):
                    sizes, found, collapsed = _batch(texts[begin : k + 1], ids[begin : k + 1])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(begin, k + 1 - begin), pa.array(sizes, pa.int64()), found,
                         pa.array(collapsed, pa.binary()).cast(pa.string())], names=schema.names)
                    begin, held = k + 1, 0

    return rows.mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period), and hashes of all runs and of the collapsed text."""
    best = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * -best.less DIV best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
