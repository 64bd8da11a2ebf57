import hashlib
import random
import zlib

import numpy as np

from metaloom.llm import runs
from metaloom.llm.queries import QUERIES
from metaloom.llm.runs import digest, periodic_runs
from tests.llm import awkward


def brute(words):
    """All runs by trying every period."""
    n, least = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(12, 2 * q):
                least.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in least.items())


def planted(words, doc_id):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    """The query's row of one document."""
    words = planted((text or "").encode().split(), doc_id)
    found = brute(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def fibonacci(n):
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def text(rng):
    kind = rng.random()
    if kind < 0.25:
        return [rng.choice("ab") for _ in range(rng.randrange(70))]
    if kind < 0.4:
        return fibonacci(rng.randrange(160))
    if kind < 0.8:
        out = []
        for _ in range(rng.randrange(8)):
            out += [rng.choice("abcd") for _ in range(rng.randrange(1, 10))] * rng.randrange(1, 6)
        return out
    return [rng.choice("abcdefghij") for _ in range(rng.randrange(200))]


def test_equals_brute_force_in_any_batch():
    rng = random.Random(7)
    for _ in range(300):
        docs = [text(rng) for _ in range(rng.randrange(1, 6))]
        number = {}
        words = np.array([number.setdefault(w, len(number)) for d in docs for w in d], np.int64)
        start, length, period = runs.find(words, np.repeat(np.arange(len(docs)), [len(d) for d in docs]))
        want, at = [], 0
        for d in docs:
            want += [(s + at, n, q) for s, n, q in brute(d)]
            at += len(d)
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == want


def test_long_runs():
    one = np.zeros(200_000, np.int64)
    assert [x.tolist() for x in runs.find(one, one)] == [[0], [200_000], [1]]
    period = np.random.default_rng(1).integers(0, 50_000, 30_000)
    words = np.concatenate([[60_000], np.tile(period, 4)[:100_000], [60_001]])
    assert [x.tolist() for x in runs.find(words, np.zeros_like(words))] == [[1], [100_000], [30_000]]


def test_spans_and_collapsed_text(spark):
    rows = [(1, "x " + "a b c " * 5 + "y"), (2, "a a a a a a a a a a a"), (3, "a a " * 13), (4, "one two three")]
    got = {r.doc_id: r for r in periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(r) for r in got[1].runs] == [(1, 15, 3)] and got[1].collapsed == "x a b c y"
    assert got[2].runs == [] and got[2].collapsed == "a a a a a a a a a a a"  # eleven words are no run
    assert [tuple(r) for r in got[3].runs] == [(0, 13, 1)] and got[3].collapsed == "a a"
    assert got[4].n_words == 3 and got[4].collapsed == "one two three"


def test_query_equals_brute_force(spark, sf):
    got = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, sf).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect())
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    short = [d for d in docs if len((d[1] or "").split()) < 3000]
    assert len(short) > 0.9 * len(docs) and len(got) == len(docs)
    have = {r[0]: r for r in got}
    assert all(have[i] == expected(i, t) for i, t in short)
    assert sum(r[1] > 0 for r in got) > 5


def test_awkward_rows(spark):
    rows = [r for r in awkward.rows() if r[0] != 8]
    found = digest(periodic_runs(awkward.frame(spark), planted=True)).collect()
    assert len(found) == len(awkward.rows())
    order = lambda r: (r[0] is None, r[0] or 0, repr(r))
    assert sorted((tuple(r) for r in found if r[0] != 8), key=order) == sorted((expected(r[0], r[1]) for r in rows), key=order)
    long = periodic_runs(awkward.frame(spark)).where("doc_id = 8").first()
    assert long.n_words == 30_021 and long.runs == []
    assert periodic_runs(awkward.nothing(spark)).count() == 0


def test_repeated_lines_in_very_many_rows(spark):
    """Each row is dealt with by itself: equal rows are not brought together."""
    df = spark.range(0, 4000, 1, 8).selectExpr("id AS doc_id", "repeat('same line of words here ', 20) AS text")
    found = periodic_runs(df)
    assert found.selectExpr("size(runs) AS n", "collapsed").distinct().collect() == [(1, "same line of words here")]
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
