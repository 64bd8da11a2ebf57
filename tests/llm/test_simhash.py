import random

import numpy as np
import pytest
import xxhash

from metaloom.llm import simhash
from tests.llm import awkward


def brute_print(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: dict):
    names = list(prints)
    root = {n: n for n in names}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(names):
        for b in names[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in names}


@pytest.mark.parametrize("text", ["", None, "one", "one two THREE", "a b c d", "a b c d e a b c d e", "Él é   x\ty\nz w", awkward.sentence(3, 300)])
def test_fingerprint(text):
    got = simhash.fingerprint(None if text is None else text.encode())
    assert got % (1 << 64) == brute_print(text)


def test_codes_are_perfect():
    for _, code in simhash.segments():
        changes, count = code.patterns(0)
        assert (count == 1).all() and len(changes) == 1 << code.checks
        points = np.arange(min(1 << code.bits, 1 << 14), dtype=np.int64)
        home = points ^ changes[code.syndromes(points), 0]
        assert (code.syndromes(home) == 0).all() and (np.bitwise_count(points ^ home) <= code.radius).all()


@pytest.mark.parametrize("threshold", [0, 1, 2, 3, 4, 6])
def test_any_two_within_the_threshold_meet_at_a_home_anchor(threshold):
    r = random.Random(threshold)
    for _ in range(60):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), threshold):
            b ^= 1 << bit
        pair = np.array([a, b], np.uint64).view(np.int64)
        at, own, home = simhash.anchors(pair, threshold)
        homes = {(x, p) for x, p, h in zip(at.tolist(), own.tolist(), home.tolist()) if h}
        every = set(zip(at.tolist(), own.tolist()))
        one, two = pair.tolist()
        assert any((x, two) in every for x, p in homes if p == one) and any((x, one) in every for x, p in homes if p == two)


@pytest.mark.parametrize("block", [2, 4096])
def test_components_equal_brute_force(spark, block):
    r = random.Random(5)
    prints, n = {}, 0
    for _ in range(12):  # chains of near neighbours, dense balls, and strangers
        seed = r.getrandbits(64)
        for _ in range(r.choice([1, 3, 12])):
            point = seed
            for bit in r.sample(range(64), r.randint(0, 3)):
                point ^= 1 << bit
            prints[n] = point
            n += 1
            if r.random() < 0.3:
                seed = point
    points = np.array(list(prints.values()), np.uint64).view(np.int64)
    df = spark.createDataFrame([(x,) for x in set(points.tolist())], "fp bigint")
    from metaloom.llm.components import roots
    hung = {r_.node: r_.root for r_ in roots(simhash.links(df, 4, block)).collect()}
    got, want = {}, brute_components(prints)
    for i in prints:
        got.setdefault(hung.get(points[i], points[i]), set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(sorted(j for j in want if want[j] == c) for c in set(want.values()))


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = {r.doc_id: brute_print(r.text) for r in docs.collect()}
    want = brute_components(prints)
    assert got == {i: (prints[i], want[i]) for i in prints}


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    got = simhash.near_duplicates(docs).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.fp == 0, r.component_id))
    assert len(got) == len(awkward.rows())
    assert by[3] == by[4] == by[5] == {(True, 3)} and by[1] == by[2] == {(False, 1)} and by[11] == {(False, 10)}
    assert (True, 3) in by[None] and (False, None) in by[None]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r[0]) for r in kept.collect())) == sorted(["1", "3", "6", "None", "8", "9", "10"])
    assert simhash.near_duplicates(awkward.nothing(spark)).count() == 0 and simhash.one_of_each(awkward.nothing(spark)).count() == 0
