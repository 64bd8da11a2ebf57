import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaloom.llm import mixing
from tests.llm import awkward

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(words: dict, weights=(5, 2, 1), most=3):
    """Caps and shares the excess out again until none is above."""
    names = sorted(words, key=lambda n: (n is None, (n or "").encode()))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, capped = sum(words.values()), {}
    while True:
        rest, open_ = total - sum(capped.values()), [n for n in names if n not in capped]
        share = {n: rest * weight[n] / sum(weight[m] for m in open_) for n in open_}
        over = {n: most * words[n] for n in open_ if share[n] > most * words[n]}
        if not over:
            return capped | share
        capped |= over


@pytest.mark.parametrize("words", [
    {"a": 10, "b": 1000, "c": 1000}, {"a": 0, "b": 5}, {"a": 7}, {None: 50, "z": 50, "é": 1}, {"a": 1, "b": 1, "c": 1, "d": 900, "e": 2, "f": 3},
])
def test_targets_equal_repeated_sharing(spark, words):
    df = spark.createDataFrame([(k, 1, v) for k, v in words.items()], "source string, n bigint, words bigint")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(brute_targets(words))


def test_mix_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = mixing.mix(docs).collect()
    texts = {r.doc_id: (r.source, len(WORD.findall(r.text or ""))) for r in docs.collect()}
    assert {r.doc_id: (r.source, r["size"]) for r in found} == texts
    sizes = {}
    for source, n in texts.values():
        sizes[source] = sizes.get(source, 0) + n
    want = brute_targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
    for source in sizes:
        taken = sum(r.taken for r in found if r.source == source)
        shortest = min(r["size"] for r in found if r.source == source)
        assert abs(taken - want[source]) <= max(2 * shortest, 0.01 * want[source])
    again = {(r.doc_id, r.taken) for r in mixing.mix(docs.repartition(3)).collect()}
    assert again == {(r.doc_id, r.taken) for r in found}


def test_rates_are_the_dual_solution(spark, sf):
    """exp(tilt * size), capped, with the expected words on target."""
    found = mixing.mix(spark.read.parquet(f"{sf}/documents.parquet")).where("size > 0")
    sums = found.groupBy("source").agg(F.sum(F.col("rate") * F.col("size")).alias("got"), F.first("target").alias("target")).collect()
    assert all(r.got == pytest.approx(r.target, rel=1e-5) for r in sums)
    for source in {r.source for r in sums}:
        pairs = [(r["size"], r.rate) for r in found.where(F.col("source") == source).collect() if r.rate < 2.999]
        tilt = [np.log(rate) / size for size, rate in pairs]
        assert tilt == pytest.approx([tilt[0]] * len(tilt), rel=1e-6, abs=1e-12) if tilt else True


def test_rounding_makes_up():
    r = np.random.default_rng(2)
    sizes = np.sort(r.integers(1, 500, 300))[::-1]
    rates = r.uniform(0, 3, 300)
    copies = mixing.rounded(sizes, rates)
    assert ((copies == np.floor(rates)) | (copies == np.ceil(rates))).all() and abs((copies - rates) @ sizes) < 20


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    found = mixing.mix(docs).collect()
    assert len(found) == len(awkward.rows()) and all(r.taken <= 3 * r["size"] for r in found)
    assert all(r.taken == 0 for r in found if r.doc_id in (3, 4, 5)) and {r.source for r in found} == {"a", "b", "c", "é", None}
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in found)
    assert mixing.mix(awkward.nothing(spark)).count() == 0 and mixing.mixed(awkward.nothing(spark)).count() == 0
    blank = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", "b", 0)], awkward.COLUMNS)
    assert [(r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0.0, 0), (0.0, 0)]
