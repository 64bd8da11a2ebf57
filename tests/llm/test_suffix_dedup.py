import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaloom.llm import suffix_dedup
from tests.llm import awkward


def covered(texts, least=50):
    """For each text, the words inside a run of ``least`` words that occurs at another place too."""
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + least]) for w in split for i in range(len(w) - least + 1))
    return [{p for i in range(len(w) - least + 1) if seen[tuple(w[i : i + least])] > 1 for p in range(i, i + least)} for w in split]


def spans_of(row):
    return {p for s in row.spans for p in range(s.start, s.end)}


def test_rolling_hashes():
    words = np.random.default_rng(1).integers(0, 1 << 63, 400).astype(np.uint64)
    words[200:260] = words[20:80]
    rolling = suffix_dedup.Rolling(words, suffix_dedup._BASES[0])
    assert rolling.of(np.array([20, 30]), 50).tolist() == rolling.of(np.array([200, 210]), 50).tolist()
    assert len(set(rolling.of(np.arange(351), 50).tolist())) == 351 - 11


def test_any_window_keeps_the_same_place():
    words = np.random.default_rng(2).integers(0, 1 << 63, 500).astype(np.uint64)
    kept = suffix_dedup.kept_positions(words)
    assert (np.diff(kept) <= suffix_dedup.WINDOW).all()
    passage = words[100:150]
    inside = kept[(kept >= 100 + 0) & (kept < 100 + suffix_dedup.WINDOW)] - 100
    other = suffix_dedup.kept_positions(np.concatenate([words[300:333], passage, words[400:420]])) - 33
    assert set(inside) & set(other)


def corpus(seed):
    r = random.Random(seed)
    text = lambda n: " ".join(f"w{r.randrange(10**9)}" for _ in range(n))
    passages = [text(n) for n in (50, 51, 58, 49, 34, 120, 75)]
    docs = []
    for _ in range(60):
        parts = []
        for _ in range(r.randint(1, 4)):
            parts += [text(r.randint(0, 40)), r.choice(passages)] if r.random() < 0.6 else [text(r.randint(1, 90))]
        docs.append(" ".join(parts))
    half = passages[5].split()
    return docs + [docs[0], " ".join(half[20:90]) + " " + text(5), text(3) + " " + " ".join(half[60:]), text(7) + " " + " ".join(half[:55])]


@pytest.mark.parametrize("seed, partitions", [(1, 1), (2, 7), (3, 3)])
def test_passages_equal_brute_force(spark, seed, partitions):
    texts = corpus(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(partitions)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = {r.doc_id: r for r in suffix_dedup.repeated_passages(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    want = covered(texts)
    assert all(got[i].n_words == len(t.split()) for i, t in enumerate(texts))
    assert [spans_of(got[i]) for i in range(len(texts))] == want
    assert all(s.end - s.start >= 50 for i in range(len(texts)) for s in got[i].spans)


def test_two_passages_that_recur_only_apart_are_none(spark):
    """Pieces that touch and have different partners make no passage of 50 words."""
    r = random.Random(9)
    text = lambda n: " ".join(f"w{r.randrange(10**9)}" for _ in range(n))
    left, right = [text(48) for _ in range(4)], [text(48) for _ in range(3)]
    apart = [a + " " + b for a in left for b in right]
    together = [text(3) + " " + left[0] + " " + right[0][: right[0].index(" ") * 4]]
    for texts in (apart, apart + together, [t + " " + text(30) for t in apart]):
        got = {x.doc_id: x for x in suffix_dedup.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
        assert [spans_of(got[i]) for i in range(len(texts))] == covered(texts)
        assert [later_of(got[i]) for i in range(len(texts))] == marked_before(texts)


@pytest.mark.parametrize("seed", range(4))
def test_short_vocabulary_equals_brute_force(spark, seed):
    """Few different words: passages overlap themselves, and hashes of grams tie."""
    r = random.Random(seed)
    texts = [" ".join(r.choice("ab" if k % 3 else "abcdefgh") * r.randint(1, 2) for _ in range(r.randint(40, 130))) for k in range(25)]
    texts += ["x " * 70, "x " * 51, "a b " * 40, "a b " * 26 + "c", texts[0] + " " + texts[1], "x " * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {x.doc_id: x for x in suffix_dedup.repeated_passages(df).collect()}
    assert [spans_of(got[i]) for i in range(len(texts))] == covered(texts)
    assert [later_of(got[i]) for i in range(len(texts))] == marked_before(texts)


def marked_before(texts, least=50):
    """For each text, the words inside a run of ``least`` words that occurs before too."""
    seen, marked = set(), []
    for words in ((t or "").split() for t in texts):
        marked.append(set())
        for i in range(len(words) - least + 1):
            run = tuple(words[i : i + least])
            if run in seen:
                marked[-1] |= set(range(i, i + least))
            seen.add(run)
    return marked


def later_of(row):
    return {p for s in row.later for p in range(s.start, s.end)}


def test_later_goes_as_far_as_an_earlier_copy(spark):
    r = random.Random(7)
    text = lambda n: " ".join(f"w{r.randrange(10**9)}" for _ in range(n))
    passage = text(120).split()
    texts = [text(4) + " " + " ".join(passage[a:b]) + " " + text(6) for a, b in ((30, 81), (14, 97), (14, 97), (0, 120), (20, 100), (30, 81))]
    got = {x.doc_id: x for x in suffix_dedup.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert [later_of(got[i]) for i in range(6)] == marked_before(texts)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_later_equals_brute_force(spark, seed):
    texts = corpus(seed)
    got = {x.doc_id: x for x in suffix_dedup.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert [later_of(got[i]) for i in range(len(texts))] == marked_before(texts)


def test_query_equals_brute_force(spark, sf):
    from metaloom.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op2_suffix_dedup"](spark, sf).collect()}
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    read = lambda s: {p for x in s.split(",") if x for p in range(*map(int, x.split(":")))}
    assert [read(got[i].spans) for i, _ in docs] == covered([t for _, t in docs])
    assert [read(got[i].later) for i, _ in docs] == marked_before([t for _, t in docs])


def test_a_passage_of_very_many_rows_is_dealt_to_many_tasks(spark):
    """What tells apart the rows of one key is part of the order in which they are dealt."""
    rows = spark.range(0, 40_000, 1, 4).selectExpr("id AS doc_id", "CAST(0 AS BIGINT) AS spot", "CAST(0 AS INT) AS pos", "CAST(7 AS BIGINT) AS key")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found, _ = suffix_dedup.equal_to_a_neighbour(rows, "key", ("doc_id", "spot", "pos"))
        per_file = found.groupBy(F.input_file_name()).count().collect()
        assert found.count() == 40_000 and max(r["count"] for r in per_file) < 10_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_passage_in_very_many_documents(spark):
    r = random.Random(4)
    text = lambda n: " ".join(f"w{r.randrange(10**9)}" for _ in range(n))
    passage = text(60)
    texts = [f"{text(5)} {passage} {text(6)}" for _ in range(400)] + [text(80) for _ in range(50)]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = {x.doc_id: x for x in suffix_dedup.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert all([tuple(s) for s in got[i].spans] == [(5, 65)] for i in range(400)) and all(not got[i].spans for i in range(400, 450))
    assert [i for i in range(450) if got[i].n_later == 0] == [0, *range(400, 450)]


def test_shortest_passages(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id bigint, text string")
    with pytest.raises(ValueError, match="24"):
        suffix_dedup.repeated_passages(df, min_words=23)


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    got = suffix_dedup.repeated_passages(docs).collect()
    assert len(got) == len(awkward.rows())
    by = {r.doc_id: ([tuple(s) for s in r.spans], r.n_later) for r in got}
    assert by[1] == ([(0, 120)], 0) and by[2][0] == [(0, 120)] and by[2][1] == 120
    assert all(by[i] == ([], 0) for i in (3, 4, 5, 6, 8, 9, 10, 11, None))
    assert suffix_dedup.repeated_passages(awkward.nothing(spark)).count() == 0
