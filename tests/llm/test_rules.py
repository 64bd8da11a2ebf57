import zlib

import numpy as np
import pytest

from metaloom.llm import rules
from metaloom.llm.queries import QUERIES
from metaloom.llm.rules import STATISTICS, Ensemble, score_quality, statistics
from tests.llm import awkward


def test_statistics_of_a_text():
    got = dict(zip(STATISTICS, statistics("Ab cd cd 1# é\n\nAb cd cd 1# é".encode())))
    assert got["n_words"] == 10 and got["distinct_words"] == 0.4 and got["distinct_lines"] == 0.5 and got["words_a_line"] == 5
    assert got["longest_word"] == 2 and got["word_length"] == 18 / 10 and got["upper"] == 2 / 18 and got["symbols"] == 2 / 18
    assert got["foreign"] == 2 / 18 and got["digits"] == 2 / 18 and got["distinct_pairs"] == 5 / 9
    assert statistics(None) == statistics(b"") == statistics(b" \n\t") == [0.0] * len(STATISTICS)


def test_rules_are_paths_of_trees():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(2000, 4))
    y = ((x[:, 0] > 0.5) & (x[:, 2] <= 0.25)).astype(float)
    found = rules.tree_rules(x, y)
    assert all(1 <= len(r) <= rules.DEPTH and all(low < high for _, low, high in r) for r in found) and len(set(found)) == len(found)
    ensemble = rules.fit(x, y, np.arange(2000) % 5 == 0)
    scores = np.array([ensemble.score(r) for r in x])
    assert ((scores >= 0.5) == y).mean() > 0.98
    assert len(ensemble.rules) < len(found) / 2  # the lasso leaves few of them


def test_lasso_meets_its_conditions():
    """At the least loss, the slope equals the penalty for weights that are not zero and is no more for the others."""
    rng = np.random.default_rng(1)
    x = (rng.uniform(size=(1500, 12)) < 0.4).astype(float)
    y = (rng.uniform(size=1500) < 1 / (1 + np.exp(-(2 * x[:, 0] - 3 * x[:, 5] + 0.5)))).astype(float)
    base, w = rules.lasso(x, y, 0.02, steps=3000)
    slope = ((y - 1 / (1 + np.exp(-(base + x @ w)))) @ ((x - x.mean(0)) / x.std(0))) / len(y)
    assert set(np.flatnonzero(np.abs(w) > 1e-9)) >= {0, 5} and (np.abs(w) < 1e-9).any()
    assert np.allclose(slope[np.abs(w) > 1e-9], 0.02 * np.sign(w[np.abs(w) > 1e-9]), atol=1e-5) and np.abs(slope).max() < 0.02 + 1e-5


def test_columns_say_what_the_ensemble_says(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(size=(60, len(STATISTICS)))
    ensemble = Ensemble(0.3, [(((0, -np.inf, 0.5), (3, 0.2, np.inf)), 1.5), (((5, 0.1, 0.7),), -2.25), (((1, float(x[0, 1]), np.inf),), 0.5)])
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i int, " + ", ".join(f"{s} double" for s in STATISTICS))
    got = [r.score for r in rows.withColumn("score", ensemble.column()).orderBy("i").collect()]
    assert got == pytest.approx([ensemble.score(list(r)) for r in x], abs=1e-12)


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in QUERIES["op12_quality_rules"](spark, sf).collect()}
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for i, r in found.items())
    tested = [(found[r.doc_id], r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in found and found[r.doc_id].held_out]
    assert len(tested) > 50 and np.mean([r.predicted == q for r, q in tested]) > 0.97
    again = {r.doc_id: r.score for r in QUERIES["op12_quality_rules"](spark, sf).collect()}
    assert again == {i: r.score for i, r in found.items()}


def test_held_out_labels_are_not_learned(spark):
    """Turning them round changes no score."""
    docs = [(i, ("good words of many kinds here %d and more %d" % (i, i * 7)) if i % 2 else "# # # # bad bad") for i in range(400)]
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    scores = []
    for turned in (False, True):
        labels = spark.createDataFrame([(i, 1 - i % 2 if turned and out(i) else i % 2) for i, _ in docs], "doc_id long, quality int")
        scores.append({r.doc_id: r.score for r in score_quality(frame, labels).collect()})
    assert scores[0] == scores[1] and all((s >= 0.5) == (i % 2 == 1) for i, s in scores[0].items())


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(1, None), (None, 1), (1, 0), (99, 1)], "doc_id bigint, quality int")
    found = score_quality(awkward.frame(spark), labels.selectExpr("*", "'x' AS text", "1 AS DOC_ID"))
    rows = found.collect()
    assert len(rows) == len(awkward.rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    empty = {r.score for r in rows if r.n_words == 0}
    assert len(empty) == 1 and not [r for r in rows if r.doc_id is None and r.held_out]
    assert score_quality(awkward.nothing(spark), labels).count() == 0
    assert {r.score for r in score_quality(awkward.frame(spark), labels.where("false")).collect()} == {0.5}
    assert all(r.score > 0.5 for r in score_quality(awkward.frame(spark), labels.where("quality = 1")).collect())
