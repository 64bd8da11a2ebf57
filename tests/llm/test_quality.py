import re
from collections import Counter

import duckdb

from metaloom.llm import quality
from tests.llm import awkward

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(grams)
    repeated = {p for i, g in enumerate(grams) if count[g] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated),
            len(words) < 50 or 100 * len(repeated) > 50 * len(words))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_measures_equal_brute_force(spark):
    texts = [None, "", " ", "a", "a b", "a b c", "a b c a b c", "a a a a", "x\ny\nx\n\n \nx", "#*$ é é\x0b| <>",
             "the cat sat. the cat sat on the cat sat on it", ("one two three four five " * 30), awkward.sentence(1, 70) + " " + awkward.sentence(1, 30)]
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], "doc_id int, text string, lang string, source string")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in quality.measure(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_no_python_in_the_plan(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = quality.quality(docs)._jdf.queryExecution().toString() + quality.measure(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_sketches_merge_to_the_same_quantiles(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    measured = quality.measure(docs)
    whole = {tuple(r) for r in quality.sketch(measured).collect()}
    from pyspark.sql import functions as F
    parts = quality.sketch(measured.where("doc_id % 2 = 0")).unionByName(quality.sketch(measured.where("doc_id % 2 = 1")))
    merged = parts.groupBy("lang", "source", "rule", "bucket").agg(F.sum("n").alias("n")).select("lang", "source", "rule", "bucket", "n")
    assert {tuple(r) for r in merged.collect()} == whole


def test_thresholds_follow_the_group(spark):
    """The same symbols are usual in one source and odd in another."""
    clean = lambda i: awkward.sentence(i, 60)
    marked = lambda i: " ".join(w + "#" * 2 for w in clean(i).split())
    rows = [(i, clean(i), "en", "plain") for i in range(120)] + [(i, marked(i), "en", "marked") for i in range(200, 320)] + [(999, marked(999), "en", "plain")]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    assert [r.doc_id for r in quality.quality(df).where("NOT kept").collect()] == [999]


def test_clean_rows_are_kept_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in quality.quality(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    judged = Counter((q, got[i].kept) for i, q in labels if not got[i].base_failed)
    assert judged[1, False] <= 0.02 * judged[1, True] and judged[0, True] <= 0.1 * max(1, judged[0, False])


def test_awkward_rows(spark):
    got = quality.quality(awkward.frame(spark)).collect()
    assert len(got) == len(awkward.rows())
    want = sorted((brute(r[1]) for r in awkward.rows()), key=repr)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr) == want
    assert quality.quality(awkward.nothing(spark)).count() == 0
