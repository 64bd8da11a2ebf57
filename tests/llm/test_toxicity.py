import zlib

import pytest
from pyspark.sql import functions as F

from metaloom.llm import toxicity
from tests.llm import awkward

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.learn(docs, labels, id_col="doc_id", text_col="text")


@pytest.fixture(scope="module")
def model():
    words = {"stupid": 90, "idiot": 90, "moron": 80, "loser": 80, "worthless": 70, "pathetic": 60, "that": 500, "thing": 400, "the": 900, "with": 300, "and": 800}
    counts = {}
    for word, n in words.items():
        word = f"^^{word}$"
        for i in range(len(word) - 2):
            counts[word[i : i + 3]] = counts.get(word[i : i + 3], 0) + n
    return toxicity.Model(counts)


@pytest.mark.parametrize("hidden, words", [
    ("1d10t", ["idiot"]), ("m0r0n,", ["moron"]), ("$tup1d", ["stupid"]), ("p@thet1c!!", ["pathetic"]), ("stuuuupid", ["stupid"]), ("s.t.u.p.i.d", ["stupid"]),
    ("l-o-s-e-r", ["loser"]), ("m*ron", ["moron"]), ("wort|-|less", ["worthless"]), ("LOOOSER", ["loser"]), ("The", ["the"]), ("thing.", ["thing"]),
    ("that/thing", ["that", "thing"]), ("", []), ("***", []), ("2020", ["2020"]),
])
def test_channel_is_undone(model, hidden, words):
    assert toxicity.restored(hidden, model) == words


@pytest.mark.parametrize("hidden, word", [
    ("that/thing/" * 8 + "1d10t", "idiot"), ("the,and," * 20 + "m0r0n" + ",the" * 20, "moron"), ("http://that.thing/" + "the/1/" * 20 + "$tup1d", "stupid"),
    ("that.thing." * 9 + "7.s.t.u.p.i.d.that", "stupid"), ("=" * 70 + "m0r0n", "moron"), ("the-1-" * 30_000 + "l-o-s-e-r", "loser"),
])
def test_long_tokens_are_restored(model, hidden, word):
    assert len(hidden) > 64 and word in toxicity.restored(hidden, model)


@pytest.mark.parametrize("hidden, word", [
    ("stuupid", "stupid"), ("iidiioott", "idiot"), ("MORROON", "moron"), ("!diot", "idiot"), ("|oser", "loser"), ("*diot", "idiot"), ("idio*", "idiot"),
    ("stupi|)", "stupid"), ("(*oron)", "moron"),
])
def test_doubles_and_signs_at_the_edges_are_read(model, hidden, word):
    assert word in toxicity.restored(hidden, model)
    assert "thing" in toxicity.restored("thing!", model) and toxicity.restored("(!|*", model) == [] and "oxxo" in toxicity.restored("(oxxo)", model)


def test_spaced_letters(model):
    assert toxicity.spaced("and s t u p i d thing", model) == ["stupid"]
    assert toxicity.spaced("i d i 0 t", model) == ["idiot"]
    assert "stupid" in toxicity.spaced("S T U P I D M O R O N", model) and toxicity.spaced("a b the c d", model) == []
    assert toxicity.restore_text("the 1d10t\nand s t u p i d thing", model) == "the idiot\nand stupid thing"


PROBES = ["i  d  i  o  t", "i\nd\ni\no\nt", "idi ot", "st up id", "id.iot", "st\n\nup\tid", "1d 10t", "m0 r on", "id - iot"]


@pytest.mark.parametrize("hidden", PROBES)
def test_gaps_of_any_kind_are_read(learned, hidden):
    """Whatever parts the pieces of a word, and before and after plain words."""
    for text in (hidden, f"whatever something {hidden} something", f"something {hidden}\nwhatever"):
        assert learned.score(" ".join([text] * 3).encode()) > 0.5, text
    assert learned.score(b"of in on the to is it at by as or an be we he so up do") < 0.5


def test_a_word_anywhere_in_a_long_spaced_row_is_found(model):
    for gap in range(0, 40, 3):
        row = " ".join("the" * gap + "worthless" + "and" * 30)
        assert "worthless" in " ".join(toxicity.spaced(row, model)).replace(" ", "")


def test_scores_with_and_without_the_reachability_test_are_equal(spark, learned):
    """No token that is left undecoded has a weight."""
    import random

    rng = random.Random(5)
    tokens = {t for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(150).collect() for t in (r.text or "").split()}
    tokens = set(sorted(tokens)[::7])
    words = ["idiot", "stupid", "moron", "loser", "pathetic", "worthless", "trash", "the", "thing"]
    signs = "!|*#.-_/10345@$()<é'"
    for _ in range(2500):
        t = list(rng.choice(words))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(t) + 1)
            t[at:at + rng.randrange(2)] = rng.choice([rng.choice(signs), t[min(at, len(t) - 1)] if t else "x", rng.choice(signs) * 2, "|-|"])
        tokens.add("".join(t) if rng.random() < 0.8 else "".join(t).upper())
    tokens.discard("")
    wrong = [t for t in tokens if learned.weight(t) > 0 and not learned.reachable.may_matter(t)]
    assert wrong == [] and sum(learned.weight(t) > 0 for t in tokens) > 500
    skipped = sum(not learned.reachable.may_matter(t) for t in tokens)
    assert skipped > 0.3 * len(tokens)


def test_scores_equal_a_plain_computation(learned):
    """The score is the logistic function of the hits' number, weight and share."""
    import math

    for text in ("the 1d10t and thing", "st up id and i d i o t", "the and", "stupid moron stupid loser"):
        tokens = text.split()
        hits = [w for t in tokens if (w := learned.weight(t))] + [w for x in toxicity.spaced(text, learned.model) if (w := learned.of([x]))]
        hits += [w for row in learned.reachable.spans(text) if (w := learned.of(toxicity.viterbi(" ".join(row), learned.model)))]
        x = [1.0, math.log1p(len(hits)), math.log1p(sum(hits)), math.sqrt(len(hits) / len(tokens))]
        assert learned.score(text.encode()) == pytest.approx(1 / (1 + math.exp(-sum(a * b for a, b in zip(x, learned.factors)))))


def test_few_labels_are_enough_when_they_are_clear(spark):
    """The bound on the log odds asks for less when there is less."""
    docs = [(i, f"plain words number {i} of all kinds here " + ("filthyword again" if i % 10 == 0 else "nothing else")) for i in range(150)]
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in docs], "doc_id bigint, toxic int")
    scored = toxicity.score_toxicity(spark.createDataFrame(docs, "doc_id bigint, text string"), labels).collect()
    assert {r.doc_id for r in scored if r.predicted} == {i for i, _ in docs if i % 10 == 0}


def test_viterbi_is_the_cheapest_path(model):
    """Against all paths of small lattices."""
    from itertools import product
    for text in ("1d1", "m0r", "l0$3r", "aa1", "i d"):
        def cost(path):
            state, total = "^^", 0.0
            for letters, paid in path:
                total += paid
                for x in letters:
                    if x == " ":
                        if state != "^^":
                            total += model.cost(state, "$")
                            state = "^^"
                    else:
                        total += model.cost(state, x)
                        state = state[1] + x
            return total + model.cost(state, "$")
        best = min(product(*toxicity.lattice(text)), key=lambda p: (cost(p), "".join(x for x, _ in p)))
        assert toxicity.viterbi(text, model) == "".join(x for x, _ in best).split()


def test_trigram_counts_cover_all_documents(spark):
    df = spark.createDataFrame([("ab Ab. 1d",), (None,), ("ab!",)], "text string").repartition(3)
    assert {r.gram: r.n for r in toxicity.trigrams(df).collect()} == {"^^a": 3, "^ab": 3, "ab$": 3}


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_toxicity(docs, labels)
    got = scored.join(labels, "doc_id").collect()
    assert scored.count() == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held)
    toxic, clean = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    assert sum((a > b) + (a == b) / 2 for a in toxic for b in clean) >= 0.8 * len(toxic) * len(clean)  # some labels have no word to show


def test_hidden_words_score_like_plain_ones(learned):
    plain = learned.score(b"the and of stupid idiot with that moron thing")
    hidden = learned.score(b"the and of s t u p i d 1d10t with that m0r0n thing")
    assert plain > 0.5 and hidden > 0.5 > learned.score(b"the and of with that thing") and learned.score(b"") == learned.score(None) < 0.5


def test_doubles_and_signs_at_the_edges_score(learned):
    words = "stuupid iidiioott !diot *diot idio* (lown |oser".split()
    assert all(learned[w] > 0 for w in words) and learned["thing!"] == learned["(and"] == learned["will"] == 0
    assert all(learned.score(f"the and of {' '.join([w] * 3)} with that thing".encode()) > 0.5 for w in words)


def test_learning_uses_no_held_out_row(spark):
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    docs = labels.select("doc_id", F.concat(F.lit("text "), F.col("doc_id").cast("string")).alias("text"))
    used = {r.body for r in toxicity.labelled_sample(docs, labels, "doc_id", "text", "doc_id", "toxic").collect()}
    assert used == {f"text {i}" for i in range(200) if zlib.crc32(str(i).encode()) % 5}


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_TOXIC", 50)
    monkeypatch.setattr(toxicity, "FIT_CLEAN", 100)
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    docs = labels.select("doc_id", F.col("doc_id").cast("string").alias("text"))
    n = {r.toxic: r["count"] for r in toxicity.labelled_sample(docs, labels, "doc_id", "text", "doc_id", "toxic").groupBy("toxic").count().collect()}
    assert 20 <= n[1] <= 75 and 60 <= n[0] <= 130


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (6, 0), (99, 1)], "doc_id bigint, toxic int")
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == len(awkward.rows()) and all(r.score is not None for r in got) and not any(r.held_out for r in got if r.doc_id is None)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r.predicted for r in got)
    assert toxicity.score_toxicity(awkward.nothing(spark), labels).count() == 0
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.predicted for r in toxicity.score_toxicity(docs, none).collect()} == {0}
