"""Quality rules with thresholds that adapt to language and source. DataFrame functions only.

Each document is measured; its rates are whole numbers (per mille). A rate's distribution in a language and source is
a log-linear quantile sketch: counts of values rounded down to seven significant bits, so a quantile is at most 1/64
too low. Counts add, so sketches merge in any order with the same result: (language, source) into language into
all. A group with few documents takes the sketch one level up. A rule rejects what lies beyond
median + SPREADS * (third - first quartile) + a slack for rates that hardly vary.

Null text has no words and fails. Null language or source is a group like others. Repeated rows count each.
Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaloom.llm.common import blanks_out, cut, pick, word_array

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Documents that a group's own thresholds need.
LEAST_DOCS = 100
SPREADS = 6
#: Rate -> slack. Per mille of words or lines, or of letters; word length in hundredths of a letter.
RULES = {"symbols": 100, "repeats": 400, "dup_lines": 500, "shouts": 200, "capitals": 200, "word_length": 300}


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are worked out once per row, whatever refers to them later (even inside a lambda)."""
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return rows.select("*", F.inline(F.array(made)))


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measure(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """Counts and base verdict of every document, with its language and source."""
    rows = pick(documents, doc_id=id_col, lang=lang_col, source=source_col, body=text_col)
    rows = rows.withColumn("body", F.coalesce("body", F.lit("")))
    rows = _once(rows, words=word_array(F.col("body")), lines=F.filter(F.split("body", "\n"), lambda x: F.length(blanks_out(x)) > 0))
    rows = rows.select(
        "doc_id", "lang", "source", "words",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(blanks_out(F.col("body"))).cast("bigint").alias("word_chars"),
        _without(F.col("body"), SYMBOLS).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _without(F.col("body"), "!?").cast("bigint").alias("n_shouts"),
        _without(F.col("body"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("bigint").alias("n_capitals"),
    )
    windows = F.transform(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.concat_ws(" ", w, F.get("words", i + 1), F.get("words", i + 2)),
    )
    rows = _once(rows, windows=windows).drop("words")
    # Sorted, equal windows are neighbours; a text without any needs no sorting.
    ordered = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    rows = _once(rows, ordered=F.when(F.size(F.array_distinct("windows")) < F.size("windows"), ordered)).drop("windows")
    twice = F.filter("ordered", lambda x, k: (x.w == F.get("ordered", k - 1).w) | (x.w == F.get("ordered", k + 1).w))
    places = F.sort_array(F.transform(twice, lambda x: x.i))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a.n + i + 3 - F.greatest(a.end, i)).alias("n"), (i + 3).alias("end")),
        lambda a: a.n,
    )
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("ordered")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def rates() -> dict[str, Column]:
    """The measured rates, as whole numbers; null where there is nothing to divide by."""
    per = lambda part, whole, scale: F.expr(f"CASE WHEN {whole} > 0 THEN {scale} * {part} DIV {whole} END")
    return {
        "symbols": per("n_symbols", "n_words", 1000), "repeats": per("n_repeat_words", "n_words", 1000),
        "dup_lines": per("n_dup_lines", "n_lines", 1000), "shouts": per("n_shouts", "n_words", 1000),
        "capitals": per("n_capitals", "word_chars", 1000), "word_length": per("word_chars", "n_words", 100),
    }


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, rule, bucket, n): the quantile sketches of documents that pass the base rules."""
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), rate.alias("value")) for name, rate in rates().items()])
    values = measured.where("NOT base_failed").select("lang", "source", F.inline(pairs))
    drop = "greatest(0, length(bin(value)) - 7)"
    values = values.where("value IS NOT NULL").withColumn("bucket", F.expr(f"shiftleft(shiftright(value, {drop}), {drop})"))
    return values.groupBy("lang", "source", "rule", "bucket").agg(F.count(F.lit(1)).alias("n"))


def _limits(counts: DataFrame, keys: list[str]) -> DataFrame:
    """docs and upper limit of each group and rule, from a sketch."""
    by = ", ".join([*keys, "rule"])
    run = counts.select(
        *keys, "rule", "bucket",
        F.expr(f"sum(n) OVER (PARTITION BY {by} ORDER BY bucket)").alias("upto"), F.expr(f"sum(n) OVER (PARTITION BY {by})").alias("docs"),
    )
    quantile = lambda quarters: F.min(F.expr(f"CASE WHEN 4 * upto >= {quarters} * docs THEN bucket END"))
    slack = F.expr("CASE rule " + " ".join(f"WHEN '{r}' THEN {s}" for r, s in RULES.items()) + " END")
    return run.groupBy(*keys, "rule").agg(
        F.first("docs").alias("docs"), (quantile(2) + SPREADS * (quantile(3) - quantile(1)) + F.first(slack)).alias("most"))


def thresholds(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, and a limit per rule, taken from the smallest group with enough documents."""
    merged = lambda *keys: counts.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
    own = _limits(counts, ["lang", "source"]).alias("o")
    lang = _limits(merged("lang"), ["lang"]).alias("l")
    every = _limits(merged(), []).alias("e")
    both = own.join(lang, F.expr("o.lang <=> l.lang AND o.rule = l.rule")).join(every, F.expr("o.rule = e.rule"))
    most = F.expr(f"CASE WHEN o.docs >= {least_docs} THEN o.most WHEN l.docs >= {least_docs} THEN l.most ELSE e.most END")
    limits = [F.max(F.when(F.col("rule") == r, F.col("most"))).alias(f"most_{r}") for r in RULES]
    return both.select("o.lang", "o.source", "o.rule", most.alias("most")).groupBy("lang", "source").agg(*limits)


def quality(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """Measures, base_failed, broken (the adaptive rules that a document breaks) and kept, for every document."""
    measured = cut(measure(documents, id_col=id_col, text_col=text_col, lang_col=lang_col, source_col=source_col))
    limits = thresholds(sketch(measured), least_docs).withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    joined = measured.join(limits, F.expr("lang <=> of_lang AND source <=> of_source"), "left")
    broken = F.array_compact(F.array(*[F.when(rate > F.col(f"most_{name}"), F.lit(name)) for name, rate in rates().items()]))
    joined = joined.withColumn("broken", broken).drop("of_lang", "of_source", *[f"most_{r}" for r in RULES])
    return joined.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS body FROM documents),
     w AS (SELECT *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words,
                  list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
     tri AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS x
             FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
     twice AS (SELECT r, x FROM tri GROUP BY r, x HAVING count(*) > 1),
     rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM tri JOIN twice USING (r, x)) GROUP BY r),
     c AS (SELECT r, doc_id, lang, source, len(words) AS n_words, length(regexp_replace(body, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
                  length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
                  len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                  length(regexp_replace(body, '[^!?]', '', 'g')) AS n_shouts,
                  length(regexp_replace(body, '[^A-Z]', '', 'g')) AS n_capitals, coalesce(rep.n, 0) AS n_repeat_words
           FROM w LEFT JOIN rep USING (r)),
     m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
     v AS (SELECT r, lang, source, base_failed, unnest(['symbols', 'repeats', 'dup_lines', 'shouts', 'capitals', 'word_length']) AS rule,
                  unnest([100, 400, 500, 200, 200, 300]) AS slack,
                  unnest([1000 * n_symbols // nullif(n_words, 0), 1000 * n_repeat_words // nullif(n_words, 0),
                          1000 * n_dup_lines // nullif(n_lines, 0), 1000 * n_shouts // nullif(n_words, 0),
                          1000 * n_capitals // nullif(word_chars, 0), 100 * word_chars // nullif(n_words, 0)]) AS val
           FROM m),
     v2 AS (SELECT *, greatest(0, length(bin(val)) - 7) AS s FROM v WHERE NOT base_failed AND val IS NOT NULL),
     v3 AS (SELECT *, (val >> s) << s AS b FROM v2),
     lo AS (SELECT lang, source, rule, count(*) AS docs, quantile_disc(b, 0.5) + 6 * (quantile_disc(b, 0.75) - quantile_disc(b, 0.25)) + max(slack) AS most
            FROM v3 GROUP BY ALL),
     ll AS (SELECT lang, rule, count(*) AS docs, quantile_disc(b, 0.5) + 6 * (quantile_disc(b, 0.75) - quantile_disc(b, 0.25)) + max(slack) AS most
            FROM v3 GROUP BY ALL),
     le AS (SELECT rule, quantile_disc(b, 0.5) + 6 * (quantile_disc(b, 0.75) - quantile_disc(b, 0.25)) + max(slack) AS most FROM v3 GROUP BY ALL),
     t AS (SELECT lo.lang, lo.source, lo.rule, CASE WHEN lo.docs >= 100 THEN lo.most WHEN ll.docs >= 100 THEN ll.most ELSE le.most END AS most
           FROM lo JOIN ll ON lo.lang IS NOT DISTINCT FROM ll.lang AND lo.rule = ll.rule JOIN le ON le.rule = lo.rule),
     bad AS (SELECT DISTINCT r FROM v JOIN t ON v.lang IS NOT DISTINCT FROM t.lang AND v.source IS NOT DISTINCT FROM t.source
             AND v.rule = t.rule WHERE v.val > t.most)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND bad.r IS NULL AS kept
FROM m LEFT JOIN bad USING (r)
"""
