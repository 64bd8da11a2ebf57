"""Mixing sources to target weights by entropy balancing.

Wanted are rates r of the documents that stay as near as can be (in relative entropy) to taking each once, while the
words taken from every source meet its target and no rate is above ``most``. The solution of the dual is a tilt for each
source: r = min(most, exp(tilt * size)), sizes in units of the source's mean. The tilts are found by Newton steps; each is
one aggregation over (source, size) counts, kept within a bracket and halved where a step leaves it.

Rates are then rounded to copies, r down or up: documents of a source are dealt to chunks by hash, and in a chunk, from
long to short, each takes up what rounding has left open so far, so that a chunk misses its share by little more than its
shortest documents. Chunk numbers follow from the source's count, so that a large source has many.

Null and empty texts have size 0 and take nothing. Null source is a source, the last. Repeated rows count each.
A source without words has target 0. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaloom.llm.common import count_words, cut, joined_by_row, pick

WEIGHTS = (5, 2, 1)
MOST = 3
CHUNK_DOCS = 2000
#: Newton steps with bisection always end long before; more means a fault.
STEPS = 200
#: Relative miss of a source's target at which its tilt is found.
CLOSE = 1e-6


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Adds target to (source, n, words): a weighted share of all words, at most ``most`` times the source's words.

    The sources' weights repeat in order of their names. With level t, a source gets min(most * words, t * weight); t is
    found by taking sources as capped in order of the level at which they are.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = sources.select("*", F.expr("row_number() OVER (ORDER BY source NULLS LAST) - 1").alias("place"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.lit(float(most)) * F.col("words"))
    ranked = ranked.selectExpr("*", "row_number() OVER (ORDER BY most / weight, place) AS turn", "sum(words) OVER () AS total")
    ranked = ranked.selectExpr(
        "*", "coalesce(sum(most) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped",
        "sum(weight) OVER (ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open")
    ranked = ranked.withColumn("level", F.expr("(total - capped) / open"))
    # The level is right at the first source that it does not cap; before, it only rises.
    ranked = ranked.withColumn("level", F.expr("min(CASE WHEN level * weight <= most THEN struct(turn, level) END) OVER ()").getField("level"))
    return ranked.withColumn("target", F.expr("least(most, level * weight)")).select("source", "n", "words", "target")


def tilts(counts: DataFrame, wanted: DataFrame, most: float = MOST) -> DataFrame:
    """(source, tilt, unit): exp(tilt * size / unit) is a source's rate. ``counts``: (source, size, n), sizes above 0.

    ``wanted`` holds the targets. A target of all that the cap allows has an infinite tilt.
    """
    start = wanted.where("words > 0").select(
        "source", "target", (F.col("words") / F.col("n")).alias("unit"),
        F.lit(0.0).alias("tilt"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"),
        F.when(F.col("target") >= most * F.col("words") * (1 - CLOSE), float("inf")).when(F.col("target") <= 0, float("-inf")).alias("known"),
    )
    spread = cut(counts.join(start.select(F.col("source").alias("of"), "unit"), F.expr("source <=> of")).selectExpr("source", "size / unit AS x", "n * size AS words"))
    state = cut(start.withColumn("miss", F.lit(1.0)))
    for _ in range(STEPS):
        if not state.where(f"known IS NULL AND miss > {CLOSE}").limit(1).count():
            break
        open_ = state.where(f"known IS NULL AND miss > {CLOSE}").select(F.col("source").alias("of"), "tilt")
        rated = spread.join(open_, F.expr("source <=> of")).withColumn("r", F.exp(F.least(F.col("tilt") * F.col("x"), F.lit(math.log(most)))))
        sums = rated.groupBy("source").agg(
            F.sum(F.expr("words * r")).alias("taken"), F.sum(F.expr(f"CASE WHEN tilt * x < {math.log(most)} THEN words * r * x ELSE 0 END")).alias("slope"))
        sums = sums.withColumnRenamed("source", "of")
        joined = state.join(sums, F.expr("source <=> of"), "left")
        moved = joined.selectExpr(
            "source", "target", "unit", "tilt", "known", "taken", "slope", "coalesce(abs(taken - target) / target, miss) AS miss",
            "CASE WHEN taken < target THEN tilt ELSE low END AS low", "CASE WHEN taken > target THEN tilt ELSE high END AS high")
        newton = F.expr("tilt + (target - taken) / slope")
        # Outside the bracket, or with nothing left below the cap: halve it, or go out twice as far where it is open.
        halved = F.expr("""CASE WHEN low > double('-infinity') AND high < double('infinity') THEN (low + high) / 2
            WHEN taken < target THEN greatest(1, 2 * tilt) ELSE least(-1, 2 * tilt) END""")
        sound = F.expr("slope > 0") & (newton > F.col("low")) & (newton < F.col("high")) & (F.abs(newton - F.col("tilt")) <= 4 + F.abs("tilt"))
        state = cut(moved.select(
            "source", "target", "unit", "known", "miss", "low", "high",
            F.when(F.col("taken").isNull() | (F.col("miss") <= CLOSE), F.col("tilt")).when(sound, newton).otherwise(halved).alias("tilt"),
        ))
    else:
        raise ArithmeticError("the tilts were not found")
    return state.select("source", "unit", F.coalesce("known", "tilt").alias("tilt"))


def rounded(sizes: np.ndarray, rates: np.ndarray, most: int = MOST) -> np.ndarray:
    """Copies of documents from long to short, each the rate rounded so as to make up for those before.

    What few documents leave open is made up by a copy more or less of those that it is worth.
    """
    down, up = np.floor(rates + 1e-9).astype(np.int64), np.ceil(rates - 1e-9).astype(np.int64)
    out, owed = down.copy(), 0.0
    for i in np.flatnonzero(down < up).tolist():
        size, exact = sizes[i], rates[i] * sizes[i]
        if owed + exact - down[i] * size > size / 2:
            out[i] = up[i]
        owed += exact - out[i] * size
    for i in np.flatnonzero((sizes > 0) & (sizes < 2 * abs(owed))).tolist():
        change = min(max(round(owed / sizes[i]), -int(out[i])), most - int(out[i]))
        out[i] += change
        owed -= change * sizes[i]
    return out


def mix(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST, chunk_docs: int = CHUNK_DOCS,
) -> DataFrame:
    """doc_id, spot (a hash of id and text), source, size, source_size, target (its source's), rate, copies and taken of every document."""
    rows = pick(documents, doc_id=id_col, source=source_col, body=text_col)
    sized = cut(rows.select("doc_id", "source", count_words(F.col("body")).alias("size"), F.xxhash64("doc_id", "body").alias("spot")))
    counts = cut(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = counts.groupBy("source").agg(F.sum("n").alias("n"), F.sum(F.expr("n * size")).alias("words"))
    wanted = cut(targets(sources, weights, most))
    found = tilts(counts.where("size > 0"), wanted, most)
    known = wanted.join(found.withColumnRenamed("source", "of"), F.expr("source <=> of"), "left").select(
        F.col("source").alias("of"), F.col("words").alias("source_size"), "target", "unit", "tilt",
        F.ceil(F.col("n") / chunk_docs).cast("int").alias("chunks"))
    rated = sized.join(known, F.expr("source <=> of")).drop("of").withColumn(
        "rate", F.expr(f"CASE WHEN size > 0 THEN exp(least(tilt * (size / unit), {math.log(most)!r})) ELSE 1.0D END"))
    rated = rated.withColumn("rate", F.least("rate", F.lit(float(most)))).withColumn("chunk", F.pmod("spot", "chunks").cast("int"))
    dealt = rated.repartition("source", "chunk").sortWithinPartitions("source", "chunk", F.desc("size"), "spot", "doc_id")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            key = table.column("source").to_pylist(), table.column("chunk").to_pylist()
            at = len(key[0]) - 1
            while at > 0 and key[0][at - 1] == key[0][-1] and key[1][at - 1] == key[1][-1]:
                at -= 1
            yield from copied(table.slice(0, at), key)
            rest = table.slice(at)
        if rest is not None:
            yield from copied(rest, (rest.column("source").to_pylist(), rest.column("chunk").to_pylist()))

    def copied(table: pa.Table, key) -> Iterator[pa.RecordBatch]:
        n = table.num_rows
        if not n:
            return
        sizes, rates = (table.column(c).to_numpy() for c in ("size", "rate"))
        copies, start = np.zeros(n, np.int64), 0
        for end in range(1, n + 1):
            if end == n or key[0][end] != key[0][start] or key[1][end] != key[1][start]:
                copies[start:end] = rounded(sizes[start:end], rates[start:end], most)
                start = end
        yield from table.append_column("copies", pa.array(copies)).combine_chunks().to_batches()

    schema = T.StructType([*dealt.schema.fields, T.StructField("copies", T.LongType())])
    return dealt.mapInArrow(take, schema).select(
        "doc_id", "spot", "source", "size", "source_size", "target", "rate", "copies", F.expr("copies * size").alias("taken"))


def mixed(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns. Those without words stay once."""
    plan = mix(documents, id_col=id_col, text_col=text_col, source_col=source_col)
    taken = plan.groupBy("doc_id", "spot").agg(F.sum("copies").cast("int").alias("copies")).where("copies > 0")
    rows, names = joined_by_row(documents, id_col, text_col, taken)
    repeated = rows.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
