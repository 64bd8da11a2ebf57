"""Quality by a sparse ensemble of rules: tree paths as conjunctions, weighed by a lasso logistic regression, as columns.

1. *Statistics.* Every whole text gives a row of numbers (``STATISTICS``), computed in the tasks.
2. *Trees.* Boosted trees of depth 3 are grown on the labelled rows. Each path from a root to a node is a rule: a conjunction
   of lower and upper bounds on statistics. Equal rules, and those that hold for the same labelled rows, count once.
3. *Weights.* A logistic regression with an L1 penalty weighs the rules; most weights become zero, and those rules are gone.
   The penalty is the one, of a short list, with the least log loss on a fifth of the labelled rows, chosen by hash.
4. *Columns.* What is left is a Spark column over the statistics: the logistic function of the sum of the weights of the rules
   that hold. It is evaluated in the JVM for every row.

Labels are learned only from rows whose crc32(id as text) mod 5 is not 0, and from at most ``FIT_ROWS`` of them, those with
the least hash of the id; all statistics, and the scores, cover all rows. Labels, language, source and id are never inputs of
a score. What goes to the driver is these rows' statistics. The text is read twice: for the labelled rows and for all rows.

Defined results: a null text counts as empty, and an empty text has statistics of zero and a score. Rows with a null id are
scored and are not held out. Each row is scored by itself, so repeated rows have equal scores. Labels that are null or have a
null id are left out; of several labels of one id the largest counts; of several texts of one id, that with the least hash.
Without labels of both classes the score is the share of ones among the labels, with one of each added (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaloom.llm.common import cut, pick, utf8

STATISTICS = [
    "n_words", "word_length", "longest_word", "distinct_words", "distinct_pairs", "distinct_lines", "words_a_line", "upper", "digits",
    "symbols", "marks", "stops", "foreign", "other",
]
#: Labelled rows that trees and weights are fitted on.
FIT_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAST_ROWS = 30, 3, 0.2, 32, 10
PENALTIES = [0.03, 0.01, 0.003, 0.001]
HELD_OUT_OF = 5

_CLASS = np.full(256, 7)
for _k, _bytes in enumerate((b" \t\n\x0b\x0c\r", bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789", b"#*$%&|<>", b",;:!?\"'()-", b".")):
    _CLASS[list(_bytes)] = _k
_CLASS[128:192] = 8  # the second and later bytes of a character
_CLASS[192:] = 9


def statistics(text: bytes | None) -> list[float]:
    """The numbers of one text, in the order of ``STATISTICS``; shares are of characters that are not white space."""
    words = (text or b"").split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    white, upper, lower, digits, symbols, marks, stops, other, _, foreign = np.bincount(
        _CLASS[np.frombuffer(text, np.uint8)], minlength=10).tolist()
    chars = upper + lower + digits + symbols + marks + stops + other + foreign
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        float(n), chars / n, float(max(map(len, words))), len(set(words)) / n, len(set(zip(words, words[1:]))) / max(n - 1, 1),
        len(set(lines)) / len(lines), n / len(lines), upper / chars, digits / chars, symbols / chars, marks / chars, stops / n,
        foreign / chars, other / chars]


def with_statistics(rows: DataFrame, text_col: str) -> DataFrame:
    """The rows with the text replaced by its statistics."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != text_col)
    schema += "".join(f", {s} double" for s in STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.array([statistics(t) for t in utf8(batch, text_col)], np.float64).reshape(-1, len(STATISTICS))
            kept = [n for n in batch.schema.names if n != text_col]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + [pa.array(table[:, k].copy()) for k in range(len(STATISTICS))], names=kept + STATISTICS)

    return rows.mapInArrow(run, schema)


#: A conjunction: for some statistics, by number, the bounds low < value <= high.
Rule = tuple[tuple[int, float, float], ...]


@dataclass
class Ensemble:
    """The score is the logistic function of ``base`` and the weights of the rules that hold."""

    base: float
    rules: list[tuple[Rule, float]]

    def score(self, values: list[float]) -> float:
        """The score of one row, as the column computes it."""
        z = self.base + sum(w for rule, w in self.rules if all(low < values[k] <= high for k, low, high in rule))
        return float(1 / (1 + np.exp(-z)))

    def column(self) -> Column:
        """The score as an expression over the columns of the statistics."""
        total = F.lit(self.base)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for k, low, high in rule:
                if low != -np.inf:
                    holds = holds & (F.col(STATISTICS[k]) > F.lit(low))
                if high != np.inf:
                    holds = holds & (F.col(STATISTICS[k]) <= F.lit(high))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _cuts(column: np.ndarray) -> np.ndarray:
    """Values to split at: halfway between neighbouring quantiles."""
    points = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)))
    return (points[:-1] + points[1:]) / 2


def _tree(binned: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray) -> tuple[list[Rule], np.ndarray]:
    """(rules of all nodes below the root, step of each row) of one tree on gradients and their weights."""
    rules: list[Rule] = []
    step = np.zeros(len(gradient))

    def grow(rows: np.ndarray, bounds: dict[int, tuple[float, float]], depth: int) -> None:
        total, mass = gradient[rows].sum(), weight[rows].sum()
        best = (1e-9, -1, -1)
        if depth < DEPTH:
            for k, points in enumerate(cuts):
                own = binned[rows, k]
                g = np.cumsum(np.bincount(own, gradient[rows], len(points) + 1))[:-1]
                w = np.cumsum(np.bincount(own, weight[rows], len(points) + 1))[:-1]
                n = np.cumsum(np.bincount(own, minlength=len(points) + 1))[:-1]
                gain = g**2 / (w + 1) + (total - g) ** 2 / (mass - w + 1) - total**2 / (mass + 1)
                gain[(n < LEAST_ROWS) | (len(rows) - n < LEAST_ROWS)] = 0
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), k, int(gain.argmax()))
        if best[1] < 0:
            step[rows] = RATE * total / (mass + 1)
            return
        _, k, at = best
        low, high = bounds.get(k, (-np.inf, np.inf))
        point, left = float(cuts[k][at]), binned[rows, k] <= at
        for side, limits in ((rows[left], (low, point)), (rows[~left], (point, high))):
            inner = {**bounds, k: limits}
            rules.append(tuple((s, *inner[s]) for s in sorted(inner)))
            grow(side, inner, depth + 1)

    grow(np.arange(len(gradient)), {}, 0)
    return rules, step


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The paths of boosted trees, each once, in the order in which they were found."""
    cuts = [_cuts(x[:, k]) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], 1)
    z = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    found: dict[Rule, None] = {}
    for _ in range(TREES):
        p = _sigmoid(z)
        rules, step = _tree(binned, cuts, y - p, p * (1 - p))
        z += step
        found.update(dict.fromkeys(rules))
    return list(found)


def holding(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    """Which rules hold for which rows."""
    out = np.ones((len(x), len(rules)), bool)
    for j, rule in enumerate(rules):
        for k, low, high in rule:
            out[:, j] &= (x[:, k] > low) & (x[:, k] <= high)
    return out


def lasso(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """(constant, weights) of the least mean log loss plus ``penalty`` times the sum of the weights' sizes."""
    scale = np.maximum(x.std(0), 1e-9)
    centred = (x - x.mean(0)) / scale
    vector = np.random.default_rng(0).normal(size=x.shape[1])
    for _ in range(20):  # the largest curvature, by power iteration
        vector = centred.T @ (centred @ (vector / np.linalg.norm(vector)))
    rate = 1 / max(np.linalg.norm(vector) / len(y) / 4 * 1.05, 0.25)
    base, w, ahead, ahead_base, t = float(np.log(y.mean() / (1 - y.mean()))), np.zeros(x.shape[1]), np.zeros(x.shape[1]), None, 1.0
    ahead_base = base
    for _ in range(steps):
        error = _sigmoid(ahead_base + centred @ ahead) - y
        moved = ahead - rate * (centred.T @ error) / len(y)
        new = np.sign(moved) * np.maximum(np.abs(moved) - rate * penalty, 0)
        new_base = ahead_base - rate * error.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_base = new + (t - 1) / t_next * (new - w), new_base + (t - 1) / t_next * (new_base - base)
        w, base, t = new, new_base, t_next
    return float(base - (w / scale) @ x.mean(0)), w / scale


def fit(x: np.ndarray, y: np.ndarray, check: np.ndarray) -> Ensemble:
    """The ensemble for rows ``x`` with classes ``y``; rows with ``check`` choose the penalty."""
    ones = float(y.sum())
    if not 0 < ones < len(y):
        share = (ones + 1) / (len(y) + 2)
        return Ensemble(float(np.log(share / (1 - share))), [])
    rules = tree_rules(x, y)
    holds = holding(rules, x)
    _, once = np.unique(np.packbits(holds, axis=0), axis=1, return_index=True)  # rules that hold for the same rows are one
    once = np.sort(once)
    rules, holds = [rules[k] for k in once], holds[:, once].astype(np.float64)
    if not rules:
        return Ensemble(float(np.log(ones / (len(y) - ones))), [])
    train = ~check if 0 < y[~check].sum() < (~check).sum() and check.any() else np.ones(len(y), bool)
    test = check if check.any() else train

    def loss(penalty: float) -> float:
        base, w = lasso(holds[train], y[train], penalty)
        p = np.clip(_sigmoid(base + holds[test] @ w), 1e-9, 1 - 1e-9)
        return float(-np.mean(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)))

    base, w = lasso(holds, y, min(PENALTIES, key=loss))
    return Ensemble(base, [(rules[k], float(w[k])) for k in np.flatnonzero(np.abs(w) > 1e-6)])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def learn(documents: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_id_col: str, label_col: str) -> Ensemble:
    given = pick(labels, of=label_id_col, label=label_col).where("of IS NOT NULL AND label IS NOT NULL").where(~held_out(F.col("of")))
    given = given.groupBy("of").agg(F.max("label").cast("int").alias("label"))
    chosen = cut(given.orderBy(F.xxhash64("of"), "of").limit(FIT_ROWS))
    rows = pick(documents, doc_id=id_col, body=text_col)
    found = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("of"))  # FIT_ROWS ids and labels at most
    measured = with_statistics(found.select("of", "label", F.xxhash64("body").alias("place"), "body"), "body")
    one = measured.groupBy("of", "label").agg(F.min_by(F.struct(*STATISTICS), "place").alias("s"))
    got = sorted((r["place"], r["label"], tuple(r["s"])) for r in one.select(
        F.xxhash64("of").alias("place"), "label", "s").collect())
    x = np.array([r[2] for r in got], np.float64).reshape(-1, len(STATISTICS))
    y = np.array([float(r[1] == 1) for r in got])
    return fit(x, y, np.array([r[0] % 5 == 0 for r in got], bool))


def score_quality(
    documents: DataFrame, labels: DataFrame, *, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
    label_id_col: str = "doc_id", label_col: str = "quality",
) -> DataFrame:
    """doc_id, held_out, score and predicted (score of ``least`` or more) of every document, with its statistics."""
    ensemble = learn(documents, labels, id_col=id_col, text_col=text_col, label_id_col=label_id_col, label_col=label_col)
    measured = with_statistics(pick(documents, doc_id=id_col, body=text_col), "body")
    scored = measured.withColumn("score", ensemble.column())
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"), *STATISTICS)
