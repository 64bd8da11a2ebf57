import math
import random

import pytest

from metaloom.llm import negatives
from metaloom.llm.negatives import mine

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def usable(row):
    i, v, label = row
    return i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95):
    ok = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in filter(usable, rows)]
    out = []
    for i, q, label in ok:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, own) for j, v, own in ok if j != i)
        for s, j, _ in [r for r in scored if r[2] == label][:positives]:
            near = [r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s]
            out += [(i, j, rank, r[1], -s, -r[0]) for rank, r in enumerate(near[:negatives], 1)]
    return sorted(out)


def rows(rng, n, dims=12, labels=4):
    return [(i, [round(rng.gauss(0.1, 0.3), 3) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


def got(spark, data, **more):
    return sorted(tuple(r) for r in mine(spark.createDataFrame(data, SCHEMA).repartition(5), **more).collect())


@pytest.mark.parametrize("block,least,anchors", [(7, 1, 3), (8192, 4096, 64), (20, 50, 2)])
def test_equals_brute_force(spark, monkeypatch, block, least, anchors):
    for name, value in (("BLOCK", block), ("LEAST_ROWS", least), ("ANCHORS", anchors)):
        monkeypatch.setattr(negatives, name, value)
    data = rows(random.Random(block), 400)
    want = brute([(i, [float(x) for x in v], label) for i, v, label in as_floats(data)], every=20)
    assert got(spark, data, anchor_every=20) == want and len(want) > 100


def as_floats(data):
    import numpy as np

    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in data]


def test_many_equal_vectors_and_labels(spark):
    rng = random.Random(4)
    same = [0.25, 0.5, -0.125, 0.75]
    data = [(i, same if i % 3 == 0 else [round(rng.uniform(-1, 1), 2) for _ in range(4)], 1 if i % 2 else rng.randrange(3)) for i in range(600)]
    assert got(spark, data) == brute(as_floats(data))


def test_awkward_rows(spark):
    rng = random.Random(5)
    data = rows(rng, 200, 6, 2)
    data += [(None, [1.0], 1), (1000, None, 1), (1050, [1.0, None], 1), (1100, [float("nan")], 0), (1150, [float("inf"), 1.0], 0), (1200, [], 0), (1250, [0.5, 0.5], None)]
    data += [data[3], data[50], (50, [0.0] * 6, 1), (-50, [0.5, -0.25, 0.125, 1.0, 0.0, 0.5, 0.75, 0.25], 1), (1300, [100.0] * 6, 1)]
    frame = spark.createDataFrame([(*r, "x", 7) for r in data], SCHEMA + ", Label string, id int")
    found = sorted(tuple(r) for r in mine(frame).collect())
    assert found == brute(as_floats(data))
    assert mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mine(spark.createDataFrame([(0, [1.0], 1)], SCHEMA)).count() == 0


def test_scores_past_24_and_53_bits(spark):
    rng = random.Random(6)
    for scale in (1, 3_000, 2_000_000):
        data = [(i, [float(rng.randrange(-scale, scale)) for _ in range(5)], i % 3) for i in range(250)]
        assert got(spark, data) == brute(as_floats(data))
    with pytest.raises(Exception, match="32 bits"):
        got(spark, [(0, [1e30], 1), (1, [1.0], 1)])


def test_bounds_leave_rows_unread():
    """A row that cannot count is not read to its end."""
    import numpy as np

    rng = np.random.default_rng(3)
    dims = np.concatenate([rng.integers(-300, 300, (8, 5000)), rng.integers(-3, 3, (56, 5000))]).astype(np.int32)
    block = negatives.Block(np.arange(5000), np.ones(5000, np.int64), dims, 64)
    anchor = negatives.Anchor(-1, 1, dims[:, 17].astype(np.int64))
    exact, read = dims.T.astype(np.int64) @ anchor.vector, []
    least = np.partition(exact, -5)[-5]
    alive = lambda low, high: read.append(len(high)) or high >= least
    rows_left, scores = anchor.scan(block, np.arange(5000), alive)
    assert rows_left.tolist() == np.flatnonzero(exact >= least).tolist() and scores.tolist() == exact[exact >= least].tolist()
    assert read[0] == 5000 and min(read[2:]) < 50
