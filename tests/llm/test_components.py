import random

from metaloom.llm.components import roots


def test_long_paths_and_stars(spark):
    r = random.Random(1)
    path = list(range(1000, 1040))
    r.shuffle(path)
    edges = list(zip(path, path[1:])) + [(5, i) for i in range(6, 40)] + [(-3, -3), (70, 71), (71, 70), (70, 71)]
    got = {x.node: x.root for x in roots(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    want = {i: 1000 for i in range(1001, 1040)} | {i: 5 for i in range(6, 40)} | {71: 70}
    assert got == want


def test_no_edges(spark):
    assert roots(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
