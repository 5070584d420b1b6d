"""Connected components, in one file and across many."""

import random

from driftwell.llm import bagminhash


def test_components(spark, monkeypatch):
    rnd = random.Random(2)
    pairs = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(60)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for x, y in pairs:
        a, b = sorted((root(x), root(y)))
        parent[b] = a
    linked = {v for x, y in pairs if x != y for v in (x, y)}
    wanted = {v: root(v) for v in linked}
    rows = [((x, -x), (y, -y)) for x, y in pairs]
    node = bagminhash.NODE
    links = spark.createDataFrame(rows, f"x {node}, y {node}")
    for size in (bagminhash.ROWS_PER_FILE, 20):
        monkeypatch.setattr(bagminhash, "ROWS_PER_FILE", size)
        got = {r.node.a: r.label.a for r in bagminhash.components(links.repartition(9)).collect()}
        assert got == wanted
    assert bagminhash.components(links.where("false")).count() == 0
