"""Starts with the same first steps are walked from once, and each gets all that it reaches."""

import random

import pytest

from graphloom.operators import retrieval
from graphloom.sources.shared import written

EDGES = "src_id string, edge_type string, dst_id string"


def brute(starts, edges, hops):
    ahead, found = {}, set()
    for a, b in edges:
        ahead.setdefault(a, set()).add(b)
    for s in starts:
        seen, front = {s}, {s}
        found.add((s, s, 0))
        for h in range(1, hops + 1):
            front = {b for a in front for b in ahead.get(a, ())} - seen
            seen |= front
            found |= {(s, b, h) for b in front}
    return found


@pytest.mark.parametrize("part", [2, 512])
def test_against_plain_search(spark, monkeypatch, part):
    monkeypatch.setattr(retrieval, "PART", part)
    rng = random.Random(4)
    pairs = {(f"n{rng.randrange(30)}", f"n{rng.randrange(30)}") for _ in range(40)}  # with loops and circles
    pairs |= {(f"t{i}", f"n{j}") for i in range(12) for j in (1, 2)} | {("n1", f"t{i}") for i in range(7)} | {("n2", "t11")}  # twins that reach each other
    pairs |= {(f"u{i}", f"u{j}") for i in range(4) for j in range(4)}  # twins among their own nodes
    edges = spark.createDataFrame([(a, "E", b) for a, b in sorted(pairs)] * 2, EDGES)
    starts = [*(f"n{i}" for i in range(0, 30, 3)), *(f"t{i}" for i in range(12)), *(f"u{i}" for i in range(4)), "gone"]
    start = spark.createDataFrame([(s,) for s in [*starts, "t3"]], "node_id string")
    for hops, directed in ((0, True), (1, True), (4, True), (3, False)):
        got = [tuple(r) for r in retrieval.k_hop(start, edges, hops, directed=directed).collect()]
        want = brute(starts, pairs if directed else pairs | {(b, a) for a, b in pairs}, hops)
        assert len(got) == len(set(got)) and set(got) == want


def test_many_starts_through_the_same_nodes_are_one_walk(spark):
    links = [(f"s{i}", "E", f"m{j}") for i in range(200) for j in range(8)] + [(f"m{j}", "E", f"d{k}") for j in range(8) for k in range(50)]
    fronts = []

    def keep(df):
        out = written(df)
        fronts.append(out.count())
        return out

    found = retrieval.k_hop(spark.createDataFrame([(f"s{i}",) for i in range(200)], "node_id string"), spark.createDataFrame(links, EDGES), 2, materialize=keep)
    assert found.count() == found.distinct().count() == 200 * (1 + 8 + 50)
    assert fronts == [200, 8, 50]  # 200, 1600 and 10000 when each start had its own
