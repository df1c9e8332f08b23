"""Components in few rounds, canonical nodes and edges, pruned similarity search, walks with a visited set."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.operators import graph, retrieval
from graphloom.operators.components import components
from graphloom.sources.shared import written

EDGES = "src_id string, edge_type string, dst_id string"


def test_a_long_chain_needs_few_rounds(spark):
    n, rounds = 10_000, []
    links = spark.range(n - 1).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"))
    order = F.xxhash64("x").alias("x"), F.xxhash64("y").alias("y")  # names in no order along the chain
    found = components(links.select(*order).repartition(4), lambda df: rounds.append(1) or written(df))
    assert len(rounds) <= 20 and found.count() == n - 1 and found.select("root").distinct().count() == 1


def test_components_against_plain_search(spark):
    rng = np.random.default_rng(3)
    links = [(f"n{a}", f"n{b}") for a, b in rng.integers(0, 120, (90, 2))] + [("hub", f"h{i}") for i in range(200)] + [("s", "s")]
    low = {x: x for p in links for x in p}
    for _ in low:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    assert {r.node: r.root for r in components(spark.createDataFrame(links, "x string, y string")).collect()} == {x: r for x, r in low.items() if x != r}
    assert components(spark.createDataFrame([], "x string, y string")).count() == 0


def test_edges_follow_their_canonical_nodes(spark):
    entities = spark.createDataFrame([("AWS Lambda", "T", {"a": "1"}, 1), ("AWS Lambda", "T", {}, 2), ("Lambda", "T", {"a": "2", "b": "3"}, 3), ("S3", "T", {}, 4), ("aws  lambda", "U", {}, 5)], "name string, entity_type string, properties map<string,string>, ord int")
    nodes = graph.merge_entity_nodes(None, entities)
    rel = spark.createDataFrame([("Lambda", "S3", "USES"), ("AWS Lambda", "S3", "USES"), ("S3", "Lambda", "STARTS")], "from_entity string, to_entity string, relationship_type string")
    edges = graph.resolve_edges(rel, nodes)
    resolved = graph.resolve_entities(entities, spark.createDataFrame([("lambda", "AWS lambda"), (None, "S3")], "a string, b string"))
    merged, mapping = graph.canonical_nodes(nodes, resolved)
    got = {(r.label, r.name): r.properties for r in merged.collect()}
    assert got == {("T", "AWS Lambda"): {"a": "1", "b": "3"}, ("T", "S3"): {}, ("U", "AWS Lambda"): {}}
    names = {r.node_id: r.name for r in merged.collect()}
    assert sorted((names[r.src_id], r.edge_type, names[r.dst_id]) for r in graph.rewrite_edges(edges, mapping).collect()) == [("AWS Lambda", "USES", "S3"), ("S3", "STARTS", "AWS Lambda")]


def cosines(rows, asked, k):
    def score(a, b):
        n = max(len(a), len(b))
        a, b = (np.array([*x, *[0.0] * (n - len(x))]) for x in (a, b))
        size = np.linalg.norm(a) * np.linalg.norm(b)
        return float(a @ b / size) if size else 0.0

    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return {q: sorted((-score(w, v), i) for i, v in good if i != q)[:k] for q, w in good if q in asked}


@pytest.mark.parametrize(("query_bytes", "range_bytes"), [(1 << 26, 1 << 24), (64, 200)])
def test_similar_rows_of_odd_vectors(spark, monkeypatch, query_bytes, range_bytes):
    monkeypatch.setattr(retrieval, "QUERY_BYTES", query_bytes)
    monkeypatch.setattr(retrieval, "RANGE_BYTES", range_bytes)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=1 + i % 4).tolist()) for i in range(60)]
    rows += [(100, []), (101, [0.0, 0.0]), (102, None), (103, [1.0, None]), (104, [float("nan")]), (105, [float("inf"), 1.0]), (None, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    asked = {0, 7, 13, 100, 101, 103}
    want = cosines(rows, asked, 6)
    got = {}
    for r in retrieval.top_k_similar(df.where(F.col("vec_id").isin(list(asked))), df, 6).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.score
    assert set(got) == set(want) == {0, 7, 13, 100, 101}
    assert all(len(got[q]) == 6 and all(abs(got[q][k + 1] + s) < 1e-9 for k, (s, _) in enumerate(h)) for q, h in want.items())
    assert retrieval.top_k_similar(df.where("false"), df, 6).count() == retrieval.top_k_similar(df, df.where("false"), 6).count() == 0


def test_far_groups_are_not_scored_and_tasks_return_their_best_alone(spark):
    rng = np.random.default_rng(1)
    centres = np.eye(16) * 10
    rows = [(i, (centres[i % 16] + rng.normal(size=16) * 0.1).tolist()) for i in range(6400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    pairs = spark.sparkContext.accumulator(0)
    queries = df.where("vec_id < 32")
    found = retrieval.top_k_similar(queries, df, 5, scored=pairs)
    assert all(r.vec_id % 16 == r.query_id % 16 for r in found.collect())
    assert pairs.value < 0.3 * 32 * 6400


def test_walks_see_each_node_once(spark):
    edges = spark.createDataFrame([("a", "E", "b"), ("b", "E", "a"), ("b", "E", "c"), ("c", "F", "d"), *[("hub", "E", f"x{i}") for i in range(50)], ("c", "E", "hub")], EDGES)
    start, fronts = spark.createDataFrame([("a",)], "node_id string"), []

    def keep(df):
        out = written(df)
        fronts.append(out.count())
        return out

    got = {r.node_id: r.hop for r in retrieval.k_hop(start, edges, 9, materialize=keep).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3, "hub": 3, **{f"x{i}": 4 for i in range(50)}} and fronts == [1, 1, 1, 2, 50, 0]
    capped = {r.node_id for r in retrieval.k_hop(start, edges, 9, max_degree=10).collect()}
    assert capped == {"a", "b", "c", "d", "hub"} and [tuple(r) for r in retrieval.hubs(edges, 10).collect()] == [("hub", 50)]
    assert {r.node_id for r in retrieval.k_hop(start, edges, 1, ("E",), directed=False).collect()} == {"a", "b"}
    paths = retrieval.match_path_rows(start, edges, ("E", "E", "F")).collect()
    assert [(r.nodes, [e.edge_type for e in r.edges]) for r in paths] == [(["a", "b", "c", "d"], ["E", "E", "F"])]
