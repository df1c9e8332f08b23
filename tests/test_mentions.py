"""Grams of names and texts against plain search, and a load whose plans stay small."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graphloom.operators import aggregation, graph
from graphloom.plans import registry


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_grams_of_strings(monkeypatch, step):
    monkeypatch.setattr(graph, "STEP", step)
    texts = ["", "abcabcabc", "", "abc", "é😀é😀", "ab", "x", ""]
    column = pa.array(["skipped", *texts])[1:]
    for n in (1, 3, 6):
        want = {(i, int.from_bytes(bytes([n]) + t.encode()[a : a + n])) for i, t in enumerate(texts) for a in range(len(t.encode()) - n + 1)}
        row, gram = graph._grams(column, n)
        assert len(row) == len(want) and set(zip(row.tolist(), gram.tolist(), strict=True)) == want
        row, gram = graph._grams(column, n, lambda g: g % np.uint64(2) == 0)
        assert set(zip(row.tolist(), gram.tolist(), strict=True)) == {(i, g) for i, g in want if g % 2 == 0}


def test_few_grams_of_no_name_pass_the_map(spark):
    names = spark.range(20_000).select(F.concat(F.lit("customer#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("low"))
    anchors = graph._anchors(names).cache()
    n = anchors.count()
    bits, shift = graph._gram_map(anchors, n)
    known = lambda gram: bits[(slot := graph._slots(gram) >> shift) >> 3] >> (slot & 7).astype(np.uint8) & 1
    assert n == 20_000 and known(np.array([r.gram for r in anchors.collect()], np.int64)).all()
    rng = random.Random(1)
    _, gram = graph._grams(pa.array(["".join(rng.choices("abcdefgh", k=50_000))]), 6)
    assert known(gram).mean() < 0.05


def test_counted_relationships_give_the_same_stats(spark):
    entities = spark.createDataFrame([(n, "T", {}, 1) for n in ("a", "b", "c")], "name string, entity_type string, properties map<string,string>, ord int")
    rows = [("a", "R", "b")] * 3 + [("a", "S", "b"), ("a", "R", "gone"), ("a", "R", "gone"), ("", "R", "b"), (None, "R", "b")]
    rel = spark.createDataFrame(rows, "from_entity string, relationship_type string, to_entity string")
    found = graph.chunks_to_graph(entities, rel)
    chunks = entities.limit(0)
    for some in (rel, aggregation.count_relationships(rel)):
        assert graph.load_stats(entities, some, chunks, found["nodes"], found["edges"]).first().asDict() == {"nodes_created": 3, "relationships_created": 6, "chunks_created": 0, "nodes_distinct": 3, "edges_distinct": 2, "unmatched": 2}
    none = aggregation.count_relationships(rel.limit(0))
    assert graph.load_stats(entities, none, chunks, found["nodes"], found["edges"]).first()["relationships_created"] == 0


def test_the_load_builds_nothing_twice(spark):
    """The driver holds every plan: tables that are used several times are written, and no table of grams goes through it."""
    found = registry.QUERIES["e7_f8_load_stats"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 20 and plan.count("Relation") <= 30, plan  # 28 and 105 when each use built its own
    assert found.first()["relationships_created"] > 0
