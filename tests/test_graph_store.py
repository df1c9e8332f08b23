"""The bucketed store: touched buckets alone are written, cut-off loads and other streams lose nothing, nothing stored is shuffled."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from graphloom.operators import graph
from graphloom.sources.store import GraphStore, read_graph, write_graph
from graphloom.streaming.load import graph_upsert, stream_files

NODES, EDGES, CHUNKS = "node_id string, label string, name string, properties map<string,string>", "src_id string, edge_type string, dst_id string", "id string, text string, source string, section string, char_count int"


def data_files(root):
    return {str(p.relative_to(root)) for t in ("nodes", "edges", "chunks") for p in Path(root, t).rglob("*.parquet")}


def rows(frame):
    return sorted(str(r) for r in frame.collect())


def graph_of(spark, n, label="L"):
    nodes = spark.range(n).select(F.concat(F.lit("n"), "id").alias("node_id"), F.when(F.col("id") % 2 == 0, label).otherwise("").alias("label"), F.col("id").cast("string").alias("name"), F.create_map(F.lit("k"), F.col("id").cast("string")).alias("properties"))
    edges = spark.range(n).select(F.concat(F.lit("n"), "id").alias("src_id"), F.lit("E").alias("edge_type"), F.lit("n0").alias("dst_id"))
    return {"nodes": nodes, "edges": edges}


def test_an_upsert_writes_its_buckets_alone(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path), buckets=8)
    assert store.latest() is None
    store.upsert(graph_of(spark, 400))
    before, first = data_files(tmp_path), store.read()
    was = rows(first["nodes"])
    new = spark.createDataFrame([("n7", "", "7", {"more": "x"}), ("new", "", "y", {})], NODES)
    touched = {r[0] for r in new.select(F.pmod(F.hash("node_id"), F.lit(8))).collect()}
    assert store.upsert({"nodes": new}) == 1
    added = data_files(tmp_path) - before
    assert before <= data_files(tmp_path) and len(added) == len(touched) and {int(re.search(r"bucket=(\d+)", x)[1]) for x in added} == touched
    found = {r.node_id: r for r in store.read()["nodes"].collect()}
    assert len(found) == 401 and found["n7"].properties == {"k": "7", "more": "x"} and found["n7"].label == "" and found["new"].name == "y"
    assert rows(store.read(0)["nodes"]) == was and rows(store.read()["edges"]) == rows(first["edges"])


def test_what_is_stored_is_not_shuffled(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path), buckets=8)
    chunk = [(f"c{i}", "t", "s", "", 1) for i in range(50)]
    store.upsert(graph_of(spark, 300) | {"chunks": spark.createDataFrame(chunk, CHUNKS)})
    old = store.read()
    entities = spark.createDataFrame([("5", "L", {"a": "b"}, 1), ("fresh", "L", {}, 2)], "name string, entity_type string, properties map<string,string>, ord int")
    new_chunk = spark.createDataFrame([(*chunk[3], 1), ("new", "t", "s", "", 1, 2)], CHUNKS + ", ord int")
    merged = {
        "nodes": graph.merge_entity_nodes(old["nodes"], entities), "edges": graph.merge_edges(old["edges"], spark.createDataFrame([("n1", "E", "n0"), ("n1", "F", "n0")], EDGES)), "chunks": graph.merge_chunk_nodes(old["chunks"], new_chunk),
    }
    for name, df in merged.items():
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan[plan.index("Final Plan") : plan.index("Initial Plan")].split("\n") if "Final Plan" in plan else plan.split("\n")
        at = next(i for i, line in enumerate(lines) if f"graph_{name}_" in line)
        depth = lines[at].index("FileScan")
        above = []
        for line in reversed(lines[:at]):  # the scan's ancestors stand further left
            left = re.search(r"[A-Za-z*(]", line)
            if left and left.start() < depth:
                depth = left.start()
                above.append(line)
        assert "Bucketed: true" in lines[at] and not [x for x in above if "Exchange" in x], plan
    assert merged["nodes"].count() == 302 and merged["edges"].count() == 301 and merged["chunks"].count() == 51


def tools(spark, names, at):
    entities = spark.createDataFrame([(n, "Tool", {"seen": str(at)}, at) for n in names], "name string, entity_type string, properties map<string,string>, ord long")
    links = spark.createDataFrame([(a, b, "NEXT", {}, at) for a, b in zip(names, names[1:], strict=False)], "from_entity string, to_entity string, relationship_type string, properties map<string,string>, ord long")
    return entities, links


def test_loads_once_cut_off_and_over_each_other(spark, tmp_path, monkeypatch):
    store = GraphStore(spark, str(tmp_path), buckets=4)
    text = spark.createDataFrame([("alpha and beta", "f", None, 1)], "content string, source string, section string, ord long")
    assert store.load(*tools(spark, ["Alpha", "Beta"], 1), text, once=("a", 0)) == 0
    assert store.load(*tools(spark, ["Beta", "Gamma"], 2), once=("b", 0)) == 1  # another stream, the same epoch
    assert store.load(*tools(spark, ["Beta", "Gamma"], 9), once=("b", 0)) == 1  # a repeated one
    found = store.read()
    state = {n: rows(df) for n, df in found.items()}
    assert {(r.name, r.properties["seen"]) for r in found["nodes"].collect()} == {("Alpha", "1"), ("Beta", "2"), ("Gamma", "2")}
    assert sorted(r.edge_type for r in found["edges"].collect()) == ["MENTIONS", "MENTIONS", "NEXT", "NEXT"]
    put = GraphStore._insert
    with monkeypatch.context() as m, pytest.raises(OSError):  # lost after the nodes' buckets have been written
        m.setattr(GraphStore, "_insert", lambda self, name, *rest: put(self, name, *rest) if name == "nodes" else (_ for _ in ()).throw(OSError("lost")))
        store.load(*tools(spark, ["Delta", "Alpha"], 3), once=("a", 1))
    assert {n: rows(df) for n, df in store.read().items()} == state
    assert store.load(*tools(spark, ["Delta", "Alpha"], 3), once=("a", 1)) == 2 and store.read()["nodes"].count() == 4
    whole = graph.chunks_to_graph(*[x.unionByName(y) for x, y in zip(tools(spark, ["Alpha", "Beta"], 1), tools(spark, ["Beta", "Gamma"], 2), strict=True)], text)
    assert rows(whole["nodes"]) == state["nodes"] and rows(whole["edges"]) == state["edges"] and rows(whole["chunks"]) == state["chunks"]


def test_streams_with_checkpoints_of_their_own(spark, tmp_path):
    fields = "name string, seen string"

    def split(batch):
        entities = batch.select("name", F.lit("Tool").alias("entity_type"), F.create_map(F.lit("seen"), F.col("seen")).alias("properties"), F.lit(1).alias("ord"))
        return entities, spark.createDataFrame([], "from_entity string, to_entity string, relationship_type string, properties map<string,string>"), None

    def run(source, checkpoint):
        stream_files(spark, str(tmp_path / source), fields, graph_upsert(spark, str(tmp_path / "g"), split, 4), str(tmp_path / checkpoint)).awaitTermination(120)

    for source, names in (("a", ["A1", "A2"]), ("b", ["B1"])):
        spark.createDataFrame([(n, source) for n in names], fields).write.parquet(str(tmp_path / source))
    run("a", "ca")
    run("b", "cb")
    store = GraphStore(spark, str(tmp_path / "g"))
    assert {r.name for r in store.read()["nodes"].collect()} == {"A1", "A2", "B1"} and store.latest()["version"] == 1 and len(store.latest()["loads"]) == 2
    spark.createDataFrame([("A3", "a")], fields).write.mode("append").parquet(str(tmp_path / "a"))
    run("a", "ca")  # goes on from its checkpoint
    assert {r.name for r in store.read()["nodes"].collect()} == {"A1", "A2", "A3", "B1"}


def test_empty_labels_and_tables_survive(spark, tmp_path):
    nodes = spark.createDataFrame([("1", "", "x", {}), ("2", "a/b=c%", None, None)], NODES)
    write_graph({"nodes": nodes, "edges": spark.createDataFrame([], EDGES)}, str(tmp_path / "g"))
    back = read_graph(spark, str(tmp_path / "g"))
    assert rows(back["nodes"]) == rows(nodes) and back["edges"].count() == 0
    write_graph({"nodes": nodes.limit(1)}, str(tmp_path / "g"))  # over itself
    assert set(read_graph(spark, str(tmp_path / "g"))) == {"nodes"}


def test_vacuum_keeps_what_the_newest_version_names(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path), buckets=4)
    assert store.vacuum() == 0
    store.upsert(graph_of(spark, 60))
    store.upsert({"nodes": spark.createDataFrame([("n1", "", "1", {"a": "b"})], NODES)})
    lost = tmp_path / "nodes" / "bucket=0" / "generation=gunder_way"
    lost.mkdir()
    before = {n: rows(df) for n, df in store.read().items()}
    assert store.vacuum() == 1 and lost.exists()
    assert {n: rows(df) for n, df in store.read().items()} == before and store.latest()["version"] == 1
    with pytest.raises(ValueError):
        store.read(0)
    assert store.upsert({"nodes": spark.createDataFrame([("z", "", "1", {})], NODES)}) == 2 and store.read()["nodes"].count() == 61
