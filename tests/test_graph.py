import json
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphloom.functions.text import chunk_id, detect_content_type
from graphloom.operators import aggregation, chunking, extraction, graph, retrieval, validation
from graphloom.sources import files, markup, store
from graphloom.streaming.load import graph_upsert

PROPS = "map<string,string>"


def one(spark, text, chunker):
    rows = spark.createDataFrame([(text,)], "t string").select(F.explode(chunker(F.col("t"))).alias("c")).select("c.*").collect()
    return [(r.content, r.section, r.chunk_index) for r in rows], rows


def test_content_type(spark):
    cases = {"": "plain", "a": "plain", "# h": "structured", "| a\n| b\nc": "tabular", "| a\nb": "plain", "###### x\ny": "structured", "#x": "plain"}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", detect_content_type(F.col("t")).alias("k")).collect()
    assert {r.t: r.k for r in rows} == cases


@pytest.mark.parametrize("lengths", [(48, 48), (48, 47), (100, 3), (3, 200, 3), (46, 46, 46)])
def test_paragraph_limits(spark, lengths):
    paragraphs = ["x" * n for n in lengths]
    got, _ = one(spark, "\n\n".join(paragraphs) + "\n\n  \n\n", lambda t: chunking.chunk_by_paragraphs(t, 100))
    want, weight = [], 0
    for p in paragraphs:
        if weight and weight + len(p) + 2 <= 100:
            want[-1] += "\n\n" + p
            weight += len(p) + 2
        else:
            want.append(p)
            weight = len(p) + 2
    assert [c for c, _, _ in got] == want
    assert "".join(c.replace("\n", "") for c, _, _ in got) == "".join(paragraphs)


def test_headers(spark):
    text = "intro\n# One\n\n## Empty\n\n## Two\n" + "y" * 120 + "\n\n" + "z" * 120
    got, rows = one(spark, text, lambda t: chunking.chunk_by_headers(t, 200, 10))
    # The header without body vanishes, the short introduction joins the next chunk and takes its metadata.
    assert [(s, i) for _, s, i in got] == [("Two", 1), ("Two", 2)]
    assert rows[0].merged and rows[0].content == "intro\n\n## Two\n\n" + "y" * 120


def test_pages(spark):
    got, rows = one(spark, "a\n---\nb\n---  \n" + "c" * 60, lambda t: chunking.chunk_by_pages(t, 20))
    assert [(r.content, r.page_range) for r in rows] == [("a\n\nb", "1-2"), ("c" * 60, "3-3")]
    assert one(spark, "no pages", lambda t: chunking.chunk_by_pages(t))[0] == [("no pages", "", 0)]


def test_tables(spark):
    text = "# T\n| a | b |\n|---|---|\n| 1 | 2 |\n| 3 | 4 |\n| 5 | 6 |\nnote\n| x | y |\n| - | - |\n| 7 | 8 |"
    got, rows = one(spark, text, lambda t: chunking.chunk_table(t, 2))
    assert [(r.row_range, r.section, r.chunk_index, r.content_type) for r in rows] == [("1-2", "T", 0, "table"), ("3-3", "T", 1, "table"), ("1-1", "T", 2, "table"), (None, "", 0, "narrative")]
    assert rows[2].content == "| x | y |\n| - | - |\n| 7 | 8 |"


def test_fixed_windows(spark):
    got, _ = one(spark, "abcdefghij", lambda t: chunking.chunk_fixed(t, 4, 1))
    assert [c for c, _, _ in got] == ["abcd", "defg", "ghij"]
    with pytest.raises(ValueError):
        chunking.chunk_fixed(F.col("t"), 4, 4)


def test_answers(spark):
    cases = [
        ('{"entities":[{"name":"a"}]}', [("a", "", {})]), ('see {"entities":[{"name":null,"type":"t","properties":{"k":1}}]} ok', [(None, "t", {"k": "1"})]),
        ("{} {}", []), ("none", []), ('[{"entities":[]}]', []), ('{"entities":[{"name":"a"', []), (None, []), ("{'entities':[]}", []),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string").select("i", extraction.parse_extraction_response(F.col("t")).alias("x")).collect()
    assert {r.i: [(e.name, e.type, e.properties) for e in r.x.entities] for r in rows} == {i: e for i, (_, e) in enumerate(cases)}


def test_retries(spark):
    seen = {}

    def fn(prompt):
        seen[prompt] = n = seen.get(prompt, 0) + 1
        if prompt == "throttled" or (prompt == "recovers" and n < 2):
            raise extraction.RetryableError
        if prompt == "denied":
            raise extraction.FatalError
        return "words" if prompt == "prose" and n < 2 else "{}"

    df = spark.createDataFrame([(p,) for p in ("throttled", "recovers", "denied", "prose", "fine")], "prompt string").coalesce(1)
    got = {r.prompt: (r.attempts, r.status) for r in extraction.complete_prompts(df, fn, wait=lambda s: None).collect()}
    assert got == {"throttled": (3, "failed"), "recovers": (2, "ok"), "denied": (1, "failed"), "prose": (2, "ok"), "fine": (1, "ok")}


def test_errors_are_kept_and_done_rows_are_not_asked_again(spark):
    asked = spark.sparkContext.accumulator(0)

    def fn(prompt):
        asked.add(1)
        if prompt == "b":
            raise extraction.FatalError("denied")
        return int("x") if prompt == "c" else "{}"

    df = spark.createDataFrame([(i, 0, p) for i, p in enumerate("abca")], "doc_id int, chunk_seq int, prompt string").coalesce(1)
    rows = extraction.complete_prompts(df, fn, in_flight=4, wait=lambda s: None).collect()
    assert [(r.doc_id, r.status, r.throttles) for r in rows] == [(0, "ok", 0), (1, "failed", 0), (2, "failed", 0), (3, "ok", 0)] and all(r.seconds >= 0 for r in rows)
    assert rows[1].error == "FatalError: denied" and rows[2].error.startswith("ValueError: ") and rows[0].error is None
    before = asked.value
    done = spark.createDataFrame([(r.doc_id, r.chunk_seq, r.status) for r in rows], "doc_id int, chunk_seq int, status string")
    again = extraction.complete_prompts(df, fn, done=done).collect()
    assert sorted(r.doc_id for r in again) == [1, 2] and asked.value == before + 2
    assert extraction.complete_prompts(df.limit(0), fn).collect() == []


def test_last_property_wins_and_loading_twice_changes_nothing(spark):
    rows = [("a", "T", {"x": "1", "y": "1"}, 1), ("a", "T", {"x": "2"}, 2), ("b", "T", {"name": "a", "z": "3"}, 3), ("", "T", {}, 4), (None, "T", {}, 5), ("c", "T", {}, 6)]
    df = spark.createDataFrame(rows, f"name string, entity_type string, properties {PROPS}, ord int")
    found = {r.name: r.properties for r in aggregation.dedupe_entities(aggregation.valid_entities(df)).collect()}
    assert found["a"] == {"x": "2", "y": "1"} and found["c"] == {}
    once = graph.merge_entity_nodes(None, df)
    assert {r.name: r.properties for r in once.collect()} == {"a": {"x": "2", "y": "1", "name": "a", "z": "3"}, "c": {}}
    assert sorted(map(str, graph.merge_entity_nodes(once, df).collect())) == sorted(map(str, once.collect()))


def test_edges_by_name(spark):
    nodes = spark.createDataFrame([("1", "A", "x"), ("2", "B", "x"), ("3", "A", "y")], "node_id string, label string, name string")
    rel = spark.createDataFrame([("x", "y", "R"), ("x", "y", "R"), ("x", "gone", "R"), ("", "y", "R")], "from_entity string, to_entity string, relationship_type string")
    edges = graph.resolve_edges(rel, nodes)
    assert sorted(map(tuple, edges.collect())) == [("1", "R", "3"), ("2", "R", "3")]
    assert graph.unmatched_relationships(rel, nodes).count() == 1
    assert validation.orphan_nodes(nodes, edges.where("src_id = '1'")).select("node_id").first()[0] == "2"
    hops = retrieval.k_hop(nodes.where("node_id = '1'"), edges, 2)
    assert sorted((r.node_id, r.hop) for r in hops.collect()) == [("1", 0), ("3", 1)]


def test_mentions(spark, monkeypatch):
    names = ["a", "Ab", "tion", "Nation", "nationalise", "ational", "é😀", "😀😀 smile", "x\ny z w", "(.*)[", "never there", "", None, "Station", "station"]
    texts = ["A NATIONALISE(D) Station", "ab", "", None, "é😀😀 Smile x\nY z w", "q(.*)[", "b" * 3000 + "nation" + "b" * 3000, "one id", "Station again"]
    nodes = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "node_id string, name string")
    chunks = spark.createDataFrame([(f"c{min(i, 7)}", t) for i, t in enumerate(texts)], "id string, content string")
    want = {(f"c{min(i, 7)}", "MENTIONS", str(j)) for i, t in enumerate(texts) for j, n in enumerate(names) if n and t and n.lower() in t.lower()}
    for tiny in (4096, 1):
        monkeypatch.setattr(graph, "TINY_NAMES", tiny)
        got = graph.link_mentions(chunks, nodes).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert graph.link_mentions(chunks, nodes.limit(0)).collect() == [] and graph.link_mentions(chunks.limit(0), nodes).collect() == []


def test_alias_chains(spark):
    entities = spark.createDataFrame([("A b", 1), ("a  B", 2), ("a  B", 3), ("C", 4), ("D", 5)], "name string, ord int")
    aliases = spark.createDataFrame([("C", "d"), ("D", "e"), ("E", "a b")], "a string, b string")
    got = graph.resolve_entities(entities, aliases, materialize=lambda df: spark.createDataFrame(df.collect(), df.schema)).collect()
    assert len({r.canonical_id for r in got}) == 1 and {r.canonical_name for r in got} == {"a  B"}


def test_files(spark, tmp_path):
    for name, data in {"a.TXT": b"x\r\ny", "b.html": b"<h1>T</h1><script>no</script><p>a &amp; b", "c.exe": b"z", "d.md": b"\xff\xfe\xfd", "e": b"%PDF-1.4"}.items():
        (tmp_path / name).write_bytes(data)
    got = {r.source: (r.file_type, r.status, r.markdown) for r in files.parse_documents(files.read_files(spark, str(tmp_path))).collect()}
    assert got == {"a.TXT": (".txt", "parsed", "x\ny"), "b.html": (".html", "parsed", "# T\n\na & b"), "c.exe": (None, "rejected", None), "d.md": (".md", "error", None), "e": (".pdf", "parsed", None)}


def test_store(spark, tmp_path):
    schema = spark.createDataFrame([(json.dumps({"entity_types": [{"name": "A", "description": "d", "example_properties": ["p"]}]}),)], "j string").select(F.from_json("j", store.SCHEMA).alias("s")).select("s.*")
    store.write_schema_json(schema, str(tmp_path / "schema"))
    kinds, relations = store.read_schema_json(spark, str(tmp_path / "schema"))
    assert kinds.first().name == "A" and relations.count() == 0
    nodes = spark.createDataFrame([("1", "A", "x")], "node_id string, label string, name string")
    store.write_graph({"nodes": nodes}, str(tmp_path / "g"))
    assert store.read_graph(spark, str(tmp_path / "g"), ("nodes",))["nodes"].select("node_id", "label", "name").first() == nodes.first()


def test_labels_and_empty_tables_come_back_as_written(spark, tmp_path):
    nodes = spark.createDataFrame([("1", "007", "x"), ("2", "2024", "y")], "node_id string, label string, name string")
    edges = spark.createDataFrame([], "src_id string, edge_type string, dst_id string")
    store.write_graph({"nodes": nodes, "edges": edges}, str(tmp_path / "g"))
    back = store.read_graph(spark, str(tmp_path / "g"))
    assert sorted(map(tuple, back["nodes"].collect())) == sorted(map(tuple, nodes.collect())) and back["edges"].count() == 0 and set(back) == {"nodes", "edges"}
    with pytest.raises(ValueError):
        store.read_graph(spark, str(tmp_path / "none"))


def test_repeated_batches_and_batches_without_chunks(spark, tmp_path):
    relations = "from_entity string, to_entity string, relationship_type string, properties map<string,string>, ord long"

    def split(batch):
        entities = batch.select("name", F.lit("Tool").alias("entity_type"), F.create_map(F.lit("seen"), F.col("seen")).alias("properties"), F.col("id").alias("ord"))
        links = spark.createDataFrame([("Alpha", "Beta", "USES", None, 1)], relations)
        chunks = batch.where("text is not null").select(F.col("text").alias("content"), F.lit("f").alias("source"), F.lit(None).cast("string").alias("section"), F.col("id").alias("ord"))
        return entities, links, (chunks if batch.where("text is not null").count() else None)

    fields = "id long, name string, seen string, text string"
    batches = [spark.createDataFrame([(1, "Alpha", "a", "We trust Alpha."), (2, "Gamma", "g", "Nothing here.")], fields), spark.createDataFrame([(3, "Beta", "b", None), (4, "Alpha", "later", None)], fields)]
    load = graph_upsert(spark, str(tmp_path), split)

    def state(version):
        found = store.read_graph(spark, str(tmp_path / version))
        return {(r.label, r.name, r.properties.get("seen")) for r in found["nodes"].collect()}, Counter(r.edge_type for r in found["edges"].collect()), {r.text for r in found["chunks"].collect()}

    load(batches[0], 0)
    first = state("v0")
    assert first == ({("Tool", "Alpha", "a"), ("Tool", "Gamma", "g")}, {"MENTIONS": 1}, {"We trust Alpha.", "Nothing here."})
    load(batches[0], 0)
    assert state("v0") == first
    load(batches[1], 1)
    (tmp_path / "v1" / "complete" / "_SUCCESS").unlink()
    for part in (tmp_path / "v1" / "complete").iterdir():  # as if the batch had been cut off before its marker
        part.unlink()
    (tmp_path / "v1" / "complete").rmdir()
    load(batches[1], 1)
    assert state("v1") == ({("Tool", "Alpha", "later"), ("Tool", "Beta", "b"), ("Tool", "Gamma", "g")}, {"MENTIONS": 1, "USES": 1}, {"We trust Alpha.", "Nothing here."})


def test_html_tables_and_entities(spark):
    html = """<p>Who</p><table border="1">
  <tr><th>Name</th><th>Role</th></tr>
  <tr><td>A &amp; B</td><td>x &gt; y</td></tr>
</table><table><tbody><tr><td>1</td></tr><tr><td>2</td></tr></tbody></table><p>&#233;&#x1F600;&#39;&#xD800;&#99999999; &amp;#39; &mdash;</p>"""
    texts = [html, "", None, "<table></table>", "no tags"]
    got = [r.m for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(markup.html_to_markdown(F.col("t")).alias("m")).collect()]
    want = "Who\n\n| Name | Role |\n| --- | --- |\n| A & B | x > y |\n\n| 1 |\n| --- |\n| 2 |\n\né😀'&#xD800;&#99999999; &#39; —"
    assert got == [want, "", None, "", "no tags"]


def test_signatures(spark):
    header = b"PK\x03\x04" + bytes(26)
    cases = {
        ("a.md", b"BM picture"): None, ("a.txt", b"MZ program"): None, ("a.csv", b"7z\xbc\xaf\x27\x1c"): None, ("a.md", b"%PD but no PDF"): ".md", ("a", header + b"[Content_Types].xml" + bytes(500) + header + b"xl/workbook.xml"): ".xlsx",
        ("b.txt", header + b"notes/word/readme"): None, ("c.txt", b"PK\x03\x04" + b"word/"): None, ("d.HTM", b""): ".htm", (".md", b"x"): ".md",
    }
    df = spark.createDataFrame([(i, bytearray(b), p) for i, (p, b) in enumerate(cases)], "i int, b binary, p string")
    assert {r.i: r.k for r in df.select("i", files.detect_file_type(F.col("b"), F.col("p")).alias("k")).collect()} == dict(enumerate(cases.values()))


def test_report_without_a_schema(spark):
    nodes = spark.createDataFrame([("1", "A", "x"), ("2", "B", "X ")], "node_id string, label string, name string")
    edges = spark.createDataFrame([("1", "R", "2")], "src_id string, edge_type string, dst_id string")
    report = validation.validation_report(nodes, edges, spark.createDataFrame([], "id string"), None, None)
    assert {r.check: (r.n, r.severity) for r in report.collect()} == {
        "unexpected_labels": (2, "info"), "unexpected_types": (1, "info"), "orphan_nodes": (0, "pass"), "dangling_chunks": (0, "pass"), "duplicate_entities": (1, "error"), "wrong_direction": (0, "info"),
    }
    assert {r.severity: r.n for r in validation.severity_counts(report).collect()} == {"info": 3, "pass": 2, "error": 1}


def test_pdf_pages(spark):
    pages = spark.createDataFrame([(1, 1, "x" * 50), (1, 2, " "), (2, 1, ""), (3, 1, "y" * 60)], "doc_id int, page_no int, text string")
    docs = spark.createDataFrame([(1,), (2,), (3,), (4,)], "doc_id int")
    assert {r.doc_id: r.pdf_type for r in markup.classify_pdf_pages(pages, docs).collect()} == {1: "hybrid", 2: "scanned", 3: "digital", 4: "digital"}


def test_chunk_id(spark):
    import hashlib

    assert spark.range(1).select(chunk_id(F.lit("é"))).first()[0] == hashlib.md5("é".encode()).hexdigest()[:12]


def test_whole_searches_ask_every_hundredth_row(spark, tmp_path):
    import numpy as np

    from graphloom.plans import registry

    v = np.random.default_rng(5).normal(size=(450, 8))
    rows = [(i, v[i].tolist(), i % 7) for i in range(450)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = {q: sorted((-float(u[q] @ u[i]), i) for i in range(450) if i != q)[:5] for q in range(0, 450, 100)}
    got = registry.QUERIES["p4_top_k_similar"](spark, str(tmp_path)).collect()
    assert {(r.query_id, r["rank"], r.vec_id) for r in got} == {(q, k + 1, i) for q, h in hits.items() for k, (_, i) in enumerate(h)}
    assert all(abs(r.score + hits[r.query_id][r["rank"] - 1][0]) < 1e-5 for r in got)
    want = {(q, "chunk", str(i), f"chunk {i}") for q, h in hits.items() for _, i in h}
    want |= {(q, "entity", f"n{i % 7 + k}", f"Label: {i % 7 + k}") for q, h in hits.items() for _, i in h for k in (0, 1)}
    found = registry.QUERIES["p6_hybrid_context"](spark, str(tmp_path)).collect()
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_no_local_checkpoints():
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[1] / "graphloom"
    assert not [p for p in root.rglob("*.py") if re.search("localCheckpoint", p.read_text())]
