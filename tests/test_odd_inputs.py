"""Inputs that crashed, were cut or were changed: huge gaps in HTML, office files with late entries, long ids, control characters."""

import io
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from graphloom.operators import chunking, extraction
from graphloom.sources import files, markup


def markdown(spark, *pages):
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, t string").select("i", markup.html_to_markdown(F.col("t")).alias("m")).collect()
    return [r.m for r in sorted(rows, key=lambda r: r.i)]


@pytest.mark.parametrize("fill", ["x", " ", "\n", "<", "<b>", "<!--", "<script>", "&#", "</td>"])
def test_a_megabyte_of_anything_passes(fill):
    began = time.time()
    out = markup.page_to_markdown("<table>" + fill * (1_000_000 // len(fill)) + "<tr><th>a</th></tr><tr><td>b</td></tr></table>")
    assert time.time() - began < 10
    if fill in ("x", " ", "\n", "<b>"):
        assert out.endswith("| a |\n| --- |\n| b |")


def test_lists_tables_and_references(spark):
    nested = "<ul><li>a<ul><li>b<ol><li>c</ol><li>d</ul><li>e</ul>f"
    unclosed = "<table><tr><td>1<td>2<tr><td>3</table>after"
    got = markdown(spark, nested, unclosed, "&eacute;&notin;&nosuch;&amp;lt;&#x1F600;", "a < b and c > d <>", "<p title='x'>p<!-- q", "x\x02y\x03", None)
    assert got[0] == "- a\n  - b\n    - c\n  - d\n- ef"
    assert got[1].endswith("after") and got[1].startswith("| 12")
    assert got[2:] == ["é∉&nosuch;&lt;😀", "a  d <>", "p<!-- q", "x\x02y\x03", None]


def zipped(*names, lead=0, comment=b"", cut=None):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        if lead:
            z.writestr("docProps/thumbnail.jpeg", bytes(range(256)) * (lead // 256))
        for n in names:
            z.writestr(n, b"content of " + n.encode())
        z.comment = comment
    return out.getvalue()[:cut]


def test_office_files_by_their_directory(spark):
    inner = zipped("word/document.xml")
    holder = io.BytesIO()
    with zipfile.ZipFile(holder, "w") as z:
        z.writestr("files/inner.docx", inner)
    cases = [
        ("a.bin", zipped("[Content_Types].xml", "word/document.xml", lead=40_000), ".docx"), ("b", zipped("xl/workbook.xml", lead=1_000_000, comment=b"c" * 60_000), ".xlsx"), ("c.txt", zipped("notes.txt"), None),
        ("d.txt", holder.getvalue(), None), ("e", zipped("ppt/presentation.xml", lead=30_000)[:-30], ".pptx"), ("f.txt", b"\0\0\0\x18ftypmp42", None), ("g.txt", b"x" * 257 + b"ustar", None), ("h.txt", b"x" * 256 + b"ustar", ".txt"),
    ]
    df = spark.createDataFrame([(p, bytearray(b)) for p, b, _ in cases], "p string, b binary")
    assert {r.p: r.k for r in df.select("p", files.detect_file_type(F.col("b"), F.col("p")).alias("k")).collect()} == {p: k for p, _, k in cases}


def test_long_ids_beside_nulls_stay(spark):
    big = (1 << 53) + 1
    rows = [(big, "a", None), (None, "b", 1), (big + 2, "c", big)]
    df = spark.createDataFrame(rows, "doc_id long, content string, chunk_seq long").coalesce(1)
    asked = extraction.complete_prompts(df.withColumn("prompt", F.col("content")), lambda p: "{}").collect()
    embedded = extraction.embed_chunks(df, lambda texts: [[1.0, 2.0] if t != "b" else None for t in texts]).collect()
    assert [(r.doc_id, r.content, r.chunk_seq) for r in asked] == [(r.doc_id, r.content, r.chunk_seq) for r in embedded] == rows
    assert [r.embedding for r in embedded] == [[1.0, 2.0], None, [1.0, 2.0]] and {r.status for r in asked} == {"ok"}


def test_control_characters_are_text(spark):
    text = "# T\nab\x01cd\x02\n\nmore" + "y" * 100
    rows = spark.createDataFrame([(text,)], "t string").select(F.explode(chunking.chunk_by_headers(F.col("t"))).alias("c")).select("c.*").collect()
    assert [(r.content, r.section) for r in rows] == [("# T\n\nab\x01cd\x02\n\nmore" + "y" * 100, "T")]


def test_chunkers_work_grows_with_the_text(spark):
    """Four times the paragraphs take well below 16 times as long."""
    took = {}
    for chunker, gap in ((chunking.chunk_by_paragraphs, "\n\n"), (chunking.chunk_by_pages, "\n---\n"), (chunking.chunk_by_headers, "\n\n## h\n\n")):
        for n in (200, 8_000, 32_000):
            df = spark.createDataFrame([(gap.join([f"{i} " + "x" * 1000 for i in range(n)]),)], "t string").select(F.explode(chunker(F.col("t"))).alias("c"))
            began = time.time()
            assert df.count() == n - (1 if gap.startswith("\n\n##") else 0) + (1 if gap.startswith("\n\n##") else 0)
            took[n] = time.time() - began
        assert took[32_000] < 9 * max(took[8_000], 0.5)


def test_patterns_find_ids(spark):
    rows = extraction.extract_patterns(spark.createDataFrame([("see JIRA-12, X-1 and ABC-007.", 1)], "content string, k int")).collect()
    assert [(r.name, r.entity_type) for r in rows] == [("JIRA-12", "Id"), ("ABC-007", "Id")]
