"""Every registered query of the knowledge-graph operators, with its check in plain SQL.

Queries give the given tables the structure that an operator needs (headings, sheets, pages, model answers, a graph) by
expressions that their SQL repeats.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.functions.text import detect_content_type, looks_like_json
from graphloom.operators import aggregation, chunking, extraction, graph, retrieval, validation
from graphloom.sources import files, markup, shared, store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A single file is one partition: deal its rows out before heavy work on each."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


# --- documents with structure ------------------------------------------------------------------------------------


def _headed():
    return F.expr("array_join(transform(split(text, '\n', -1), (x, i) -> concat(if(i % 5 = 0, concat('## Part ', i, '\n\n'), ''), x)), '\n\n')")

def _plain():
    return F.expr("replace(text, '\n', '\n\n')")

def _paged():
    return F.expr("replace(text, '\n', '\n---\n')")

#: C2 in SQL: paragraphs are numbered and a recursion walks them with the open chunk's weight.
_PACKED = """
WITH RECURSIVE lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS p, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
p AS (SELECT doc_id, source, trim(p, ' ' || chr(9)) AS p, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM lines WHERE trim(p, ' ' || chr(9)) <> ''),
walk(doc_id, source, k, p, g, w) AS (
  SELECT doc_id, source, k, p, 0, length(p) + 2 FROM p WHERE k = 1
  UNION ALL
  SELECT p.doc_id, p.source, p.k, p.p, CASE WHEN w.w + length(p.p) + 2 > 1500 THEN w.g + 1 ELSE w.g END,
    CASE WHEN w.w + length(p.p) + 2 > 1500 THEN length(p.p) + 2 ELSE w.w + length(p.p) + 2 END
  FROM walk w JOIN p ON p.doc_id = w.doc_id AND p.k = w.k + 1),
chunks AS (SELECT doc_id, source, g::INT AS chunk_seq, string_agg(p, chr(10) || chr(10) ORDER BY k) AS content FROM walk GROUP BY doc_id, source, g)
"""


def _plain_chunks(spark, sf_dir) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", "source", _plain().alias("markdown"))
    return chunking.chunk_documents(docs.withColumnRenamed("source", "origin"))


@query(f"""{_PACKED}
SELECT source, 'plain' AS content_type, count(DISTINCT doc_id) AS documents, count(*) AS chunks, sum(length(content))::BIGINT AS chars, max(length(content))::INT AS longest
FROM chunks GROUP BY source""")
def w1_chunk_profile(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", "source", _plain().alias("text"))
    kinds = docs.select("doc_id", "source", detect_content_type(F.col("text")).alias("content_type"), F.explode(chunking.chunk_by_paragraphs(F.col("text"))).alias("c"))
    each = kinds.groupBy("source", "content_type", "doc_id").agg(F.count("*").alias("n"), F.sum("c.char_count").alias("chars"), F.max("c.char_count").alias("longest"))
    return each.groupBy("source", "content_type").agg(F.count("*").alias("documents"), F.sum("n").alias("chunks"), F.sum("chars").alias("chars"), F.max("longest").alias("longest"))


@query(f"{_PACKED} SELECT doc_id, chunk_seq, md5(content) AS digest, length(content)::INT AS char_count, 'narrative' AS content_type FROM chunks")
def b2_c2_chunk_documents(spark, sf_dir):
    return _plain_chunks(spark, sf_dir).select("doc_id", "chunk_seq", F.md5("content").alias("digest"), "char_count", "content_type")


@query(f"""{_PACKED}
SELECT id, arg_max(left(content, 2000), (doc_id, chunk_seq)) AS text, arg_max(source, (doc_id, chunk_seq)) AS source, '' AS section, max(length(content))::INT AS char_count
FROM (SELECT *, substr(md5(content), 1, 12) AS id FROM chunks) GROUP BY id""")
def c7_c8_f6_chunk_nodes(spark, sf_dir):
    chunks = _plain_chunks(spark, sf_dir).withColumn("source", F.col("origin")).withColumn("ord", F.struct("doc_id", "chunk_seq"))
    return graph.merge_chunk_nodes(None, chunking.chunk_nodes(chunks))


@query(f"{_PACKED} SELECT substr(md5(content), 1, 4) AS id, count(DISTINCT md5(content)) AS contents FROM chunks GROUP BY 1 HAVING count(DISTINCT md5(content)) > 1")
def c7_chunk_id_collisions(spark, sf_dir):
    """With ids of four digits, of which many are shared."""
    return chunking.chunk_id_collisions(_plain_chunks(spark, sf_dir), 4)


@query(r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS p, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
t AS (SELECT doc_id, string_agg(CASE doc_id % 3 WHEN 0 THEN CASE WHEN i % 5 = 0 THEN '## Part ' || i || chr(10) || chr(10) ELSE '' END || p WHEN 1 THEN '| ' || p ELSE p END || CASE doc_id % 3 WHEN 1 THEN '' ELSE chr(10) END, chr(10) ORDER BY i) AS text FROM l GROUP BY doc_id),
s AS (SELECT doc_id, string_split(trim(text, ' ' || chr(9) || chr(10)), chr(10)) AS lines FROM t)
SELECT doc_id, CASE WHEN 2 * len(list_filter(lines, lambda x: starts_with(trim(x, ' ' || chr(9)), '|'))) > len(lines) THEN 'tabular' WHEN len(list_filter(lines, lambda x: regexp_matches(x, '^#{1,6}\s'))) > 0 THEN 'structured' ELSE 'plain' END AS content_type FROM s""")
def b1_content_type(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 3 == 0, _headed()).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("| "), F.replace(_plain(), F.lit("\n\n"), F.lit("\n| ")))).otherwise(_plain())
    return docs.select("doc_id", detect_content_type(text).alias("content_type"))


_LINES = "SELECT doc_id, t, i - 1 AS i FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)"


@query(f"""
WITH RECURSIVE l AS ({_LINES}),
s AS (SELECT doc_id, i // 5 AS g, trim(string_agg(t, chr(10) || chr(10) ORDER BY i), ' ' || chr(9) || chr(10)) AS body FROM l GROUP BY doc_id, i // 5),
f AS (SELECT doc_id, g, 'Part ' || (g * 5) AS title, '## Part ' || (g * 5) || chr(10) || chr(10) || body AS whole FROM s WHERE body <> ''),
q AS (SELECT doc_id, g, title, unnest(string_split(whole, chr(10) || chr(10))) AS p, generate_subscripts(string_split(whole, chr(10) || chr(10)), 1) AS j FROM f WHERE length(whole) > 1500),
p AS (SELECT doc_id, g, title, trim(p, ' ' || chr(9) || chr(10)) AS p, row_number() OVER (PARTITION BY doc_id, g ORDER BY j) AS k FROM q WHERE trim(p, ' ' || chr(9) || chr(10)) <> ''),
walk(doc_id, g, title, k, p, h, w) AS (
  SELECT doc_id, g, title, k, p, 0, length(p) + 2 FROM p WHERE k = 1
  UNION ALL
  SELECT p.doc_id, p.g, p.title, p.k, p.p, CASE WHEN w.w + length(p.p) + 2 > 1500 THEN w.h + 1 ELSE w.h END, CASE WHEN w.w + length(p.p) + 2 > 1500 THEN length(p.p) + 2 ELSE w.w + length(p.p) + 2 END
  FROM walk w JOIN p ON p.doc_id = w.doc_id AND p.g = w.g AND p.k = w.k + 1),
c AS (SELECT doc_id, g, 0 AS h, title, whole AS content FROM f WHERE length(whole) <= 1500
  UNION ALL SELECT doc_id, g, h, title, string_agg(p, chr(10) || chr(10) ORDER BY k) FROM walk GROUP BY doc_id, g, h, title),
n AS (SELECT doc_id, title, content, row_number() OVER (PARTITION BY doc_id ORDER BY g, h) AS r, count(*) OVER (PARTITION BY doc_id) AS last FROM c),
held(doc_id, r, waits) AS (
  SELECT doc_id, r, length(content) < 100 FROM n WHERE r = 1
  UNION ALL SELECT n.doc_id, n.r, NOT held.waits AND length(n.content) < 100 FROM held JOIN n ON n.doc_id = held.doc_id AND n.r = held.r + 1),
m AS (SELECT n.*, waits, lag(waits) OVER w AS joins, CASE WHEN lag(waits) OVER w THEN lag(content) OVER w || chr(10) || chr(10) || content ELSE content END AS joined FROM n JOIN held USING (doc_id, r) WINDOW w AS (PARTITION BY doc_id ORDER BY r))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY r) - 1)::INT AS chunk_seq, joined AS content, title AS section, (r - 1)::INT AS chunk_index, 'narrative' AS content_type, length(joined)::INT AS char_count,
  NULL::VARCHAR AS row_range, NULL::VARCHAR AS page_range, CASE WHEN joins THEN true END AS merged FROM m WHERE NOT waits OR r = last""")
def c1_c5_header_chunks(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", F.posexplode(chunking.chunk_by_headers(_headed())).alias("chunk_seq", "c"))
    return docs.select("doc_id", "chunk_seq", "c.*")


@query(r"""
WITH RECURSIVE d AS (SELECT doc_id, string_split_regex(replace(text, chr(10), chr(10) || '---' || chr(10)), '\n---\s*\n') AS pages FROM documents),
q AS (SELECT doc_id, len(pages) AS total, trim(unnest(pages), ' ' || chr(9) || chr(10)) AS p, generate_subscripts(pages, 1) AS no FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS k FROM q WHERE p <> ''),
walk(doc_id, total, k, no, p, g, w) AS (
  SELECT doc_id, total, k, no, p, 0, length(p) + 2 FROM p WHERE k = 1
  UNION ALL
  SELECT p.doc_id, p.total, p.k, p.no, p.p, CASE WHEN w.w + length(p.p) + 2 > 1500 THEN w.g + 1 ELSE w.g END, CASE WHEN w.w + length(p.p) + 2 > 1500 THEN length(p.p) + 2 ELSE w.w + length(p.p) + 2 END
  FROM walk w JOIN p ON p.doc_id = w.doc_id AND p.k = w.k + 1),
c AS (SELECT doc_id, total, g, min(no) AS a, string_agg(p, chr(10) || chr(10) ORDER BY k) AS content FROM walk GROUP BY doc_id, total, g),
r AS (SELECT *, CASE WHEN total > 1 THEN (CASE WHEN g = 0 THEN 1 ELSE a END) || '-' || coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY g) - 1, total) END AS span FROM c)
SELECT doc_id, g::INT AS chunk_seq, content, coalesce('Pages ' || span, '') AS section, g::INT AS chunk_index, CASE WHEN total > 1 THEN 'ocr_text' ELSE 'narrative' END AS content_type, length(content)::INT AS char_count,
  NULL::VARCHAR AS row_range, span AS page_range, NULL::BOOLEAN AS merged FROM r""")
def c4_page_chunks(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", F.posexplode(chunking.chunk_by_pages(_paged())).alias("chunk_seq", "c"))
    return docs.select("doc_id", "chunk_seq", "c.*")


def _cells(spark, sf_dir) -> DataFrame:
    cells = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("doc_id"), F.lit(0).alias("sheet_no"), F.lit("Customers").alias("sheet"), F.col("c_custkey").alias("row_no"), F.array(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("values"))
    head = cells.select("doc_id", "sheet_no", "sheet", F.lit(-1).cast("long").alias("row_no"), F.array(F.lit("c_custkey"), F.lit("c_name"), F.lit("c_mktsegment")).alias("values")).distinct()
    return cells.unionByName(head)


def _sheets(spark, sf_dir) -> DataFrame:
    return markup.rows_to_markdown(_cells(spark, sf_dir))


@query("""
SELECT c_nationkey AS doc_id, md5('## Customers' || chr(10) || chr(10) || '| c_custkey | c_name | c_mktsegment |' || chr(10) || '| --- | --- | --- |' || chr(10) ||
  string_agg('| ' || c_custkey || ' | ' || c_name || ' | ' || c_mktsegment || ' |', chr(10) ORDER BY c_custkey) || chr(10)) AS digest FROM customer GROUP BY c_nationkey""")
def a5_rows_to_markdown(spark, sf_dir):
    return _sheets(spark, sf_dir).select("doc_id", F.md5("markdown").alias("digest"))


@query("""
WITH r AS (SELECT *, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 30 AS g FROM customer)
SELECT c_nationkey AS doc_id, g::INT AS chunk_seq, 'Customers' AS section, 'table' AS content_type, (g * 30 + 1) || '-' || (g * 30 + count(*)) AS row_range,
  md5('| c_custkey | c_name | c_mktsegment |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || c_custkey || ' | ' || c_name || ' | ' || c_mktsegment || ' |', chr(10) ORDER BY c_custkey)) AS digest
FROM r GROUP BY c_nationkey, g""")
def c3_table_chunks(spark, sf_dir):
    return markup.sheet_chunks(_cells(spark, sf_dir)).select("doc_id", "chunk_seq", "section", "content_type", "row_range", F.md5("content").alias("digest"))


#: A title, the nation's customers as a table, two lines of prose and the suppliers' table (R4), as lines: (doc_id, part, key, line).
_MIXED = """
l AS (
  SELECT n_nationkey AS doc_id, 0 AS part, 0 AS key, '# Customers' AS line FROM nation UNION ALL SELECT n_nationkey, 1, 0, '| c_custkey | c_name |' FROM nation UNION ALL SELECT n_nationkey, 2, 0, '| --- | --- |' FROM nation
  UNION ALL SELECT c_nationkey, 3, c_custkey, '| ' || c_custkey || ' | ' || c_name || ' |' FROM customer
  UNION ALL SELECT n_nationkey, 4, 0, 'These buy in ' || n_name || '.' FROM nation UNION ALL SELECT n_nationkey, 5, 0, 'Those who sell there:' FROM nation
  UNION ALL SELECT n_nationkey, 6, 0, '| s_suppkey | s_name |' FROM nation UNION ALL SELECT n_nationkey, 7, 0, '|---|---|' FROM nation UNION ALL SELECT s_nationkey, 8, s_suppkey, '| ' || s_suppkey || ' | ' || s_name || ' |' FROM supplier)"""


@query(f"""
WITH {_MIXED},
s AS (SELECT *, lead(line) OVER w AS after, row_number() OVER w AS i FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY part, key)),
k AS (SELECT *, CASE WHEN line LIKE '#%' THEN 'title' WHEN contains(line, '|') AND regexp_matches(after, '^\\|[\\s\\-:|]+\\|') THEN 'head' WHEN regexp_matches(line, '^\\|[\\s\\-:|]+\\|') THEN 'rule' WHEN line LIKE '|%' THEN 'row' ELSE 'text' END AS kind FROM s),
t AS (SELECT *, sum(CASE WHEN kind = 'head' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS no, max(CASE WHEN kind = 'title' THEN trim(ltrim(line, '#')) END) OVER (PARTITION BY doc_id) AS title FROM k),
h AS (SELECT doc_id, no, line || chr(10) || after AS head FROM t WHERE kind = 'head'),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, no ORDER BY i) - 1 AS n FROM t WHERE kind = 'row'),
c AS (SELECT doc_id, no, n // 30 AS g, title, min(n) + 1 || '-' || max(n) + 1 AS row_range, string_agg(line, chr(10) ORDER BY n) AS body FROM r GROUP BY ALL),
n AS (SELECT c.*, head, row_number() OVER (PARTITION BY doc_id ORDER BY no, g) - 1 AS seq, count(*) OVER (PARTITION BY doc_id) AS tables FROM c JOIN h USING (doc_id, no)),
p AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS body FROM t WHERE kind = 'text' GROUP BY doc_id)
SELECT doc_id, seq::INT AS chunk_seq, title AS section, seq::INT AS chunk_index, 'table' AS content_type, row_range, md5(head || chr(10) || body) AS digest FROM n
UNION ALL SELECT doc_id, coalesce(tables, 0)::INT, '', 0, 'narrative', NULL, md5(body) FROM p LEFT JOIN (SELECT DISTINCT doc_id, tables FROM n) USING (doc_id)""")
def c3_mixed_tables(spark, sf_dir):
    """A title, a table, prose and a second table in each document."""
    names = {n: table(spark, sf_dir, n) for n in ("nation", "customer", "supplier")}
    pipe = lambda *cs: F.concat(F.lit("| "), F.concat_ws(" | ", *cs), F.lit(" |"))
    line = lambda df, doc, part, key, text: df.select(F.col(doc).alias("doc_id"), F.lit(part).alias("part"), F.col(key).cast("long").alias("key"), text.alias("line"))
    fixed = ["# Customers", "| c_custkey | c_name |", "| --- | --- |", None, None, "Those who sell there:", "| s_suppkey | s_name |", "|---|---|"]
    lines = line(names["customer"], "c_nationkey", 3, "c_custkey", pipe("c_custkey", "c_name")).unionByName(line(names["supplier"], "s_nationkey", 8, "s_suppkey", pipe("s_suppkey", "s_name")))
    lines = lines.unionByName(line(names["nation"], "n_nationkey", 4, "n_nationkey", F.concat(F.lit("These buy in "), "n_name", F.lit("."))))
    for part, text in enumerate(fixed):
        if text:
            lines = lines.unionByName(line(names["nation"], "n_nationkey", part, "n_nationkey", F.lit(text)))
    docs = lines.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "key", "line"))), lambda x: x["line"]), "\n").alias("markdown"))
    return chunking.chunk_documents(docs).select("doc_id", "chunk_seq", "section", "chunk_index", "content_type", "row_range", F.md5("content").alias("digest"))


@query("""
SELECT doc_id, i::INT AS chunk_seq, substr(text, i * 800 + 1, 1000) AS content
FROM (SELECT doc_id, text, unnest(range(0, greatest(length(text) - 201, 0) // 800 + 1)) AS i FROM documents WHERE length(text) > 0)""")
def p10_chunk_fixed(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.chunk_fixed(F.col("text"), 1000, 200)).alias("chunk_seq", "c"))
    return rows.select("doc_id", "chunk_seq", "c.content")


@query("""
WITH f AS (
  SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '255044462D' WHEN 1 THEN '89504E470D0A1A0A' WHEN 2 THEN '504B0304' || repeat('00', 26) || '776F72642F' ELSE '' END || hex(encode(left(text, 300))) AS bytes,
    '/in/' || doc_id || CASE doc_id % 6 WHEN 3 THEN '.MD' WHEN 4 THEN '.exe' WHEN 5 THEN '.csv' ELSE '' END AS path FROM documents),
e AS (SELECT *, lower(regexp_extract(path, '([.][^./]+)$', 1)) AS ending FROM f)
SELECT doc_id, CASE WHEN starts_with(bytes, '25504446') THEN '.pdf' WHEN starts_with(bytes, '504B0304') THEN CASE WHEN substr(bytes, 61, 10) = '776F72642F' THEN '.docx' END
  WHEN starts_with(bytes, '89504E47') OR starts_with(bytes, '424D') OR starts_with(bytes, '4D5A') OR starts_with(bytes, '494433') OR starts_with(bytes, '464C56') THEN NULL
  WHEN ending IN ('.txt', '.md', '.markdown', '.html', '.htm', '.csv') THEN ending END AS file_type FROM e""")
def a2_detect_file_type(spark, sf_dir):
    kind = F.col("doc_id") % 6
    head = F.when(kind == 0, F.unhex(F.lit("255044462D"))).when(kind == 1, F.unhex(F.lit("89504E470D0A1A0A"))).when(kind == 2, F.unhex(F.lit("504B0304" + "00" * 26 + "776F72642F"))).otherwise(F.unhex(F.lit("")))
    path = F.concat(F.lit("/in/"), F.col("doc_id"), F.when(kind == 3, ".MD").when(kind == 4, ".exe").when(kind == 5, ".csv").otherwise(""))
    content = F.concat(head, F.col("text").cast("binary"))
    return table(spark, sf_dir, "documents").select("doc_id", files.detect_file_type(content, path).alias("file_type"))


#: What A4 does with the tags of ``pages``, as replacements one after the other (the operator reads each page once).
_HTML_STEPS = (
    (r"(?is)<!--.*?-->", ""), (r"(?is)<script[^>]*>.*?</script>", ""), (r"(?is)<style[^>]*>.*?</style>", ""),
    *((rf"(?is)<h{n}[^>]*>", "\n\n" + "#" * n + " ") for n in range(1, 7)),
    (r"(?i)</h[1-6]>", "\n\n"), (r"(?i)<li[^>]*>", "\n- "), (r"(?i)<(p|ul|ol|table|div|section|article)[^>]*>", "\n\n"), (r"(?i)<br[^>]*>", "\n"), (r"(?s)<[^>]+>", ""),
    ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), (r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n"),
)


def _html_sql() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    expr = "html"
    for pattern, replacement in _HTML_STEPS:
        expr = f"regexp_replace({expr}, {quote(pattern)}, {quote(replacement)}, 'g')"
    return f"SELECT page_id, trim(replace({expr}, '&amp;', '&'), ' ' || chr(9) || chr(13) || chr(10)) AS markdown FROM pages"


@query(_html_sql())
def a4_html_to_markdown(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages")).select("page_id", markup.html_to_markdown(F.col("html")).alias("markdown"))


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS page_no FROM documents),
p AS (SELECT doc_id, page_no, length(trim(CASE WHEN doc_id % 5 = 0 OR (doc_id + page_no) % 3 = 0 THEN '' ELSE t END)) AS n FROM l),
s AS (SELECT doc_id, count(*) AS total_pages, count(*) FILTER (page_no <= 3) AS pages_checked, count(*) FILTER (page_no <= 3 AND n >= 50) AS w, sum(n) FILTER (page_no <= 3) AS c FROM p GROUP BY doc_id)
SELECT doc_id, CASE WHEN w = pages_checked THEN 'digital' WHEN w = 0 THEN 'scanned' ELSE 'hybrid' END AS pdf_type, w <> pages_checked AS needs_ocr, pages_checked, total_pages, c / pages_checked AS avg_chars_per_page FROM s""")
def a6_classify_pdf_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "t"))
    blank = (F.col("doc_id") % 5 == 0) | ((F.col("doc_id") + F.col("i") + 1) % 3 == 0)
    return markup.classify_pdf_pages(pages.select("doc_id", (F.col("i") + 1).alias("page_no"), F.when(blank, "").otherwise(F.col("t")).alias("text")))


@query(f"""{_PACKED},
n AS (SELECT doc_id, chunk_seq, count(*) OVER (PARTITION BY doc_id) AS n FROM chunks)
SELECT doc_id, chunk_seq FROM n WHERE n <= 3 OR (chunk_seq % (n // 3) = 0 AND chunk_seq // (n // 3) < 3)""")
def d1_sample_chunks(spark, sf_dir):
    return extraction.sample_chunks(_plain_chunks(spark, sf_dir), k=3).select("doc_id", "chunk_seq")


@query("""
SELECT doc_id, m AS name, 'Email' AS entity_type FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\\b[\\w.]+@[\\w.]+\\.\\w+\\b')) AS m FROM documents)
UNION ALL SELECT doc_id, m, 'Date' FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\\b\\d{4}-\\d{2}-\\d{2}\\b')) AS m FROM documents)
UNION ALL SELECT doc_id, m, 'Url' FROM (SELECT doc_id, unnest(regexp_extract_all(text, 'https?://[^\\s<>"]+')) AS m FROM documents)
UNION ALL SELECT doc_id, m, 'Id' FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\\b[A-Z]{2,10}-\\d+\\b')) AS m FROM documents)""")
def p1_extract_patterns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return extraction.extract_patterns(docs, "text").select("doc_id", "name", "entity_type")


# --- model answers -----------------------------------------------------------------------------------------------


def _answers(spark, sf_dir) -> DataFrame:
    """An answer for each order: by o_orderkey % 7 clean, after prose, fenced, two objects, cut off, without JSON, a list."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    body = F.format_string(
        '{"entities":[{"name":"%s","type":"Customer","properties":{"segment":"%s","last":"%s"}},{"name":"Order %s","type":"Order","properties":{"status":"%s"}}],"relationships":[{"from":"%s","to":"Order %s","type":"PLACED"}]}',
        "c_name", "c_mktsegment", F.col("o_orderkey").cast("string"), F.col("o_orderkey").cast("string"), "o_orderstatus", "c_name", F.col("o_orderkey").cast("string"),
    )
    kind = F.col("o_orderkey") % 7
    text = F.when(kind == 0, body).when(kind == 1, F.concat(F.lit("Here it is: "), body)).when(kind == 2, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(kind == 3, F.concat(body, F.lit(" "), body))
    text = text.when(kind == 4, F.left(body, F.length(body) - 5)).when(kind == 5, "none found").otherwise(F.concat(F.lit("["), body, F.lit("]")))
    return spread(orders.select(F.col("o_orderkey").alias("doc_id"), F.lit(0).alias("chunk_seq"), text.alias("response"))).withColumn("extraction", extraction.parse_extraction_response(F.col("response")))


_SEEN = "WITH s AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 7 < 3)"


@query(f"""{_SEEN}
SELECT c_name AS name, 'Customer' AS entity_type, count(*) AS occurrences, min(o_orderkey) AS first_doc, max(c_mktsegment) AS segment, NULL AS status, max(o_orderkey)::VARCHAR AS last FROM s GROUP BY c_name
UNION ALL SELECT 'Order ' || o_orderkey, 'Order', 1, o_orderkey, NULL, o_orderstatus, NULL FROM s""")
def d6_e1_e2_dedupe_entities(spark, sf_dir):
    found = aggregation.dedupe_entities(aggregation.valid_entities(extraction.entities_of(_answers(spark, sf_dir))))
    value = lambda k: F.try_element_at("properties", F.lit(k)).alias(k)
    return found.select("name", "entity_type", "occurrences", F.col("ord.doc_id").alias("first_doc"), value("segment"), value("status"), value("last"))


@query(f"{_SEEN} SELECT DISTINCT c_name AS from_entity, 'PLACED' AS relationship_type, 'Order ' || o_orderkey AS to_entity, o_orderkey AS first_doc FROM s")
def d6_e3_dedupe_relationships(spark, sf_dir):
    found = aggregation.dedupe_relationships(aggregation.valid_relationships(extraction.relationships_of(_answers(spark, sf_dir))))
    return found.select("from_entity", "relationship_type", "to_entity", F.col("ord.doc_id").alias("first_doc"))


@query(f"""{_SEEN}
SELECT c_name AS name, 'Customer' AS entity_type, count(*) AS occurrences, count(*) AS chunks, count(*) AS documents FROM s GROUP BY c_name
UNION ALL SELECT 'Order ' || o_orderkey, 'Order', 1, 1, 1 FROM s""")
def p9_entity_support(spark, sf_dir):
    return aggregation.entity_support(extraction.entities_of(_answers(spark, sf_dir)))


# --- the graph ---------------------------------------------------------------------------------------------------


def _entities(spark, sf_dir) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    row = lambda df, name, label, order, key=F.lit("kind"), value=None: df.select(name.alias("name"), label.alias("entity_type"), F.create_map(key, F.lit("seen") if value is None else value).alias("properties"), order.cast("long").alias("ord"))
    rows = row(t("region"), F.col("r_name"), F.lit("Region"), F.col("r_regionkey"))
    rows = rows.unionByName(row(t("region").where("r_regionkey = 0"), F.col("r_name"), F.lit("Continent"), F.col("r_regionkey")))
    rows = rows.unionByName(row(t("nation"), F.col("n_name"), F.lit("Nation"), F.col("n_nationkey")))
    rows = rows.unionByName(row(t("customer"), F.col("c_name"), F.lit("Customer"), F.col("c_custkey"), F.lit("segment"), F.col("c_mktsegment")))
    rows = rows.unionByName(row(t("supplier"), F.col("s_name"), F.lit("Supplier"), F.col("s_suppkey")))
    return rows.unionByName(row(t("part"), F.col("p_name"), F.lit("Part"), F.col("p_partkey"), F.lit("brand"), F.col("p_brand")))


def _relationships(spark, sf_dir) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    row = lambda df, a, kind, b: df.select(a.alias("from_entity"), F.lit(kind).alias("relationship_type"), b.alias("to_entity"))
    c, n = F.col("c_name"), F.col("n_name")
    linked = t("customer").where("c_custkey % 97 <> 0")
    # Dealt by part for the distinct pairs and their join, then by supplier, so that equal pairs of names meet in a task.
    pairs = t("lineitem").select("l_suppkey", "l_partkey").repartition("l_partkey").distinct()
    supplied = pairs.join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    swap = F.col("s_suppkey") % 10 == 0
    rows = row(linked.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")), c, "LOCATED_IN", n)
    rows = rows.unionByName(row(t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")), n, "LOCATED_IN", F.col("r_name")))
    rows = rows.unionByName(row(supplied, F.when(swap, F.col("p_name")).otherwise(F.col("s_name")), "SUPPLIES", F.when(swap, F.col("s_name")).otherwise(F.col("p_name"))))
    return rows.unionByName(row(t("customer").where("c_custkey % 50 = 0"), c, "KNOWS", F.lit("Nobody"))).withColumn("properties", F.create_map().cast("map<string,string>"))


_GRAPH = """
WITH e AS (
  SELECT r_name AS name, 'Region' AS label, 'kind' AS k, 'seen' AS v, r_regionkey::BIGINT AS o FROM region UNION ALL SELECT r_name, 'Continent', 'kind', 'seen', r_regionkey FROM region WHERE r_regionkey = 0
  UNION ALL SELECT n_name, 'Nation', 'kind', 'seen', n_nationkey FROM nation UNION ALL SELECT c_name, 'Customer', 'segment', c_mktsegment, c_custkey FROM customer
  UNION ALL SELECT s_name, 'Supplier', 'kind', 'seen', s_suppkey FROM supplier UNION ALL SELECT p_name, 'Part', 'brand', p_brand, p_partkey FROM part),
nodes AS (SELECT md5(label || chr(1) || name) AS node_id, label, name, k AS key, arg_max(v, o) AS value FROM e GROUP BY label, name, k),
rel AS (
  SELECT c_name AS a, 'LOCATED_IN' AS t, n_name AS b FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 97 <> 0
  UNION ALL SELECT n_name, 'LOCATED_IN', r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT CASE WHEN s_suppkey % 10 = 0 THEN p_name ELSE s_name END, 'SUPPLIES', CASE WHEN s_suppkey % 10 = 0 THEN s_name ELSE p_name END
    FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
  UNION ALL SELECT c_name, 'KNOWS', 'Nobody' FROM customer WHERE c_custkey % 50 = 0),
edges AS (SELECT DISTINCT x.node_id AS src_id, t AS edge_type, y.node_id AS dst_id FROM rel JOIN nodes x ON x.name = rel.a JOIN nodes y ON y.name = rel.b)
"""


def _nodes(spark, sf_dir):
    return graph.merge_entity_nodes(None, _entities(spark, sf_dir))


def _edges(spark, sf_dir):
    return graph.merge_edges(None, graph.resolve_edges(_relationships(spark, sf_dir), _nodes(spark, sf_dir)))


def _schema(spark):
    entity_types = spark.createDataFrame([(n, "") for n in ("Region", "Nation", "Customer", "Supplier", "Part")], "name string, description string")
    relationship_types = spark.createDataFrame([("LOCATED_IN", "Customer", "Nation", ""), ("SUPPLIES", "Supplier", "Part", "")], "name string, from_type string, to_type string, description string")
    return entity_types, relationship_types


@query(f"{_GRAPH} SELECT node_id, label, name, key, value FROM nodes")
def f1_f2_merge_entity_nodes(spark, sf_dir):
    """The same load twice: the second changes nothing."""
    nodes = graph.merge_entity_nodes(_nodes(spark, sf_dir), _entities(spark, sf_dir))
    return nodes.select("node_id", "label", "name", F.explode("properties").alias("key", "value"))


@query(f"{_GRAPH} SELECT * FROM edges")
def f3_f5_resolve_edges(spark, sf_dir):
    edges = _edges(spark, sf_dir)
    return graph.merge_edges(edges, edges)


@query(f"{_GRAPH} SELECT a AS from_entity, t AS relationship_type, b AS to_entity FROM rel WHERE a NOT IN (SELECT name FROM nodes) OR b NOT IN (SELECT name FROM nodes)")
def f4_unmatched_relationships(spark, sf_dir):
    return graph.unmatched_relationships(_relationships(spark, sf_dir), _nodes(spark, sf_dir)).select("from_entity", "relationship_type", "to_entity")


def _names(spark, sf_dir) -> DataFrame:
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("w")).select(F.regexp_replace("w", "[^A-Za-z]", "").alias("w"))
    return words.where("length(w) >= 6").distinct().select(F.concat(F.lit("Term:"), "w").alias("node_id"), F.lit("Term").alias("label"), F.col("w").alias("name"))


_MENTIONS = """
n AS (SELECT DISTINCT regexp_replace(w, '[^A-Za-z]', '', 'g') AS w FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark)),
m AS (SELECT d.doc_id::VARCHAR AS src_id, 'MENTIONS' AS edge_type, 'Term:' || w AS dst_id FROM documents d JOIN n ON length(w) >= 6 AND contains(lower(d.text), lower(w)))
"""


@query(f"WITH {_MENTIONS} SELECT * FROM m")
def f7_link_mentions(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents")).select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"))
    return graph.link_mentions(docs, _names(spark, sf_dir))


@query(f"""{_GRAPH},
t AS (SELECT DISTINCT substr(md5(text), 1, 12) AS id, lower(text) AS low FROM documents WHERE text IS NOT NULL), m AS (SELECT DISTINCT id, node_id FROM t JOIN (SELECT DISTINCT node_id, lower(name) AS name FROM nodes) ON contains(low, name))
SELECT (SELECT count(*) FROM e) AS nodes_created, (SELECT count(*) FROM rel) AS relationships_created, (SELECT count(*) FROM documents WHERE text IS NOT NULL) AS chunks_created, (SELECT count(*) FROM nodes) AS nodes_distinct,
  (SELECT count(*) FROM edges) + (SELECT count(*) FROM m) AS edges_distinct, (SELECT count(*) FROM rel WHERE b = 'Nobody') AS unmatched""")
def e7_f8_load_stats(spark, sf_dir):
    """With every document as a chunk."""
    entities, relationships = _entities(spark, sf_dir), shared.written(aggregation.count_relationships(_relationships(spark, sf_dir)))
    chunks = table(spark, sf_dir, "documents").where("text is not null").select(F.col("text").alias("content"), "source", F.lit(None).cast("string").alias("section"), F.col("doc_id").alias("ord"))
    loaded = graph.chunks_to_graph(entities, relationships, chunks)
    return graph.load_stats(entities, relationships, chunks, loaded["nodes"], loaded["edges"])


@query(f"""{_GRAPH}
SELECT 'label' AS kind, label AS name, count(*) AS n FROM nodes GROUP BY label UNION ALL SELECT 'type', edge_type, count(*) FROM edges GROUP BY edge_type
UNION ALL SELECT 'total', 'nodes', count(*) FROM nodes UNION ALL SELECT 'total', 'relationships', count(*) FROM edges""")
def g6_e4_e5_graph_stats(spark, sf_dir):
    return validation.graph_stats(_nodes(spark, sf_dir), _edges(spark, sf_dir))


@query(f"{_GRAPH} SELECT (SELECT count(*) FROM nodes WHERE label = 'Part') AS nodes, (SELECT count(*) FROM edges WHERE edge_type = 'SUPPLIES') AS relationships")
def e6_graph_summary(spark, sf_dir):
    return graph.graph_summary(_nodes(spark, sf_dir), _edges(spark, sf_dir), label="Part", edge_type="SUPPLIES")


@query(f"""{_GRAPH} SELECT DISTINCT 'label' AS kind, label AS name FROM nodes WHERE label NOT IN ('Region', 'Nation', 'Customer', 'Supplier', 'Part')
UNION ALL SELECT DISTINCT 'type', edge_type FROM edges WHERE edge_type NOT IN ('LOCATED_IN', 'SUPPLIES')""")
def g1_unexpected(spark, sf_dir):
    entity_types, relationship_types = _schema(spark)
    labels = validation.unexpected_labels(_nodes(spark, sf_dir), entity_types).select(F.lit("label").alias("kind"), F.col("label").alias("name"))
    return labels.unionByName(validation.unexpected_types(_edges(spark, sf_dir), relationship_types).select(F.lit("type").alias("kind"), F.col("edge_type").alias("name")))


@query(f"{_GRAPH} SELECT node_id, label, name FROM nodes WHERE node_id NOT IN (SELECT src_id FROM edges UNION SELECT dst_id FROM edges)")
def g2_orphan_nodes(spark, sf_dir):
    return validation.orphan_nodes(_nodes(spark, sf_dir), _edges(spark, sf_dir)).select("node_id", "label", "name")


@query(f"WITH {_MENTIONS} SELECT doc_id::VARCHAR AS id FROM documents WHERE doc_id::VARCHAR NOT IN (SELECT src_id FROM m)")
def g3_dangling_chunks(spark, sf_dir):
    return validation.dangling_chunks(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id")), f7_link_mentions(spark, sf_dir))


_SPELLED = "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN ' ' || p_name ELSE p_name END AS name FROM part"


def _spelled(spark, sf_dir) -> DataFrame:
    kind = F.col("p_partkey") % 3
    return table(spark, sf_dir, "part").select("p_partkey", F.when(kind == 0, F.upper("p_name")).when(kind == 1, F.concat(F.lit(" "), "p_name")).otherwise(F.col("p_name")).alias("name"))


@query(f"SELECT trim(lower(name)) AS key, count(*) AS nodes, array_to_string(list_sort(list(DISTINCT name)), '|') AS names FROM ({_SPELLED}) GROUP BY 1 HAVING count(*) > 1")
def g4_duplicate_entities(spark, sf_dir):
    return validation.duplicate_entities(_spelled(spark, sf_dir)).select("key", "nodes", F.array_join("names", "|").alias("names"))


@query(f"""{_GRAPH}, s(t, f, g) AS (VALUES ('LOCATED_IN', 'Customer', 'Nation'), ('SUPPLIES', 'Supplier', 'Part'))
SELECT edge_type, count(*) AS edges, count(*) FILTER (x.label <> f OR y.label <> g) AS wrong FROM edges JOIN s ON t = edge_type JOIN nodes x ON x.node_id = src_id JOIN nodes y ON y.node_id = dst_id GROUP BY edge_type""")
def g5_wrong_direction_edges(spark, sf_dir):
    return validation.wrong_direction_edges(_nodes(spark, sf_dir), _edges(spark, sf_dir), _schema(spark)[1])


def _stored(graph_: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The graph written into the shared folder and read again, so that many checks don't build it anew."""
    spark = next(iter(graph_.values())).sparkSession
    path = shared.shared_path(spark)
    store.write_graph(graph_, path)
    return store.read_graph(spark, path)


def _linked_graph(spark, sf_dir) -> dict[str, DataFrame]:
    """The graph of the tables and the terms of ``benchmark``, and documents as chunks that mention these."""
    terms = _names(spark, sf_dir)
    nodes, edges = _nodes(spark, sf_dir).select("node_id", "label", "name"), _edges(spark, sf_dir)
    return _stored({"nodes": nodes.unionByName(terms), "edges": edges.unionByName(f7_link_mentions(spark, sf_dir)), "chunks": table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"))})


_CHECKS = f"""{_GRAPH}, {_MENTIONS}, every AS (SELECT node_id, label, name FROM nodes UNION ALL SELECT 'Term:' || w, 'Term', w FROM n WHERE length(w) >= 6),
links AS (SELECT * FROM edges UNION ALL SELECT * FROM m), ends AS (SELECT src_id FROM links UNION SELECT dst_id FROM links), s(t, f, g) AS (VALUES ('LOCATED_IN', 'Customer', 'Nation'), ('SUPPLIES', 'Supplier', 'Part')),
checks AS (
  SELECT 'unexpected_labels' AS "check", (SELECT count(DISTINCT label) FROM every WHERE label NOT IN ('Region', 'Nation', 'Customer', 'Supplier', 'Part')) AS n, 'warning' AS bad
  UNION ALL SELECT 'unexpected_types', (SELECT count(DISTINCT edge_type) FROM links WHERE edge_type NOT IN ('LOCATED_IN', 'SUPPLIES', 'MENTIONS')), 'warning'
  UNION ALL SELECT 'orphan_nodes', (SELECT count(*) FROM every WHERE node_id NOT IN (SELECT * FROM ends)), 'warning'
  UNION ALL SELECT 'dangling_chunks', (SELECT count(*) FROM documents WHERE doc_id::VARCHAR NOT IN (SELECT src_id FROM m)), 'warning'
  UNION ALL SELECT 'duplicate_entities', (SELECT count(*) FROM (SELECT lower(trim(name)) FROM every GROUP BY 1 HAVING count(*) > 1)), 'error'
  UNION ALL SELECT 'wrong_direction', (SELECT count(DISTINCT t) FROM edges JOIN s ON t = edge_type JOIN nodes x ON x.node_id = src_id JOIN nodes y ON y.node_id = dst_id WHERE x.label <> f OR y.label <> g), 'warning'),
report AS (SELECT "check", n, CASE WHEN n = 0 THEN 'pass' ELSE bad END AS severity FROM checks)"""


@query(f"{_CHECKS} SELECT * FROM report")
def g7_validation_report(spark, sf_dir):
    found = _linked_graph(spark, sf_dir)
    return validation.validation_report(found["nodes"], found["edges"], found["chunks"], *_schema(spark))


@query(f"""{_CHECKS} SELECT severity, count(*) AS n FROM (SELECT severity FROM report WHERE "check" NOT IN ('unexpected_labels', 'unexpected_types', 'wrong_direction') UNION ALL SELECT 'info' FROM range(3)) GROUP BY severity""")
def g7_severity_counts(spark, sf_dir):
    """Without a schema: three checks can only inform."""
    found = _linked_graph(spark, sf_dir)
    return validation.severity_counts(validation.validation_report(found["nodes"], found["edges"], found["chunks"], None, None))


@query("SELECT md5('Document' || chr(1) || source) AS node_id, source AS name, count(DISTINCT doc_id) AS chunks FROM documents GROUP BY source")
def p2_document_nodes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "source", F.lit(".txt").alias("file_type"))
    edges = graph.from_document_edges(docs).groupBy(F.col("dst_id").alias("node_id")).agg(F.count("*").alias("chunks"))
    return graph.document_nodes(docs).join(edges, "node_id").select("node_id", "name", "chunks")


@query(f"""WITH s AS ({_SPELLED}), c AS (SELECT trim(lower(name)) AS key, name, count(*) AS n, min(p_partkey) AS f FROM s GROUP BY ALL)
SELECT name, md5(key) AS canonical_id, first(name) OVER (PARTITION BY key ORDER BY n DESC, f) AS canonical_name FROM c""")
def p3_resolve_entities(spark, sf_dir):
    return graph.resolve_entities(_spelled(spark, sf_dir).withColumn("ord", F.col("p_partkey")))


@query(f"""
WITH s AS ({_SPELLED}), d AS (SELECT key, (row_number() OVER (ORDER BY key) - 1) // 5 AS g FROM (SELECT DISTINCT trim(lower(name)) AS key FROM s)),
c AS (SELECT g, name, count(*) AS n, min(p_partkey) AS f FROM s JOIN d ON key = trim(lower(name)) GROUP BY ALL), r AS (SELECT name, first(name) OVER (PARTITION BY g ORDER BY n DESC, f) AS canonical FROM c),
e AS (SELECT DISTINCT s_name, canonical FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN s ON l_partkey = s.p_partkey JOIN r USING (name))
SELECT 'node' AS kind, md5('Part' || chr(1) || canonical) AS a, canonical AS b, arg_max(brand, (name = canonical, name)) AS c FROM r JOIN (SELECT DISTINCT name, first(p_brand) OVER (PARTITION BY name ORDER BY s.p_partkey DESC) AS brand FROM s JOIN part ON part.p_partkey = s.p_partkey) USING (name) GROUP BY canonical
UNION ALL SELECT 'edge', md5('Supplier' || chr(1) || s_name), 'SUPPLIES', md5('Part' || chr(1) || canonical) FROM e""")
def p3_aliases_and_edges(spark, sf_dir):
    """Five names in alphabetic order are aliases in a chain; nodes merge under the canonical name, edges go there."""
    spelled = _spelled(spark, sf_dir)
    parts = spelled.join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey")
    rows = parts.select("name", F.lit("Part").alias("entity_type"), F.create_map(F.lit("brand"), "p_brand").alias("properties"), F.col("p_partkey").alias("ord"))
    suppliers = table(spark, sf_dir, "supplier")
    made = suppliers.select(F.col("s_name").alias("name"), F.lit("Supplier").alias("entity_type"), F.create_map().cast("map<string,string>").alias("properties"), F.col("s_suppkey").cast("long").alias("ord"))
    nodes = graph.merge_entity_nodes(None, rows.withColumn("ord", F.col("ord").cast("long")).unionByName(made))
    sold = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct().join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(spelled, F.col("l_partkey") == F.col("p_partkey"))
    edges = graph.resolve_edges(sold.select(F.col("s_name").alias("from_entity"), F.lit("SUPPLIES").alias("relationship_type"), F.col("name").alias("to_entity")), nodes)
    keys = spelled.select(F.trim(F.lower("name")).alias("key")).distinct()  # 64 names whatever the scale
    numbered = keys.withColumn("k", F.row_number().over(Window.orderBy("key")))
    aliases = numbered.alias("x").join(numbered.alias("y"), (F.col("y.k") == F.col("x.k") + 1) & (F.col("x.k") % 5 > 0)).select(F.upper("x.key").alias("a"), F.col("y.key").alias("b"))
    resolved = graph.resolve_entities(rows, aliases)
    merged, mapping = graph.canonical_nodes(nodes, resolved)
    shown = merged.where("label = 'Part'").select(F.lit("node").alias("kind"), F.col("node_id").alias("a"), F.col("name").alias("b"), F.try_element_at("properties", F.lit("brand")).alias("c"))
    return shown.unionByName(graph.rewrite_edges(edges, mapping).select(F.lit("edge").alias("kind"), F.col("src_id").alias("a"), F.col("edge_type").alias("b"), F.col("dst_id").alias("c")))


@query("""
WITH s AS (SELECT q.vec_id AS query_id, d.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) AS score FROM embeddings q JOIN embeddings d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, round(score, 5) AS score FROM r WHERE rank <= 5""")
def p4_top_k_similar(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return retrieval.top_k_similar(rows.where("vec_id % 100 = 0"), rows, 5).withColumn("score", F.round("score", 5))


@query(f"""{_GRAPH}, s AS (SELECT node_id FROM nodes WHERE label = 'Supplier'), h1 AS (SELECT DISTINCT s.node_id AS a, dst_id AS b FROM s JOIN edges ON src_id = s.node_id AND edge_type = 'SUPPLIES'),
h2 AS (SELECT DISTINCT a, dst_id AS b FROM h1 JOIN edges ON src_id = b AND edge_type = 'SUPPLIES'),
w AS (SELECT node_id AS a, node_id AS b, 0 AS h FROM s UNION ALL SELECT a, b, 1 FROM h1 UNION ALL SELECT a, b, 2 FROM h2)
SELECT a AS start_id, b AS node_id, min(h)::INT AS hop FROM w GROUP BY a, b""")
def p7_k_hop(spark, sf_dir):
    return retrieval.k_hop(_nodes(spark, sf_dir).where("label = 'Supplier'"), _edges(spark, sf_dir), 2, ("SUPPLIES",))


@query(f"""{_GRAPH} SELECT DISTINCT x.src_id AS start_id, y.dst_id AS node_id FROM edges x JOIN edges y ON y.src_id = x.dst_id WHERE x.edge_type = 'LOCATED_IN' AND y.edge_type = 'LOCATED_IN'""")
def p7_match_path(spark, sf_dir):
    return retrieval.match_path(_nodes(spark, sf_dir), _edges(spark, sf_dir), ("LOCATED_IN", "LOCATED_IN"))


@query(f"""{_GRAPH}, s AS (SELECT node_id FROM nodes WHERE label = 'Region'), two AS (SELECT src_id, dst_id FROM edges UNION SELECT dst_id, src_id FROM edges),
h(a, b, k) AS (SELECT node_id, node_id, 0 FROM s
  UNION ALL SELECT DISTINCT a, dst_id, k + 1 FROM (SELECT DISTINCT a, b, k FROM h) JOIN two ON src_id = b WHERE k < 3)
SELECT a AS start_id, b AS node_id, min(k)::INT AS hop FROM h GROUP BY a, b""".replace("WITH e AS", "WITH RECURSIVE e AS"))
def p7_k_hop_undirected(spark, sf_dir):
    """Three hops in both directions from each region, through nations with very many customers."""
    return retrieval.k_hop(_nodes(spark, sf_dir).where("label = 'Region'"), shared.written(_edges(spark, sf_dir)), 3, directed=False)


@query(f"""{_GRAPH} SELECT x.src_id AS start_id, y.dst_id AS node_id, x.src_id || '|' || x.dst_id || '|' || y.dst_id AS nodes, 'LOCATED_IN>LOCATED_IN' AS types FROM edges x JOIN edges y ON y.src_id = x.dst_id WHERE x.edge_type = 'LOCATED_IN' AND y.edge_type = 'LOCATED_IN'""")
def p7_match_path_rows(spark, sf_dir):
    """Each path from a place's customer over the nation to the region, with all its nodes and edges."""
    found = retrieval.match_path_rows(_nodes(spark, sf_dir), _edges(spark, sf_dir), ("LOCATED_IN", "LOCATED_IN"))
    return found.select("start_id", "node_id", F.array_join("nodes", "|").alias("nodes"), F.array_join("edges.edge_type", ">").alias("types"))


@query("""
WITH s AS (SELECT q.vec_id AS query_id, d.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) AS score FROM embeddings q JOIN embeddings d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s),
h AS (SELECT query_id, vec_id FROM r WHERE rank <= 5)
SELECT query_id, 'chunk' AS kind, vec_id::VARCHAR AS id, 'chunk ' || vec_id AS text FROM h
UNION ALL SELECT DISTINCT query_id, 'entity', 'n' || (label + k), 'Label: ' || (label + k) FROM h JOIN embeddings USING (vec_id), (VALUES (0), (1)) t(k)""")
def p6_hybrid_context(spark, sf_dir):
    return _contexts(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def _contexts(rows: DataFrame, asked: str) -> DataFrame:
    chunk = F.col("vec_id").cast("string")
    n = lambda c: F.concat(F.lit("n"), c.cast("string"))
    hits = retrieval.top_k_similar(rows.where(asked), rows, 5).select("query_id", "rank", chunk.alias("id"))
    chunks = rows.select(chunk.alias("id"), F.concat(F.lit("chunk "), chunk).alias("text"))
    mentions = rows.select(chunk.alias("src_id"), F.lit("MENTIONS").alias("edge_type"), n(F.col("label")).alias("dst_id"))
    labels = rows.select("label").unionByName(rows.select((F.col("label") + 1).alias("label"))).distinct()
    edges = mentions.unionByName(labels.select(n(F.col("label")).alias("src_id"), F.lit("NEXT").alias("edge_type"), n(F.col("label") + 1).alias("dst_id")))
    nodes = labels.select(n(F.col("label")).alias("node_id"), F.lit("Label").alias("label"), F.col("label").cast("string").alias("name"))
    return retrieval.hybrid_context(hits, chunks, edges, nodes)


@query("""
SELECT conv_id AS doc_id, count(*) AS chunks, count(*) FILTER (turn % 4 = 3) AS failed, sum(turn % 3)::BIGINT AS retries, count(*) FILTER (turn % 4 <> 3 AND turn % 5 = 0) AS malformed, round(sum(1 + turn % 3) * 0.003::DOUBLE, 6) AS cost, sum(turn % 2)::BIGINT AS throttles, round(avg(turn / 4), 6) AS mean_seconds, max(turn / 4)::DOUBLE AS longest_seconds, count(*) AS entities,
  1 - (SELECT count(DISTINCT role) FROM conversations) / (SELECT count(*) FROM conversations) AS dedup_ratio FROM conversations GROUP BY conv_id""")
def p8_pipeline_metrics(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    calls = rows.select(F.col("conv_id").alias("doc_id"), F.when(F.col("turn") % 5 == 0, "none").otherwise("{}").alias("response"), (1 + F.col("turn") % 3).cast("int").alias("attempts"), F.when(F.col("turn") % 4 == 3, "failed").otherwise("ok").alias("status"),
        (F.col("turn") % 2).alias("throttles"), (F.col("turn") / 4).alias("seconds"))
    entities = rows.select(F.col("conv_id").alias("doc_id"), "role")
    out = retrieval.pipeline_metrics(calls, entities, entities.select("role").distinct())
    return out.withColumn("cost", F.round("cost", 6)).withColumn("mean_seconds", F.round("mean_seconds", 6)).withColumn("throttles", F.col("throttles").cast("long")).withColumn("retries", F.col("retries").cast("long"))


# --- files, stores, prompts and calls ----------------------------------------------------------------------------


@query(r"""
WITH l AS (SELECT unnest(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))) AS line FROM documents)
SELECT '.txt' AS file_type, 'parsed' AS status, md5(line) AS line, count(*) AS n FROM l GROUP BY line""")
def a1_a3_a7_parse_documents(spark, sf_dir):
    """The documents as text files of 100 each in the shared folder, read back and parsed; all their lines."""
    path = shared.shared_path(spark)
    spread(table(spark, sf_dir, "documents")).where("text is not null").select("text").write.option("maxRecordsPerFile", 100).text(path)
    parsed = files.parse_documents(files.read_files(spark, path))
    lines = F.explode(F.split(F.regexp_replace("markdown", r"\n\z", ""), "\n", -1))  # a file ends with a line end
    return parsed.select("file_type", "status", lines.alias("line")).groupBy("file_type", "status", F.md5("line").alias("line")).agg(F.count("*").alias("n"))


@query(f"""
WITH l AS ({_LINES}), p AS (SELECT doc_id, count(*) AS total_pages, count(*) FILTER (i < 3) AS c, count(*) FILTER (i < 3 AND length(trim(t)) >= 50) AS w, sum(length(trim(t))) FILTER (i < 3) AS chars FROM l GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS num_sheets, sum(greatest(length(t) % 7 - 1, 0))::BIGINT AS num_rows FROM l WHERE doc_id % 2 = 0 GROUP BY doc_id)
SELECT d.doc_id, source, CASE WHEN w = c THEN 'digital' WHEN w = 0 THEN 'scanned' ELSE 'hybrid' END AS pdf_type, w <> c AS ocr_applied, total_pages, chars / c AS avg_chars_per_page, num_sheets, num_rows
FROM documents d LEFT JOIN p USING (doc_id) LEFT JOIN s USING (doc_id)""")
def a8_document_metadata(spark, sf_dir):
    """Lines as pages; those of even documents also as sheets."""
    docs = table(spark, sf_dir, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "t"))
    pages = markup.classify_pdf_pages(lines.select("doc_id", (F.col("i") + 1).alias("page_no"), F.col("t").alias("text")))
    sheets = lines.where("doc_id % 2 = 0").select("doc_id", F.col("i").alias("sheet"), (F.length("t") % 7).alias("rows"))
    return files.document_metadata(docs.select("doc_id", "source"), pages, sheets)


@query("""
SELECT 'entity' AS kind, r_name AS name, 'A region' AS description, string_agg(n_name, '|' ORDER BY n_name) AS more FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
UNION ALL SELECT 'relationship', 'LOCATED_IN', '', n_name || '|' || r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def a9_schema_json(spark, sf_dir):
    """A schema made of the regions and nations, as JSON and back."""
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    regions = places.groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("nations"))
    entity_types = regions.agg(F.collect_list(F.struct(F.col("r_name").alias("name"), F.lit("A region").alias("description"), F.col("nations").alias("example_properties"))).alias("entity_types"))
    relations = places.agg(F.collect_list(F.struct(F.lit("LOCATED_IN").alias("name"), F.col("n_name").alias("from_type"), F.col("r_name").alias("to_type"), F.lit("").alias("description"))).alias("relationship_types"))
    path = shared.shared_path(spark)
    store.write_schema_json(entity_types.crossJoin(relations), path)  # one row each
    kinds, links = store.read_schema_json(spark, path)
    out = kinds.select(F.lit("entity").alias("kind"), "name", "description", F.array_join("example_properties", "|").alias("more"))
    return out.unionByName(links.select(F.lit("relationship").alias("kind"), "name", "description", F.concat_ws("|", "from_type", "to_type").alias("more")))


@query(f"{_GRAPH} SELECT DISTINCT 'node' AS kind, node_id AS a, label AS b, name AS c FROM nodes UNION ALL SELECT 'edge', src_id, edge_type, dst_id FROM edges")
def a10_write_read_graph(spark, sf_dir):
    found = _stored({"nodes": _nodes(spark, sf_dir), "edges": _edges(spark, sf_dir)})
    nodes = found["nodes"].select(F.lit("node").alias("kind"), F.col("node_id").alias("a"), F.col("label").alias("b"), F.col("name").alias("c"))
    return nodes.unionByName(found["edges"].select(F.lit("edge").alias("kind"), F.col("src_id").alias("a"), F.col("edge_type").alias("b"), F.col("dst_id").alias("c")))


@query(f"{_GRAPH} SELECT 'node' AS kind, node_id AS a, label AS b, name AS c, value AS d FROM nodes UNION ALL SELECT 'edge', src_id, edge_type, dst_id, NULL FROM edges")
def a10_two_loads(spark, sf_dir):
    """The graph in two loads of a bucketed store: places and customers under old properties, then all else and the customers as
    they are; the second load comes twice, as a batch that is asked for again."""
    entities, links = _entities(spark, sf_dir), _relationships(spark, sf_dir)
    places = entities.where("entity_type in ('Region', 'Continent', 'Nation', 'Customer')").withColumn("properties", F.transform_values("properties", lambda k, v: F.when(k == "segment", "before").otherwise(v)))
    held = store.GraphStore(spark, shared.shared_path(spark))
    held.load(places, links.where("relationship_type = 'LOCATED_IN'"), once=("q", 0))
    for _ in range(2):
        held.load(entities.where("entity_type in ('Customer', 'Supplier', 'Part')"), links, once=("q", 1))
    found = held.read()
    nodes = found["nodes"].select(F.lit("node").alias("kind"), F.col("node_id").alias("a"), F.col("label").alias("b"), F.col("name").alias("c"), F.get(F.map_values("properties"), F.lit(0)).alias("d"))
    return nodes.unionByName(found["edges"].select(F.lit("edge").alias("kind"), F.col("src_id").alias("a"), F.col("edge_type").alias("b"), F.col("dst_id").alias("c"), F.lit(None).cast("string").alias("d")))


@query("""
WITH r AS (SELECT *, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 30 AS g FROM customer)
SELECT c_nationkey AS doc_id, g::INT AS chunk_seq, 'table' AS content_type, (g * 30 + 1) || '-' || (g * 30 + count(*)) AS row_range,
  md5('| Key | Name & segment |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || c_custkey || ' | ' || c_name || ' – ' || c_mktsegment || ' |', chr(10) ORDER BY c_custkey)) AS digest
FROM r GROUP BY c_nationkey, g""")
def a4_b2_c3_html_tables(spark, sf_dir):
    """An HTML table for each nation's customers, to markdown, to table chunks."""
    row = F.concat(F.lit("<tr>\n <td>"), "c_custkey", F.lit("</td>\n <td class='n'>"), "c_name", F.lit(" &#8211; "), "c_mktsegment", F.lit("</td></tr>\n"))
    rows = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", row.alias("row")))), lambda x: x["row"]), "").alias("rows"))
    html = F.concat(F.lit("<html><style>x</style><table border=1><thead><tr><th>Key</th><th>Name &amp; segment</th></tr></thead>"), "rows", F.lit("</table></html>"))
    docs = spread(rows.select("doc_id", markup.html_to_markdown(html).alias("markdown")))
    return chunking.chunk_documents(docs).select("doc_id", "chunk_seq", "content_type", "row_range", F.md5("content").alias("digest"))


@query("SELECT doc_id, contains(text, '{') AS has_json FROM documents UNION ALL SELECT doc_id, contains('{' || text, '{') FROM documents WHERE doc_id % 2 = 0")
def b5_looks_like_json(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.unionByName(docs.where("doc_id % 2 = 0").withColumn("text", F.concat(F.lit("{"), "text")))
    return docs.select("doc_id", looks_like_json(F.col("text")).alias("has_json"))


@query(f"""{_PACKED},
n AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM chunks),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_seq) AS k FROM n WHERE n <= 3 OR (chunk_seq % (n // 3) = 0 AND chunk_seq // (n // 3) < 3))
SELECT doc_id, md5('Name the types.' || string_agg(chr(10) || '--- Sample ' || k || ' (from ) ---' || chr(10) || content || chr(10), '' ORDER BY k)) AS digest FROM s GROUP BY doc_id""")
def d2_discovery_prompt(spark, sf_dir):
    samples = extraction.sample_chunks(_plain_chunks(spark, sf_dir), k=3)
    return extraction.build_discovery_prompt(samples, "Name the types.", by=("doc_id",)).select("doc_id", F.md5("prompt").alias("digest"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN p_brand END AS entity, CASE WHEN p_partkey % 4 < 3 THEN p_type END AS description, CASE WHEN p_partkey % 4 < 2 THEN 'MADE_BY Part ' || p_brand END AS relationship FROM part""")
def d3_parse_schema_response(spark, sf_dir):
    """Clean, after prose, without relationships, and cut off."""
    kind = F.col("p_partkey") % 4
    entities = F.format_string('{"entity_types":[{"name":"%s","description":"%s"}]', "p_brand", "p_type")
    whole = F.concat(entities, F.format_string(',"relationship_types":[{"name":"MADE_BY","from_type":"Part","to_type":"%s"}]}', "p_brand"))
    text = F.when(kind == 0, whole).when(kind == 1, F.concat(F.lit("The schema: "), whole, F.lit(" Done."))).when(kind == 2, F.concat(entities, F.lit("}"))).otherwise(entities)
    found = spread(table(spark, sf_dir, "part").select("p_partkey", text.alias("t"))).select("p_partkey", extraction.parse_schema_response(F.col("t")).alias("s"))
    entity, relation = F.try_element_at("s.entity_types", F.lit(1)), F.try_element_at("s.relationship_types", F.lit(1))
    shown = F.when(relation.isNotNull(), F.concat_ws(" ", relation["name"], relation["from_type"], relation["to_type"]))
    return found.select("p_partkey", entity["name"].alias("entity"), entity["description"].alias("description"), shown.alias("relationship"))


def _answering():
    """A model that is throttled once, throttled always, denies, answers without JSON, or answers, by the text's length."""
    tried = {"n": 0}

    def ask(prompt: str) -> str:
        text = prompt.split("TEXT:\n", 1)[1]
        kind, tried["n"] = len(text) % 6, tried["n"] + 1
        if kind == 0 or (kind == 1 and tried["n"] == 1):
            tried["n"] %= 3
            raise extraction.RetryableError("slow down")
        if kind == 2:
            tried["n"] = 0
            raise extraction.FatalError("denied")
        tried["n"] %= 3 if kind == 3 else 1
        return "none" if kind == 3 else json.dumps({"entities": [{"name": text[:5], "type": "Start"}]})

    return ask


@query(f"""
WITH d AS (SELECT doc_id, text, length(text) % 6 AS kind FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE kind WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 3 THEN 3 ELSE 1 END::INT AS attempts, CASE WHEN kind IN (0, 2) THEN 'failed' ELSE 'ok' END AS status, CASE kind WHEN 0 THEN 'RetryableError: slow down' WHEN 2 THEN 'FatalError: denied' END AS error,
  CASE kind WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 0 END::INT AS throttles, CASE WHEN kind IN (1, 4, 5) THEN left(text, 5) END AS name,
  md5('ENTITY TYPES:' || chr(10) || '  - Start: how a text begins' || chr(10) || 'RELATIONSHIP TYPES:' || chr(10) || '  - NEXT: (Start) -> (Start) — follows' || chr(10) || 'Answer in JSON.' || chr(10) || 'TEXT:' || chr(10) || text) AS prompt
FROM d""")
def d4_d5_d7_extract_chunks(spark, sf_dir):
    """Every document's text as a chunk, answered by a function that fails in every way, and asked again as D5 says."""
    chunks = spread(table(spark, sf_dir, "documents")).where("text is not null").select("doc_id", F.col("text").alias("content"))
    asked = extraction.extract_chunks(chunks, _answering(), [("Start", "how a text begins")], [("NEXT", "Start", "Start", "follows")], "Answer in JSON.", wait=lambda s: None)
    return asked.select("doc_id", "attempts", "status", "error", "throttles", F.try_element_at("extraction.entities", F.lit(1))["name"].alias("name"), F.md5("prompt").alias("prompt"))


@query("SELECT doc_id, md5('{' || left(text, 40)) AS response, CASE WHEN text IS NULL THEN 'failed' ELSE 'ok' END AS status, 1 AS calls FROM documents WHERE text IS NOT NULL")
def d5_answer_prompts(spark, sf_dir):
    """One call for each distinct beginning of a document, from a table of answers that a first run over half of them has filled."""
    docs = spread(table(spark, sf_dir, "documents")).where("text is not null").select("doc_id", F.left("text", F.lit(40)).alias("prompt"))
    answers = shared.shared_path(spark)
    extraction.answer_prompts(docs.where("doc_id % 2 = 0"), lambda p: "{" + p, answers, parallel=4)
    found = extraction.answer_prompts(docs, lambda p: "{" + p, answers, parallel=4)
    calls = spark.read.parquet(answers).groupBy("prompt_id").agg(F.count("*").cast("int").alias("calls"))
    return found.withColumn("prompt_id", F.sha2("prompt", 256)).join(calls, "prompt_id").select("doc_id", F.md5("response").alias("response"), "status", "calls")


@query("SELECT doc_id, length(text)::FLOAT AS a, (length(text) - length(replace(text, 'e', '')))::FLOAT AS b FROM documents WHERE text IS NOT NULL")
def p5_embed_chunks(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents")).where("text is not null").select("doc_id", F.col("text").alias("content"))
    found = extraction.embed_chunks(docs, lambda texts: [[float(len(t)), float(t.count("e"))] for t in texts])
    return found.select("doc_id", F.get("embedding", F.lit(0)).alias("a"), F.get("embedding", F.lit(1)).alias("b"))


@query("""
WITH e AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_name END AS name, p_size::VARCHAR AS size, p_partkey % 3 = 0 AS named, p_partkey AS o FROM part)
SELECT md5('Part' || chr(1) || name) AS node_id, name, arg_max(size, o) AS size, CASE WHEN bool_or(named) THEN name END AS given FROM e GROUP BY name""")
def f2_effective_name(spark, sf_dir):
    """A third of the parts carry a property called name, which takes the name's place."""
    parts = table(spark, sf_dir, "part").withColumn("size", F.col("p_size").cast("string"))
    properties = F.when(F.col("p_partkey") % 3 == 0, F.create_map(F.lit("name"), "p_brand", F.lit("size"), "size")).otherwise(F.create_map(F.lit("size"), F.col("size")))
    nodes = graph.merge_entity_nodes(None, parts.select(F.col("p_name").alias("name"), F.lit("Part").alias("entity_type"), properties.alias("properties"), F.col("p_partkey").alias("ord")))
    return nodes.select("node_id", "name", F.try_element_at("properties", F.lit("size")).alias("size"), F.try_element_at("properties", F.lit("name")).alias("given"))


@query("""
WITH n AS (SELECT DISTINCT regexp_replace(w, '[^A-Za-z]', '', 'g') AS w FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark)),
nodes AS (SELECT md5('Term' || chr(1) || w) AS node_id, 'Term' AS label, w AS name FROM n WHERE length(w) >= 6),
chunks AS (SELECT substr(md5(text), 1, 12) AS id, any_value(text) AS text, arg_max(source, doc_id) AS source, length(any_value(text)) AS char_count FROM documents WHERE text IS NOT NULL GROUP BY md5(text)),
pairs AS (SELECT name AS a, lead(name) OVER (PARTITION BY left(lower(name), 1) ORDER BY name) AS b FROM nodes)
SELECT 'node' AS kind, node_id AS a, label AS b, name AS c FROM nodes
UNION ALL SELECT 'chunk', id, source, char_count || ' ' || md5(left(text, 2000)) FROM chunks
UNION ALL SELECT 'edge', x.node_id, 'NEXT', y.node_id FROM pairs JOIN nodes x ON x.name = a JOIN nodes y ON y.name = b
UNION ALL SELECT 'edge', id, 'MENTIONS', node_id FROM chunks, nodes WHERE contains(lower(text), lower(name))""")
def f8_chunks_to_graph(spark, sf_dir):
    """Terms, the next term of each, and documents as chunks: even documents first, then all of them over what that left."""
    terms = _names(spark, sf_dir).select("name", F.lit("Term").alias("entity_type"), F.create_map().cast("map<string,string>").alias("properties"), F.lit(1).alias("ord"))
    after = Window.partitionBy(F.left(F.lower("name"), F.lit(1))).orderBy("name")
    links = terms.select(F.col("name").alias("from_entity"), F.lead("name").over(after).alias("to_entity"), F.lit("NEXT").alias("relationship_type"), "properties")
    docs = table(spark, sf_dir, "documents").where("text is not null").select(F.col("text").alias("content"), "source", F.lit(None).cast("string").alias("section"), F.col("doc_id").alias("ord"))
    found = _stored(graph.chunks_to_graph(terms, links, docs.where("ord % 2 = 0")))
    found = graph.chunks_to_graph(terms, links, docs, found)
    row = lambda df, kind, a, b, c: df.select(F.lit(kind).alias("kind"), F.col(a).alias("a"), F.col(b).alias("b"), c.alias("c"))
    chunks = row(found["chunks"], "chunk", "id", "source", F.concat_ws(" ", "char_count", F.md5("text")))
    return row(found["nodes"], "node", "node_id", "label", F.col("name")).unionByName(chunks).unionByName(row(found["edges"], "edge", "src_id", "edge_type", F.col("dst_id")))
