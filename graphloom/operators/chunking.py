"""Documents to chunks. A document stays in its row until its chunks are exploded: no shuffle.

Chunkers are expressions from a text to an array of ``CHUNK`` structs. Null texts have no chunks.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions.text import chunk_id, detect_content_type, header_title, let, strip

CHUNK = "struct<content:string,section:string,chunk_index:int,content_type:string,char_count:int,row_range:string,page_range:string,merged:boolean>"
NARRATIVE, TABLE, PAGES = "narrative", "table", "ocr_text"


def _chunk(content, section, index, kind, row_range=None, page_range=None, merged=None) -> Column:
    none = lambda x, t: F.lit(None).cast(t) if x is None else x
    return F.struct(
        content.alias("content"), section.alias("section"), index.cast("int").alias("chunk_index"), F.lit(kind).alias("content_type"), F.length(content).cast("int").alias("char_count"),
        none(row_range, "string").alias("row_range"), none(page_range, "string").alias("page_range"), none(merged, "boolean").alias("merged"),
    )


def _group_starts(lengths: Column, step) -> Column:
    """The places at which groups begin, by a fold over lengths: ``step`` takes the state (from 0) and a length, and gives whether
    a group begins there and the next state. The first place begins one.

    The fold runs over blocks of about the root of their number, so that lists stay short while they grow.
    """

    def over(items):
        block = F.greatest(F.ceil(F.sqrt(F.size(items))), F.lit(1)).cast("int")
        empty = F.array().cast("array<int>")
        state = lambda found, now: F.struct(found.alias("found"), now.cast("int").alias("now"))

        def one(s, x):
            begins, now = step(s["now"], x["n"])
            return state(F.when(begins | (x["i"] == 0), F.concat(s["found"], F.array(x["i"]))).otherwise(s["found"]), now)

        def many(s, first):
            return let(F.aggregate(F.slice(items, first + 1, block), state(empty, s["now"]), one), lambda part: state(F.concat(s["found"], part["found"]), part["now"]))

        firsts = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1, block)).otherwise(empty)
        return F.aggregate(firsts, state(empty, F.lit(0)), many)["found"]

    return let(F.transform(lengths, lambda n, i: F.struct(n.alias("n"), i.alias("i"))), over)


def _grouped(items: Column, starts: Column, build) -> Column:
    """``build`` (the group's items, first place, place after the last, number) of each group of ``items``."""
    both = F.struct(items.alias("items"), starts.alias("starts"))

    def each(b):
        end = lambda i: F.coalesce(F.get(b["starts"], i + 1), F.size(b["items"]))
        return F.transform(b["starts"], lambda a, i: build(F.slice(b["items"], a + 1, end(i) - a), a, end(i), i))

    return let(both, each)


def _filling(max_size: int):
    """C2's rule: each text weighs its length and 2, and a group holds ``max_size`` or a single text."""
    return lambda weight, n: ((weight > 0) & (weight + n + 2 > max_size), F.when((weight > 0) & (weight + n + 2 > max_size), n + 2).otherwise(weight + n + 2))


def pack_paragraphs(text: Column, max_size: int) -> Column:
    """Paragraphs (split at empty lines) filled into texts from the left. Work grows with the text's length."""
    parts = F.filter(F.transform(F.split(text, "\n\n", -1), strip), lambda p: p != "")
    return let(parts, lambda ps: _grouped(ps, _group_starts(F.transform(ps, F.length), _filling(max_size)), lambda some, a, b, i: F.array_join(some, "\n\n")))


def chunk_by_paragraphs(text: Column, max_size: int = 1500, section: Column | None = None) -> Column:
    """C2. A paragraph over ``max_size`` stays one chunk; the section of plain text is empty."""
    section = F.lit("") if section is None else section
    return F.transform(pack_paragraphs(text, max_size), lambda c, i: _chunk(c, section, i, NARRATIVE))


def _renumber(chunks: Column) -> Column:
    return F.transform(chunks, lambda c, i: c.withField("chunk_index", i.cast("int")))


def chunk_by_headers(text: Column, max_size: int = 1500, min_size: int = 100) -> Column:
    """A chunk for each section under a header of level 1-4, larger ones by C2, then C5. A header without body vanishes."""
    header = r"(?Umd)^#{1,4}\s+.+$"
    both = F.struct(F.split(text, header, -1).alias("bodies"), F.regexp_extract_all(text, F.lit(header), 0).alias("headers"))

    def section(b):  # the first body has no header
        return F.transform(b["bodies"], lambda body, i: F.struct(strip(F.coalesce(F.get(b["headers"], i - 1), F.lit(""))).alias("header"), strip(body).alias("body")))

    sections = F.filter(let(both, section), lambda s: s["body"] != "")

    def chunks(s):
        full = F.when(s["header"] != "", F.concat(s["header"], F.lit("\n\n"), s["body"])).otherwise(s["body"])
        title = F.when(s["header"] != "", header_title(s["header"])).otherwise("Introduction")
        whole = F.array(_chunk(full, title, F.lit(0), NARRATIVE))
        return F.when(F.length(full) <= max_size, whole).otherwise(chunk_by_paragraphs(full, max_size, title))

    return merge_small_chunks(_renumber(F.flatten(F.transform(sections, chunks))), min_size)


def merge_small_chunks(chunks: Column, min_size: int = 100) -> Column:
    """A chunk under ``min_size`` joins the next one and takes its metadata; that pair is done. A short last chunk stays."""

    def pair(some, a, b, i):
        first, last = F.get(some, F.lit(0)), F.element_at(some, -1)
        text = F.concat(first["content"], F.lit("\n\n"), last["content"])
        return F.when(F.size(some) == 1, first).otherwise(last.withField("content", text).withField("char_count", F.length(text).cast("int")).withField("merged", F.lit(True)))

    # The state is 1 after a short chunk that waits for the next one.
    waiting = lambda waits, n: (waits == 0, F.when((waits == 0) & (n < min_size), 1).otherwise(0))
    return let(chunks, lambda cs: _grouped(cs, _group_starts(F.transform(cs, lambda c: F.length(c["content"])), waiting), pair))


def chunk_by_pages(text: Column, max_size: int = 1500) -> Column:
    """C4: pages split at rules, else at page headers, else at gaps of 3 line ends, filled up as in C2; without pages C2."""
    rules, heads, gaps = (F.split(text, p, -1) for p in (r"(?U)\n---\s*\n", r"(?U)\n#{1,2}\s+Page\s+\d+", r"\n{3,}"))
    pages = F.when(F.size(rules) > 1, rules).when(F.size(heads) > 1, heads).otherwise(gaps)

    def of(pages):
        numbered = F.filter(F.transform(pages, lambda p, i: F.struct(strip(p).alias("text"), (i + 1).alias("no"))), lambda p: p["text"] != "")

        def chunk(ps, some, a, b, i):
            # A range begins at the page that overflowed, the first one at 1; the last one ends at the page total.
            first = F.when(i == 0, 1).otherwise(F.get(some, F.lit(0))["no"])
            last = F.coalesce(F.get(ps, b)["no"] - 1, F.size(pages))
            span = F.concat(first.cast("string"), F.lit("-"), last.cast("string"))
            return _chunk(F.array_join(F.transform(some, lambda p: p["text"]), "\n\n"), F.concat(F.lit("Pages "), span), i, PAGES, page_range=span)

        return let(numbered, lambda ps: _grouped(ps, _group_starts(F.transform(ps, lambda p: F.length(p["text"])), _filling(max_size)), lambda some, a, b, i: chunk(ps, some, a, b, i)))

    paged = F.when(F.size(pages) > 1, let(pages, of))
    return F.when(F.size(paged) > 0, paged).otherwise(chunk_by_paragraphs(text, max_size))


_RULE, _TITLE = re.compile(r"\|[\s\-:|]+\|"), re.compile(r"#{1,4}\s+")


def _table_spans(lines: list[str], per_chunk: int):
    """(header line, separator, section, first row number, rows) of each table chunk, and the other lines."""
    titled = [bool(_TITLE.match(x)) for x in lines]
    heads, skip = set(), set()
    for i in range(len(lines) - 1):
        if i not in skip and not titled[i] and "|" in lines[i] and _RULE.match(lines[i + 1]):
            heads.add(i)
            skip.add(i + 1)
    found, other, head, section, rows = [], [], None, "", []

    def close():
        found.extend((head, section, a, rows[a : a + per_chunk]) for a in range(0, len(rows), per_chunk))
        rows.clear()
        return len(found)

    ends = []  # chunks so far after each table that ended before the last line
    for i, line in enumerate(lines):
        if titled[i] or i in heads:
            if rows:
                ends.append((close(), titled[i]))
            if titled[i]:
                section = line.lstrip("#").strip()
            else:
                head = i
        elif i not in skip:
            if head is not None and line.strip().startswith("|"):
                rows.append(line)
            else:
                other.append(line)
    close()
    return found, ends, other


_TABLE_CHUNK = T.StructType([T.StructField("head", T.StringType()), T.StructField("section", T.StringType()), T.StructField("index", T.IntegerType()), T.StructField("first", T.IntegerType()), T.StructField("rows", T.ArrayType(T.StringType()))])


@F.pandas_udf(T.StringType())
def _table_parts(texts: pd.Series, per_chunk: pd.Series) -> pd.Series:
    """JSON of the table chunks: header and separator, section, index, first row's number and rows."""
    out = []
    for text, n in zip(texts, per_chunk, strict=True):
        lines = (text or "").strip().split("\n")
        found, ends, _ = _table_spans(lines, n)
        parts, start, ended = [], 0, dict(ends)
        for k, (head, section, first, rows) in enumerate(found):
            if k in ended:  # a title adds the chunks so far to the index, a new table sets it to them: it can jump
                start = start + k if ended[k] else k
            parts.append({"head": f"{lines[head]}\n{lines[head + 1]}", "section": section, "index": start + first // n, "first": first, "rows": rows})
        out.append(json.dumps(parts))
    return pd.Series(out)


@F.pandas_udf(T.StringType())
def _text_beside_tables(texts: pd.Series) -> pd.Series:
    def rest(text):
        lines = _table_spans((text or "").strip().split("\n"), 1)[2]
        while lines and not lines[0].strip():
            lines.pop(0)
        return "\n".join(lines).strip()

    return texts.map(rest)


def table_chunks(parts: Column) -> Column:
    """Chunks of the tables' parts: header, separator and rows, with the rows' numbers in their table."""

    def chunk(p):
        content = F.concat(p["head"], F.lit("\n"), F.array_join(p["rows"], "\n"))
        span = F.concat((p["first"] + 1).cast("string"), F.lit("-"), (p["first"] + F.size(p["rows"])).cast("string"))
        return _chunk(content, p["section"], p["index"], TABLE, row_range=span)

    return F.transform(parts, chunk)


def chunk_table(text: Column, rows_per_chunk: int = 30) -> Column:
    """Tables in chunks of ``rows_per_chunk`` rows under their header; all other lines by C2 after them, numbered from 0."""
    parts = F.from_json(_table_parts(text, F.lit(rows_per_chunk)), T.ArrayType(_TABLE_CHUNK))
    return F.concat(table_chunks(parts), chunk_by_paragraphs(_text_beside_tables(text), 1500))


def chunk_fixed(text: Column, size: int = 1000, overlap: int = 200) -> Column:
    """P10: windows of ``size`` characters, each starting ``size - overlap`` after the last, until the text's end is in one."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be below size")
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - overlap - 1, F.lit(0)), F.lit(size - overlap))
    return F.when(F.length(text) > 0, F.transform(starts, lambda a, i: _chunk(F.substr(text, a + 1, F.lit(size)), F.lit(""), i, NARRATIVE))).otherwise(F.array().cast(f"array<{CHUNK}>"))


def chunk_documents(docs: DataFrame, max_size: int = 1500, rows_per_chunk: int = 30, text: str = "markdown") -> DataFrame:
    """B2: each document by its strategy: paged if ``pdf_type`` is scanned or hybrid, else by content type.

    Returns the columns of ``docs`` without the text, then chunk_seq (dense, from 0) and the chunk's fields (C6).
    """
    t = F.col(text)
    kind = detect_content_type(t)
    paged = F.col("pdf_type").isin("scanned", "hybrid") if "pdf_type" in docs.columns else F.lit(False)
    chunks = F.when(F.coalesce(paged, F.lit(False)), chunk_by_pages(t, max_size)).when(kind == "structured", chunk_by_headers(t, max_size)).when(kind == "plain", chunk_by_paragraphs(t, max_size))
    keep = [c for c in docs.columns if c != text]
    others = docs.where(t.isNotNull())
    is_table = (kind == "tabular") & ~F.coalesce(paged, F.lit(False))
    # Tables alone need the Arrow helper, so only they go through it.
    built = others.where(~is_table).select(*keep, F.posexplode(chunks).alias("chunk_seq", "chunk"))
    tables = others.where(is_table).select(*keep, F.posexplode(chunk_table(t, rows_per_chunk)).alias("chunk_seq", "chunk"))
    return built.unionByName(tables).select(*keep, "chunk_seq", "chunk.*")


def chunk_nodes(chunks: DataFrame, id_len: int = 12, max_text: int = 2000) -> DataFrame:
    """(id, text, source, section, char_count) of each chunk; the text is cut, the count is the full length's."""
    known = lambda c: F.coalesce(F.col(c), F.lit("unknown")).alias(c)
    return chunks.withColumn("id", chunk_id(F.col("content"), id_len)).withColumn("text", F.left("content", F.lit(max_text))).withColumn("char_count", F.length("content")).withColumns({c: known(c) for c in ("source", "section")})


def chunk_id_collisions(chunks: DataFrame, id_len: int = 12) -> DataFrame:
    """(id, contents) of the ids that several different contents share: ask for longer ids where there are any."""
    hashes = chunks.select(chunk_id(F.col("content"), id_len).alias("id"), F.md5(F.col("content").cast("binary")).alias("whole")).distinct()
    return hashes.groupBy("id").agg(F.count("*").alias("contents")).where("contents > 1")
