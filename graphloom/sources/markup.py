"""HTML, sheets and pages of text to markdown."""

from __future__ import annotations

import re
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from graphloom.functions.text import strip
from graphloom.sources.shared import shared_path

#: ASCII white space, as HTML counts it between tags.
_BLANKS = " \t\n\x0b\x0c\r"
_BLOCKS = {"p", "table", "div", "section", "article"}
_ENTITY = re.compile(r"&(?:#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6})|([A-Za-z][A-Za-z0-9]*));")


def _character(m: re.Match) -> str:
    """A reference's character; one that is unknown or beyond Unicode stays as it is, a no-break space is a blank."""
    number, name = m.groups()
    if name:
        return html5.get(f"{name};", m[0]).replace("\xa0", " ")
    code = int(number[1:], 16) if number[0] in "xX" else int(number)
    return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else m[0]


class _Page:
    """Markdown of one page, from its tags in order. Open lists and tables are stacks, so unclosed tags do no harm."""

    def __init__(self):
        self.parts: list[str] = []
        self.lists = 0
        self.tables: list[list[int]] = []  # of each open table: rows that began, cells of the row
        self.gap = self.loose = False  # white space that comes next goes; the last part is text

    def text(self, text: str) -> None:
        if self.gap:
            text = text.lstrip(_BLANKS)
        if text:
            self.gap, self.loose = False, True
            self.parts.append(_ENTITY.sub(_character, text))

    def mark(self, mark: str, tight: bool = False) -> None:
        """``mark``; a tight one takes the white space around it."""
        if tight and self.loose:
            self.parts[-1] = self.parts[-1].rstrip(_BLANKS)
        self.parts.append(mark)
        self.gap, self.loose = tight, False

    def end_row(self) -> None:
        if self.tables and self.tables[-1][0] == 1 and self.tables[-1][1]:
            self.mark("\n| " + "--- | " * self.tables[-1][1])
            self.tables[-1][0] = 2
        if self.tables:
            self.tables[-1][1] = 0

    def tag(self, name: str, closes: bool) -> None:
        if name in ("ul", "ol"):
            if not closes and not self.lists:
                self.mark("\n\n")
            self.lists = max(0, self.lists + (-1 if closes else 1))
        elif name == "li" and not closes:
            self.mark("\n" + "  " * (self.lists - 1) + "- ")
        elif name in ("td", "th"):
            if closes:
                self.mark(" | ", tight=True)
            elif self.tables:
                self.tables[-1][1] += 1
        elif name == "tr":
            if closes:
                self.end_row()
            else:
                if self.tables and self.tables[-1][1]:
                    self.end_row()
                self.mark("\n| ", tight=True)
                if self.tables:
                    self.tables[-1][0] += 1
        elif name in ("thead", "tbody", "tfoot"):
            self.mark("", tight=True)
        elif name == "br":
            self.mark("\n")
        elif len(name) == 2 and name[0] == "h" and name[1] in "123456":
            self.mark("\n\n" if closes else "\n\n" + "#" * int(name[1]) + " ")
        elif name in _BLOCKS:
            if name == "table":
                if not closes:
                    self.tables.append([0, 0])
                elif self.tables:
                    self.end_row()
                    self.tables.pop()
            if not closes:
                self.mark("\n\n")

    def markdown(self) -> str:
        lines = "".join(self.parts).split("\n")
        return re.sub(r"\n{3,}", "\n\n", "\n".join([*[x.rstrip(" \t") for x in lines[:-1]], lines[-1]])).strip(" \t\r\n")


_NAME = re.compile(r"/?([A-Za-z][A-Za-z0-9]*)")


def page_to_markdown(html: str) -> str:
    """One pass over the tags of a page; each place of the text is looked at a bounded number of times."""
    page, at, low = _Page(), 0, None
    ends: dict[str, int] = {}  # where the next end of a comment, script, style or tag is looked for at most once

    def after(what: str, source: str, begin: int) -> int:
        if ends.get(what, 0) >= 0 and ends.get(what, 0) < begin + 1:
            ends[what] = source.find(what, begin)
        return ends[what]

    while (tag := html.find("<", at)) >= 0:
        page.text(html[at:tag])
        if html.startswith("<!--", tag) and (end := after("-->", html, tag + 4)) >= 0:
            at = end + 3
            continue
        close = after(">", html, tag + 1)
        if close < 0:
            at = tag
            break
        found = _NAME.match(html, tag + 1, close)
        name = found[1].lower() if found else ""
        if name in ("script", "style") and html[tag + 1] != "/":
            low = low if low is not None else html.lower() if len(html.lower()) == len(html) else html
            if (end := after(f"</{name}>", low, close)) >= 0:
                at = end + len(name) + 3
                continue
        if close == tag + 1:  # no tag
            page.text("<>")
        elif name:
            page.tag(name, html[tag + 1] == "/")
        at = close + 1
    page.text(html[at:])
    return page.markdown()


@F.pandas_udf(StringType())
def _markdown(pages: pd.Series) -> pd.Series:
    return pages.map(page_to_markdown, na_action="ignore")


def html_to_markdown(html: Column) -> Column:
    """A4: headings, lists (with their depth), tables (with a rule under the first row) and paragraphs kept; scripts, styles,
    comments and tags dropped; all named and numeric character references decoded. Unclosed tags end where their list, table or
    page does. Not byte-equal to any other converter."""
    return _markdown(html)


def _sheet_lines(cells: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, sheet_no, sheet, row_no, line, rule, first) of every row of sheets that have a header."""
    sheet = (*keys, "sheet_no", "sheet")
    width = cells.groupBy(*sheet).agg(F.size(F.min_by("values", "row_no")).alias("width"), F.min("row_no").alias("first"))
    padded = F.transform(F.sequence(F.lit(1), F.col("width")), lambda i: F.coalesce(F.try_element_at("values", i), F.lit("")))
    line = F.concat(F.lit("| "), F.array_join(padded, " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.col("width")), " | "), F.lit(" |"))
    return cells.join(width.where("width > 0"), list(sheet)).select(*sheet, "row_no", line.alias("line"), rule.alias("rule"), (F.col("row_no") == F.col("first")).alias("first"))


def rows_to_markdown(cells: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A5: (keys..., markdown) from cells(keys..., sheet_no, sheet, row_no, values): a titled pipe table for each sheet.

    The first row is the header; shorter rows are padded and longer ones cut to its width; null cells are empty. A document
    is one text in one row: for sheets that are to be chunked, ``sheet_chunks`` never makes it.
    """
    sheet = (*keys, "sheet_no", "sheet")
    lines = _sheet_lines(cells, keys).select(*sheet, "row_no", F.when(F.col("first"), F.concat("line", F.lit("\n"), "rule")).otherwise(F.col("line")).alias("line"))
    tables = lines.groupBy(*sheet).agg(F.array_sort(F.collect_list(F.struct("row_no", "line"))).alias("rows"))
    body = F.concat(F.lit("## "), F.col("sheet"), F.lit("\n\n"), F.array_join("rows.line", "\n"), F.lit("\n"))
    parts = tables.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("sheet_no"), body.alias("body")))).alias("sheets"))
    return parts.select(*keys, F.array_join("sheets.body", "\n").alias("markdown"))


def sheet_chunks(cells: DataFrame, keys: tuple[str, ...] = ("doc_id",), rows_per_chunk: int = 30) -> DataFrame:
    """A5 and C3 in one: the chunks that C3 makes of A5's text, of sheets of any size: (keys..., chunk_seq and C6's columns).

    Rows are dealt by ranges of (keys, sheet, row) and written in that order; a row's number in its sheet is its place in its range
    and the rows of the sheet in the ranges before it. Then chunks of ``rows_per_chunk`` rows are grouped, so no text, task or
    group is larger for a larger sheet. ``row_no`` tells a sheet's rows apart; cells hold no line ends, and rows and titles no
    markup of their own (a row of empty cells, which a scan of the text would take for a header's rule, is a row here).
    """
    sheet = (*keys, "sheet_no", "sheet")
    spark = cells.sparkSession
    rows = _sheet_lines(cells, keys).repartitionByRange(*sheet, "row_no").sortWithinPartitions(*sheet, "row_no")
    path = shared_path(spark)
    rows.withColumn("place", F.monotonically_increasing_id()).withColumn("range", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    data = rows.where("not first")
    # As many rows as ranges and sheets; a sheet of many ranges has one for each.
    held = data.groupBy(*sheet, "range").agg(F.min("place").alias("begin"), F.max("place").alias("end"), F.count("*").alias("n"))
    before = Window.partitionBy(*sheet).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("total", F.sum("n").over(Window.partitionBy(*sheet)))
    # The index jumps as C3's does: each sheet's begins at the chunks before it, added up over the sheets.
    totals = held.select(*sheet, "total").distinct().withColumn("chunks", F.ceil(F.col("total") / rows_per_chunk))
    earlier = Window.partitionBy(*keys).orderBy("sheet_no", "sheet").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("seq", F.coalesce(F.sum("chunks").over(earlier), F.lit(0)))
    totals = totals.withColumn("start", F.sum("seq").over(Window.partitionBy(*keys).orderBy("sheet_no", "sheet")))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in sheet]
    number = F.col("b.before") + F.col("a.place") - F.col("b.begin")
    numbered = data.alias("a").join(held.alias("b"), [*same, F.col("a.range") == F.col("b.range")]).select("a.*", number.alias("number"))
    lines = F.array_sort(F.collect_list(F.struct("number", "line")))
    chunks = numbered.groupBy(*sheet, F.floor(F.col("number") / rows_per_chunk).alias("chunk")).agg(lines.alias("rows"))
    heads = rows.where("first").select(*sheet, F.concat("line", F.lit("\n"), "rule").alias("head"))
    both = [F.col(f"c.{c}").eqNullSafe(F.col(f"t.{c}")) for c in sheet]
    both_heads = [F.col(f"c.{c}").eqNullSafe(F.col(f"h.{c}")) for c in sheet]
    content = F.concat("head", F.lit("\n"), F.array_join("rows.line", "\n"))
    span = F.concat((F.col("rows")[0]["number"] + 1).cast("string"), F.lit("-"), (F.element_at("rows", -1)["number"] + 1).cast("string"))
    joined = chunks.alias("c").join(totals.alias("t"), both).join(heads.alias("h"), both_heads)
    return joined.select(
        *[f"c.{k}" for k in keys], (F.col("seq") + F.col("chunk")).cast("int").alias("chunk_seq"), content.alias("content"), strip(F.col("c.sheet")).alias("section"), (F.col("start") + F.col("chunk")).cast("int").alias("chunk_index"),
        F.lit("table").alias("content_type"), F.length(content).cast("int").alias("char_count"), span.alias("row_range"), F.lit(None).cast("string").alias("page_range"), F.lit(None).cast("boolean").alias("merged"),
    )


def classify_pdf_pages(pages: DataFrame, documents: DataFrame | None = None, first: int = 3, least: int = 50) -> DataFrame:
    """Whether a document needs OCR, from pages(doc_id, page_no, text). With ``documents``, those without pages are digital."""
    n = F.length(strip(F.coalesce("text", F.lit(""))))
    look = F.col("page_no") <= first
    facts = pages.groupBy("doc_id").agg(F.count("*").alias("total_pages"), F.sum(look.cast("long")).alias("pages_checked"), F.sum(F.when(look & (n >= least), 1).otherwise(0)).alias("with_text"), F.sum(F.when(look, n).otherwise(0)).alias("chars"))
    if documents is not None:
        facts = documents.select("doc_id").join(facts, "doc_id", "left").fillna(0)
    without = F.col("pages_checked") - F.col("with_text")
    kind = F.when(without == 0, "digital").when(F.col("with_text") == 0, "scanned").otherwise("hybrid")
    average = F.when(F.col("pages_checked") > 0, F.col("chars") / F.col("pages_checked")).otherwise(0.0)
    return facts.select("doc_id", kind.alias("pdf_type"), (kind != "digital").alias("needs_ocr"), "pages_checked", "total_pages", average.alias("avg_chars_per_page"))
