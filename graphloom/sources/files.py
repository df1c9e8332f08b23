"""Files of a directory to text documents, with a status for each file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.text import let
from graphloom.sources.markup import html_to_markdown

# The accepted extensions, the signatures, and what marks each office format inside a zip file.
TEXT_EXTENSIONS = (".txt", ".md", ".markdown", ".html", ".htm", ".csv")
SIGNATURES = (
    ("25504446", ".pdf"), ("89504E47", "image/png"), ("FFD8FF", "image/jpeg"), ("47494638", "image/gif"), ("424D", "image/bmp"), ("49492A00", "image/tiff"), ("4D4D002A", "image/tiff"), ("00000100", "image/x-icon"),
    ("38425053", "image/vnd.adobe.photoshop"), ("52494646", "application/riff"), ("1A45DFA3", "video/x-matroska"), ("464C56", "video/x-flv"), ("000001BA", "video/mpeg"), ("000001B3", "video/mpeg"), ("494433", "audio/mpeg"), ("FFFB", "audio/mpeg"),
    ("4F676753", "audio/ogg"), ("664C6143", "audio/x-flac"), ("4D546864", "audio/midi"), ("2321414D52", "audio/amr"), ("D0CF11E0", "application/x-ole-storage"), ("1F8B", "application/gzip"), ("425A68", "application/x-bzip2"),
    ("377ABCAF271C", "application/x-7z-compressed"), ("FD377A585A00", "application/x-xz"), ("52617221", "application/x-rar-compressed"), ("28B52FFD", "application/zstd"), ("4D534346", "application/vnd.ms-cab-compressed"),
    ("7B5C727466", "application/rtf"), ("2521", "application/postscript"), ("4D5A", "application/x-msdownload"), ("7F454C46", "application/x-executable"), ("0061736D", "application/wasm"), ("53514C69", "application/x-sqlite3"),
)
ZIP_SIGNATURE, ZIP_PARTS = "504B0304", (("word/", ".docx"), ("ppt/", ".pptx"), ("xl/", ".xlsx"))
#: Signatures away from the first byte: (bytes before it, signature).
INNER_SIGNATURES = ((4, "66747970"), (257, "7573746172"))  # media containers (ftyp) and tar archives (ustar)


def read_files(spark: SparkSession, directory: str) -> DataFrame:
    """A1: path, modificationTime, length and content of the files directly in ``directory``; a missing one is an error."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(directory)


def _zip_directory(content: Column) -> Column:
    """The central directory of a zip file as text (a character for each byte), found by the record at the file's end; of a file
    without that record, all of it."""
    tail = F.decode(F.substr(content, F.greatest(F.octet_length(content) - 65_556, F.lit(1))), "ISO-8859-1")  # the record and the longest comment

    def listed(record):
        number = lambda k: sum((F.ascii(F.substr(record, F.lit(k + 1 + i), F.lit(1))).cast("long") * 256**i for i in range(4)), F.lit(0))
        return F.when(F.length(record) >= 18, F.decode(F.substr(content, (number(12) + 1).cast("int"), number(8).cast("int")), "ISO-8859-1"))

    parts = F.split(tail, "PK\x05\x06", -1)
    return F.coalesce(let(parts, lambda p: F.when(F.size(p) > 1, let(F.element_at(p, -1), listed))), F.decode(content, "ISO-8859-1"))


def detect_file_type(content: Column, path: Column) -> Column:
    """A2: the type by signature, else by the lower-cased last extension; null where the file is rejected.

    A zip file is an office file if its directory, wherever it stands, lists such a part; of a cut-off zip file, if a header of any
    entry names it.
    """
    head = F.hex(F.substring(content, 1, 8))
    extension = F.lower(F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"(\.[^.]+)$", 1))
    is_zip = head.startswith(ZIP_SIGNATURE)
    entry = r"(?s)(?:PK\x01\x02.{42}|PK\x03\x04.{26})"
    office = let(_zip_directory(F.when(is_zip, content)), lambda inside: F.coalesce(*[F.when(inside.rlike(entry + part), F.lit(kind)) for part, kind in ZIP_PARTS]))
    found = F.when(is_zip, office)
    for start, kind in SIGNATURES:
        found = found.when(head.startswith(start), F.lit(kind if kind.startswith(".") else None).cast("string"))
    for before, signature in INNER_SIGNATURES:
        found = found.when(F.hex(F.substring(content, before + 1, len(signature) // 2)) == signature, F.lit(None).cast("string"))
    return found.when(extension.isin(*TEXT_EXTENSIONS), extension)


def decode_text(content: Column) -> Column:
    """A3: UTF-8 text with line ends as newlines; null where the bytes are not UTF-8."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), F.regexp_replace(text, "\\r\\n?", "\n"))


def parse_documents(files: DataFrame) -> DataFrame:
    """One row a file: source, file_path, file_type, size_bytes, markdown, status and reason.

    ``status`` is parsed, rejected (unsupported type) or error (a text that is not UTF-8). Binary formats are detected and
    carried as ``parsed`` with a null text, for a decoder of the user's choice. No file stops the run.
    """
    kind = detect_file_type(F.col("content"), F.col("path"))
    rows = files.select(
        F.element_at(F.split("path", "/"), -1).alias("source"), F.col("path").alias("file_path"), kind.alias("file_type"), F.octet_length("content").cast("long").alias("size_bytes"), decode_text(F.col("content")).alias("text")
    )
    is_text = F.col("file_type").isin(*TEXT_EXTENSIONS)
    is_html = F.col("file_type").isin(".html", ".htm")
    markdown = F.when(is_html, html_to_markdown(F.when(is_html, F.col("text")))).when(is_text, F.col("text"))
    status = F.when(F.col("file_type").isNull(), "rejected").when(is_text & F.col("text").isNull(), "error").otherwise("parsed")
    reason = F.when(F.col("file_type").isNull(), "unsupported format").when(is_text & F.col("text").isNull(), "not valid UTF-8")
    return rows.select("source", "file_path", "file_type", "size_bytes", markdown.alias("markdown"), status.alias("status"), reason.alias("reason"))


def document_metadata(docs: DataFrame, pages: DataFrame | None = None, sheets: DataFrame | None = None) -> DataFrame:
    """``docs`` with page facts (from ``classify_pdf_pages``) and sheet counts, joined by doc_id. Empty sheets count as sheets;
    rows are data rows. ``sheets``: doc_id, sheet, rows."""
    out = docs
    if pages is not None:
        facts = pages.select("doc_id", "pdf_type", F.col("needs_ocr").alias("ocr_applied"), "total_pages", "avg_chars_per_page")
        out = out.join(facts, "doc_id", "left")
    if sheets is not None:
        counts = sheets.groupBy("doc_id").agg(F.count("*").alias("num_sheets"), F.sum(F.greatest(F.col("rows") - 1, F.lit(0))).alias("num_rows"))
        out = out.join(counts, "doc_id", "left")
    return out
