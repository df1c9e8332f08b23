"""Text expressions with Unicode-aware trims and flags, so results don't depend on a JVM's defaults."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as white space at the ends of a text.
WS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: inside a lambda, an expression of the row is computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WS))


def header_title(col: Column) -> Column:
    """A markdown header without its marks."""
    return strip(F.ltrim(col, F.lit("#")))


def looks_like_json(col: Column) -> Column:
    """True where the text has an opening brace anywhere."""
    return F.contains(col, F.lit("{"))


def detect_content_type(col: Column) -> Column:
    """B1: ``tabular`` if more than half of the lines begin with a pipe, else ``structured`` with any header, else ``plain``."""
    lines = F.split(strip(F.coalesce(col, F.lit(""))), "\n", -1)
    pipes = F.size(F.filter(lines, lambda x: strip(x).startswith("|")))
    headed = F.exists(lines, lambda x: x.rlike(r"(?U)^#{1,6}\s"))
    return F.when(pipes * 2 > F.size(lines), "tabular").when(headed, "structured").otherwise("plain")


def chunk_id(content: Column, length: int = 12) -> Column:
    """The first hex digits of the content's MD5; ask for 32 where 48 bits could collide."""
    return F.substring(F.md5(content.cast("binary")), 1, length)


def normalized_name(col: Column) -> Column:
    """Lower case, single blanks, no blanks at the ends."""
    return F.regexp_replace(strip(F.lower(col)), r"(?U)\s+", " ")
