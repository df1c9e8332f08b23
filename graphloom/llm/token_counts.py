"""Token counts of whole texts: Arrow batches of equal bytes in, lengths out.

Long texts are cut where no token can cross, at single blanks between ASCII letters or digits, so the counts stay those of
the whole text. A text without such a blank, or for a library that doesn't allow the cut, is encoded as a whole. A null or empty text has no tokens. Repeated rows and further columns make no difference; an empty table
gives an empty table.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.shared import byte_runs, text_batches
from graphloom.llm.words import texts_of

#: Bytes of text given to the library at once, and the size from which a text is cut.
BATCH_BYTES, PIECE_CHARS = 1 << 20, 1 << 17
#: A single blank between two ASCII letters or digits.
_CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def cut_text(text: str, most: int, keep_blank: bool) -> list[str]:
    """``text`` in pieces of about ``most`` characters, cut at safe blanks only; the blank stays with the right piece or goes."""
    if len(text) <= most:
        return [text]
    pieces, begin = [], 0
    while len(text) - begin > most and (cut := _CUT.search(text, begin + most)):
        pieces.append(text[begin : cut.start()])
        begin = cut.start() if keep_blank else cut.end()
    return [*pieces, text[begin:]]


class _Pieces:
    """sentencepiece: a piece begins with the blank mark or holds none, so a word begins its own pieces; a cut's blank is
    the mark that the library puts before every text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        inner = any("▁" in self.model.id_to_piece(i).lstrip("▁") for i in range(self.model.get_piece_size()))
        self.cuts = not inner and self.model.encode("a b", out_type=str) == [*self.model.encode("a", out_type=str), *self.model.encode("b", out_type=str)]
        self.keep_blank = False

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]


class _Json:
    """tokenizers: byte-level files with the usual pattern begin a word at its blank; others take whole texts."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.cuts = self.keep_blank = type(self.model.pre_tokenizer).__name__ == "ByteLevel" and self.model.normalizer is None

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]


@functools.cache
def _library(path: str):
    return _Pieces(path) if path.endswith(".model") else _Json(path)


def count_texts(path: str, texts: list[str]) -> list[int]:
    """Token counts of ``texts``, in order."""
    library = _library(path)
    pieces, owner = [], []
    for i, text in enumerate(texts):
        cut = cut_text(text, PIECE_CHARS, library.keep_blank) if library.cuts else [text]
        pieces += cut
        owner += [i] * len(cut)
    counts = [0] * len(texts)
    for a, b in byte_runs([len(x.encode()) for x in pieces], BATCH_BYTES):
        for i, n in zip(owner[a:b], library.count(pieces[a:b]), strict=True):
            counts[i] += n
    return counts


def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; ``path`` is a tokenizers ``.json`` or sentencepiece ``.model``."""
    text_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column(1)).to_pylist()
            counts = pa.array(count_texts(path, texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), counts], ["id", "n_bytes", "n_tokens"])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"))
    return narrow.mapInArrow(run, "id long, n_bytes long, n_tokens long").select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
