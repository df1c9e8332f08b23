"""Byte-level BPE encoding and decoding of whole texts by a file of ranks, with long texts cut into overlapping chunks.

``pattern`` divides a text into pre-tokens, each of which is merged by the ranks on its own. A text of more than ``CHUNK``
characters is cut at fixed places into chunks that reach ``OVERLAP`` characters into the next one:

1. chunks are pre-tokenised in parallel, each from its first character, where a pre-token may well be cut;
2. a text's chunks are stitched in order: from the first place in the overlap at which both have a boundary, the later chunk's
   boundaries are the text's, as what follows a boundary doesn't depend on what stands before it. Where there is none (a
   word longer than the overlap), the earlier chunk is carried on into the later one until there is;
3. the pieces between these places are encoded in parallel.

The ids are those of the whole text, whatever its length. Decoding concatenates the tokens' bytes. Copies of a long
text are chunked and encoded once. A task holds one chunk of text, or one pre-token that is longer.

``pattern`` must not look behind a match, nor further than ``AHEAD`` characters beyond it. Special tokens are ordinary text. A null
text is empty and has no tokens. Repeated rows give repeated results; further columns make no difference; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.shared import text_batches
from graphloom.llm.words import texts_of

#: Characters of a chunk, of what it shares with the next one, and beyond a pre-token that can decide where it ends.
CHUNK, OVERLAP, AHEAD = 1 << 15, 256, 8
#: Pre-tokens whose ids a worker remembers (twice as many at most), and their length.
REMEMBERED, SHORT = 1 << 18, 64


class Codec(dict):
    """Ranks and pattern: pre-tokens, their ids (remembered, as keys of this table), and bytes of ids."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.spelling = [str(i) for i in range(len(self.bytes_of))]
        self.older: dict[str, tuple[int, ...]] = {}
        self.pattern = regex.compile(pattern)
        self.merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def __missing__(self, token: str) -> tuple[int, ...]:
        ids = self.older.get(token) or tuple(self.merge(token))
        if len(token) <= SHORT:
            if len(self) >= REMEMBERED:  # what is asked for again comes back from the older half
                self.older = dict(self)
                self.clear()
            self[token] = ids
        return ids

    def ids(self, tokens: list[str]) -> list[int]:
        return list(itertools.chain.from_iterable(map(self.__getitem__, tokens)))

    def decoded(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def spelled(self, ids: list[int]) -> bytes:
        """The ids in decimal, joined by single blanks."""
        return " ".join(map(self.spelling.__getitem__, ids)).encode()

    def boundaries(self, text: str, ended: bool) -> np.ndarray:
        """Where pre-tokens begin, up to the last place that no further text could change; with the text's end if it has ``ended``."""
        ends = [0, *(m.end() for m in self.pattern.finditer(text))]
        return np.array([x for x in ends if ended or x <= len(text) - AHEAD], np.int64)


@functools.cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


# --- long texts --------------------------------------------------------------------------------------------------


def chunks(text: str) -> Iterator[tuple[str, bool]]:
    """The chunks in order, and whether it is the last."""
    for begin in range(0, max(len(text), 1), CHUNK):
        ended = begin + CHUNK >= len(text)
        yield text[begin : begin + CHUNK + (0 if ended else OVERLAP)], ended


class Stitcher:
    """Takes a text's chunks with their own boundaries, and gives back pieces with boundaries of the whole text."""

    def __init__(self, vocabulary: Codec):
        self.codec, self.parts, self.held, self.begin, self.known = vocabulary, [], 0, 0, np.zeros(1, np.int64)
        self.chunk = -1

    def push(self, text: str, own: np.ndarray, ended: bool) -> Iterator[tuple[str, np.ndarray]]:
        """(text, boundaries from 0 to its length) of each finished piece. What is held begins at ``begin`` in the whole text, and
        ``known`` are its boundaries, from ``begin`` on."""
        self.chunk += 1
        base, own = self.chunk * CHUNK, own + self.chunk * CHUNK
        if self.chunk:
            shared = np.intersect1d(self.known, own)
            shared = shared[shared >= base]
            if shared.size:
                yield from self._cut(int(shared[0]))
                self.parts, self.held = [], 0
                text, own = text[int(shared[0]) - base :], own[own >= shared[0]]
            else:
                text = text[self.begin + self.held - base :]  # the overlap is held already
                if own.size > 1 or ended:  # else the chunk lies within one pre-token, which goes on
                    yield from self._cut(int(self.known[-1]))
                    text, self.parts = "".join([*self.parts, text]), []
                    own = self.codec.boundaries(text, ended) + self.begin
                    self.held = 0
                else:
                    own = self.known
        self.known = own
        self.parts.append(text)
        self.held += len(text)
        if ended:
            yield from self._cut(self.begin + self.held)

    def _cut(self, at: int) -> Iterator[tuple[str, np.ndarray]]:
        """The piece from ``begin`` to ``at``; what is held goes on from there."""
        text = "".join(self.parts)
        known = self.known[self.known <= at]
        if at > self.begin:
            yield text[: at - self.begin], known - self.begin
        self.parts = [text[at - self.begin :]]
        self.held, self.begin = len(self.parts[0]), at


def _chunked(longs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(key, no, text, own, ended) of every chunk of texts (key, text), pre-tokenised on its own."""

    def cut(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = list(chunks(text))
                for a in range(0, len(rows), 64):
                    some = rows[a : a + 64]
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(some)), pa.array(range(a, a + len(some)), pa.int64()), pa.array([x for x, _ in some]), pa.array([x for _, x in some])], ["key", "no", "text", "ended"])

    def pre_tokenise(batches):
        for batch in batches:
            own = [codec(path, pattern).boundaries(t, e).astype(np.int32) for t, e in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.list_(pa.int32()))], ["key", "no", "text", "ended", "own"])

    rows = longs.mapInArrow(cut, "key string, no long, text string, ended boolean")
    return rows.repartition("key", "no").mapInArrow(pre_tokenise, "key string, no long, text string, ended boolean, own array<int>")


def _pieces(longs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(key, piece, ids) of texts (key, text)."""

    def stitch(batches):
        last, stitcher, no = None, None, 0
        for batch in batches:
            out = []
            for key, text, ended, own in zip(*[batch.column(i).to_pylist() for i in (0, 2, 3, 4)], strict=True):
                if key != last:
                    last, stitcher, no = key, Stitcher(codec(path, pattern)), 0
                for piece, known in stitcher.push(text, np.array(own, np.int64), ended):
                    out.append((key, no, piece, known.astype(np.int32)))
                    no += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out]), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out]), pa.array([x[3] for x in out], pa.list_(pa.int32()))], ["key", "piece", "text", "known"])

    def encode_pieces(batches):
        table = codec(path, pattern)
        for batch in batches:
            ids = [table.ids([t[a:b] for a, b in itertools.pairwise(k)]) for t, k in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _listed(ids)], ["key", "piece", "ids"])

    whole = _chunked(longs, path, pattern).repartition("key").sortWithinPartitions("key", "no")
    pieces = whole.mapInArrow(stitch, "key string, piece long, text string, known array<int>")
    return pieces.repartition("key", "piece").mapInArrow(encode_pieces, "key string, piece long, ids array<int>")


def _listed(rows: list[list[int]]) -> pa.ListArray:
    flat = np.fromiter(itertools.chain.from_iterable(rows), np.int32, sum(map(len, rows)))
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), pa.array(flat))


# --- encoding and decoding ---------------------------------------------------------------------------------------


def _parts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, text) of the short texts, (id, key) of the long ones, and (key, text) of these without copies."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    is_long = F.length("text") > CHUNK
    longs = rows.where(is_long).select("id", F.sha2("text", 256).alias("key"), "text")
    return rows.where(~is_long), longs.select("id", "key"), longs.select("key", "text").dropDuplicates(["key"])


def _encoded(batches, table: Codec) -> Iterator[tuple[pa.Array, list[list[int]]]]:
    for batch in batches:
        yield batch.column(0), [table.ids(table.pattern.findall(x)) for x in texts_of(batch.column(1)).to_pylist()]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, ids): the token ids of every row's text, in pieces numbered from 0; a text up to ``CHUNK`` characters is one piece."""
    shorts, ids, longs = _parts(docs, id_col, text_col)

    def run(batches):
        for key, rows in _encoded(batches, codec(path, pattern)):
            yield pa.RecordBatch.from_arrays([key, pa.array(np.zeros(len(key), np.int64)), _listed(rows)], ["id", "piece", "ids"])

    found = shorts.mapInArrow(run, "id long, piece long, ids array<int>")
    return found.unionByName(ids.join(_pieces(longs, path, pattern), "key").select("id", "piece", "ids")).withColumnRenamed("id", id_col)


def decode(pieces: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, piece, bytes) of what ``encode`` gave. A piece's bytes are UTF-8, as pre-tokens are whole characters."""

    def run(batches):
        table = codec(path, pattern)
        for b in batches:
            texts = pa.array([table.decoded(row) for row in b.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), texts], ["id", "piece", "bytes"])

    return pieces.select(F.col(id_col).alias("id"), "piece", "ids").mapInArrow(run, "id long, piece long, bytes binary").withColumnRenamed("id", id_col)


_DIGESTS = ("n_tokens", "ids_sha256", "decoded_sha256")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: what ``encode`` and then ``decode`` give, without keeping it. A long
    text's pieces pass its hashes in order, one at a time."""
    shorts, ids, longs = _parts(docs, id_col, text_col)
    digest = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches):
        table = codec(path, pattern)
        for key, rows in _encoded(batches, table):
            columns = [pa.array([len(x) for x in rows], pa.int64()), pa.array([digest(table.spelled(x)) for x in rows], pa.string()), pa.array([digest(table.decoded(x)) for x in rows], pa.string())]
            yield pa.RecordBatch.from_arrays([key, *columns], ["id", *_DIGESTS])

    def fold(batches):
        table, state = codec(path, pattern), None
        for b in batches:
            out = []
            for key, row in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if state is None or key != state[0]:
                    if state:
                        out.append(state)
                    state = [key, 0, hashlib.sha256(), hashlib.sha256()]
                state[2].update((b" " if state[1] and row else b"") + table.spelled(row))
                state[3].update(table.decoded(row))
                state[1] += len(row)
            yield told(out)
        if state:
            yield told([state])

    def told(out):
        columns = [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64()), *[pa.array([x[k].hexdigest() for x in out], pa.string()) for k in (2, 3)]]
        return pa.RecordBatch.from_arrays(columns, ["key", *_DIGESTS])

    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    of_longs = _pieces(longs, path, pattern).repartition("key").sortWithinPartitions("key", "piece").mapInArrow(fold, f"key string, {columns}")
    found = shorts.mapInArrow(run, f"id long, {columns}")
    return found.unionByName(ids.join(of_longs, "key").select("id", *_DIGESTS)).withColumnRenamed("id", id_col)
