"""Token ids in files of independent zstandard frames with a trailing seek table and a checksum for every frame.

A file is a zstandard stream that any reader decompresses as a whole: data frames, then two skippable frames. Each data
frame holds whole documents: their number n, n ids (int64), n token counts and the token ids (uint32, little-endian). The
first skippable frame is the directory: the first document id of each data frame. The last is the public seekable format's
seek table: compressed size, decompressed size and checksum (lower half of XXH64 of the decompressed bytes) of each data
frame, then their number, the descriptor and the magic number. So a reader finds a document by two small reads from the
end, and decompresses one frame.

Files are in document order: the rows are range-partitioned by id, and each partition writes one file. Null or empty texts
hold the end id alone; rows with a null id come first; repeated rows are documents each. In a file a null id is the least 64-bit number,
so that number itself comes back as null. A long text is a document of one frame, whatever its length. An empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.shared import byte_runs, make_dirs, open_file, put_file, shared_dir, text_batches
from graphloom.llm.words import STEP_BYTES, mix, placed, raw_bytes, texts_of

FRAME_TOKENS = 1 << 16
LEVEL = 3
_SKIP, _TABLE, _DIRECTORY = 0x8F92EAB1, 0x184D2A5E, 0x184D2A50
_NULL_ID = -(1 << 63)


# --- the file format ---------------------------------------------------------------------------------------------


def pack_file(documents: Iterator[tuple[int, np.ndarray]], frame_tokens: int = FRAME_TOKENS) -> Iterator[bytes]:
    """The bytes of one file for (id, token ids) in ascending order of id."""
    press = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
    entries, firsts, ids, tokens, held = [], [], [], [], 0

    def frame() -> bytes:
        counts = np.array([x.size for x in tokens], "<u4")
        body = struct.pack("<I", len(ids)) + np.array(ids, "<i8").tobytes() + counts.tobytes() + b"".join(x.astype("<u4", copy=False).tobytes() for x in tokens)
        out = press.compress(body)
        entries.append((len(out), len(body), xxhash.xxh64_intdigest(body) & 0xFFFFFFFF))
        firsts.append(ids[0])
        return out

    for key, row in documents:
        ids.append(key)
        tokens.append(row)
        held += row.size
        if held >= frame_tokens:
            yield frame()
            ids, tokens, held = [], [], 0
    if ids:
        yield frame()
    directory = np.array(firsts, "<i8").tobytes()
    yield struct.pack("<II", _DIRECTORY, len(directory)) + directory
    table = b"".join(struct.pack("<III", *e) for e in entries) + struct.pack("<IBI", len(entries), 0x80, _SKIP)
    yield struct.pack("<II", _TABLE, len(table)) + table


class TokenFile:
    """Reads documents of one file, and decompresses only the frames that hold them."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - 9)
        n, descriptor, magic = struct.unpack("<IBI", source.read(9))
        if magic != _SKIP or not descriptor & 0x80:
            raise ValueError("no seek table")
        source.seek(size - 9 - 12 * n)
        self.entries = np.frombuffer(source.read(12 * n), "<u4").reshape(n, 3)
        source.seek(size - 9 - 12 * n - 8 - 8 * n)
        self.firsts = np.frombuffer(source.read(8 * n), "<i8")
        self.starts = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])

    def frame(self, k: int) -> Iterator[tuple[int, np.ndarray]]:
        """(id, token ids) of every document in data frame ``k``; a wrong checksum is an error."""
        size, full, checksum = self.entries[k].tolist()
        self.source.seek(int(self.starts[k]))
        body = zstandard.ZstdDecompressor().decompress(self.source.read(size), max_output_size=full)
        if len(body) != full or xxhash.xxh64_intdigest(body) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        (n,) = struct.unpack_from("<I", body)
        ids, counts = np.frombuffer(body, "<i8", n, 4), np.frombuffer(body, "<u4", n, 4 + 8 * n)
        tokens = np.frombuffer(body, "<u4", offset=4 + 12 * n)
        end = np.cumsum(counts, dtype=np.int64)
        for key, b, c in zip(ids.tolist(), end.tolist(), counts.tolist(), strict=True):
            yield key, tokens[b - c : b]

    def __iter__(self):
        for k in range(len(self.entries)):
            yield from self.frame(k)

    def find(self, key: int) -> list[np.ndarray]:
        """Token ids of every document with this id."""
        first = max(int(np.searchsorted(self.firsts, key, "left")) - 1, 0)
        last = int(np.searchsorted(self.firsts, key, "right"))
        return [row for k in range(first, last) for other, row in self.frame(k) if other == key]


# --- encoding ----------------------------------------------------------------------------------------------------

#: Segments whose ids a worker remembers over its tasks (about 50 bytes each), and new ones that are encoded as one text.
REMEMBERED, JOINED = 1 << 20, 1024
# Bytes after which a blank's successor surely is no white space: printable ASCII and leading bytes of letters and signs.
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = _SOLID[0xC3:0xE1] = _SOLID[0xE4:0xF5] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def segments(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First bytes of the segments of rows of text, 64-bit hashes, 32 further hash bits, and each row's bounds among them.

    A segment begins with its row, or with a blank that stands before a byte that is surely no white space.
    """
    n = data.size
    first = np.zeros(n, bool)
    first[:-1] = (data[:-1] == 32) & _SOLID[data[1:]]
    first[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = False  # a row's last byte begins nothing
    first[bounds[:-1][bounds[1:] > bounds[:-1]]] = True
    starts = np.flatnonzero(first)
    if not starts.size:
        return starts, np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(bounds.size, np.int64)
    lengths = np.diff(np.append(starts, n))
    value = placed(_BYTE[data], starts, lengths)
    key = mix(np.add.reduceat(value, starts) + lengths.astype(np.uint64))
    value ^= value >> np.uint64(31)
    check = (mix(np.add.reduceat(value, starts)) >> np.uint64(32)).astype(np.uint32)
    return starts, key, check, np.searchsorted(starts, bounds)


class Memory:
    """Ids of segments by 96 bits of hash in sorted arrays: a small share of what a dictionary of strings takes."""

    def __init__(self):
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.at, self.n, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.clock = np.zeros(0, "<u4"), 0

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Places of the segments, or -1."""
        if not self.keys.size:
            return np.full(keys.size, -1)
        place = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
        place[(self.keys[place] != keys) | (self.checks[place] != checks)] = -1
        self.used[place[place >= 0]] = self.clock
        return place

    def add(self, keys: np.ndarray, checks: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
        """Distinct segments with their numbers of ids, and all ids. One whose 64 bits another has takes the other's place."""
        at, order = self.flat.size + np.cumsum(n) - n, np.argsort(keys)
        keys = keys[order]
        if self.keys.size:
            stays = self.keys[np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)] == keys
            if stays.any():
                self._take(~np.isin(self.keys, keys[stays]))
        where = np.searchsorted(self.keys, keys)
        for name, new in (("keys", keys), ("checks", checks[order]), ("at", at[order]), ("n", n[order]), ("used", np.full(n.size, self.clock))):
            setattr(self, name, np.insert(getattr(self, name), where, new))
        self.flat = np.concatenate([self.flat, ids])

    def _take(self, keep: np.ndarray) -> None:
        self.keys, self.checks, self.at, self.n, self.used = (x[keep] for x in (self.keys, self.checks, self.at, self.n, self.used))

    def tick(self) -> None:
        """Ends a step; a full memory forgets the half that was not used for longest."""
        self.clock += 1
        if self.keys.size > REMEMBERED:
            self._take(self.used > np.median(self.used))
            self.flat = self.ids(np.arange(self.keys.size))
            self.at = np.cumsum(self.n) - self.n

    def ids(self, places: np.ndarray) -> np.ndarray:
        """The ids of these segments, one after the other."""
        n = self.n[places]
        return self.flat[np.repeat(self.at[places] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


class Encoder:
    """Ids of whole texts by the tokenizers library, with the ids of segments remembered.

    A byte-level file with the usual pattern begins a new pre-token at every blank that stands before a non-blank, and
    tokens never cross pre-tokens; so the ids of a text are those of its segments between such blanks, one after the other.
    New segments are encoded many at once, as one text: only a segment's first token can begin with a blank, which tells
    them apart. Files of another kind, and texts that hold a special token's string, are encoded as a whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.split = type(self.model.pre_tokenizer).__name__ == "ByteLevel" and self.model.normalizer is None and not self.model.pre_tokenizer.add_prefix_space and self.model.pre_tokenizer.use_regex
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.begins = np.array([(self.model.id_to_token(i) or "").startswith("Ġ") for i in range(self.model.get_vocab_size())])
        self.known = Memory()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_new(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the segments, the number of ids of each in that order, and all ids."""
        plain = [i for i, s in enumerate(segments) if s.rfind(b" ") == 0]
        runs = [plain[a : a + JOINED] for a in range(0, len(plain), JOINED)]
        order, counts, flat = [], [], []
        for run, ids in zip(runs, self._ids([b"".join([segments[i] for i in r]).decode() for r in runs]), strict=True):
            begins = np.flatnonzero(self.begins[ids])
            if begins.size == len(run):
                order += run
                counts.append(np.diff(np.append(begins, ids.size)))
                flat.append(ids)
        done = set(order)
        rest = [i for i in range(len(segments)) if i not in done]
        flat += self._ids([segments[i].decode() for i in rest])
        counts.append(np.array([x.size for x in flat[len(flat) - len(rest) :]], np.int64))
        return np.array(order + rest, np.int64), np.concatenate(counts), np.concatenate([np.zeros(0, "<u4"), *flat])

    def encode(self, column: pa.Array, end: int) -> list[np.ndarray]:
        """Ids of each text of a large string column, then the end id; the texts are small enough to be held at once."""
        whole = pa.array([not self.split] * len(column), pa.bool_())
        for s in self.special if self.split else []:
            whole = pc.or_(whole, pc.match_substring(column, s))
        apart = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        data, bounds = raw_bytes(pc.if_else(whole, pa.scalar("", column.type), column) if apart.size else column)
        starts, keys, checks, rows = segments(data, bounds)
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        place = self.known.find(distinct, checks[first])
        if (new := np.flatnonzero(place < 0)).size:
            ends = np.append(starts[1:], data.size)
            raw = data.tobytes()
            order, counts, ids = self._encode_new([raw[a:z] for a, z in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            self.known.add(distinct[new[order]], checks[first[new[order]]], counts, ids)
            place = self.known.find(distinct, checks[first])
        own = place[inverse]
        counts = np.concatenate([[0], np.cumsum(self.known.n[own])])[rows]
        ids = self.known.ids(own)
        self.known.tick()
        flat = np.insert(ids, counts[1:], end)
        cuts = counts + np.arange(counts.size)
        out = [flat[a:z] for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        for i, x in zip(apart.tolist(), self._ids([column[i].as_py() for i in apart.tolist()]), strict=True):
            out[i] = np.append(x, np.uint32(end))
        return out


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


# --- Spark -------------------------------------------------------------------------------------------------------

#: Bytes of text for a file.
FILE_BYTES = 256 << 20


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """Writes ``docs`` into ``folder``; returns (file, ids in all files before it) in document order."""
    text_batches(docs.sparkSession)
    make_dirs(folder)

    def write(batches):
        total = 0

        def rows():
            nonlocal total
            for b in batches:
                texts = texts_of(b.column(1))
                ids, sizes = b.column(0).to_pylist(), np.diff(raw_bytes(texts)[1]).tolist()
                for a, z in byte_runs(sizes, STEP_BYTES):
                    for key, row in zip(ids[a:z], encoder(path).encode(texts.slice(a, z - a), end_id), strict=True):
                        total += row.size
                        yield key, row

        source = rows()
        first = next(source, None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        name = put_file(folder, f"tokens-{part:06d}.zst", pack_file(x for xs in ([first], source) for x in xs))
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([total], pa.int64())], ["part", "name", "n"])

    narrow = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("id"), F.col(text_col).alias("text"))
    # Rows of one id can't be dealt to several ranges by the id alone: the text's length and checksum split them.
    order = [F.col("id"), F.octet_length("text"), F.crc32(F.col("text").cast("binary"))]
    # As many files as shuffle partitions (or fewer: adaptive execution merges small ones), and more where they would grow too large.
    count = -(-(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0) // FILE_BYTES)
    many = count > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = narrow.repartitionByRange(count, *order) if many else narrow.repartitionByRange(*order)
    files = ranges.sortWithinPartitions(*order).mapInArrow(write, "part int, name string, n long").collect()  # a row for each file
    files.sort(key=lambda r: r.part)
    before = accumulate((r.n for r in files), initial=0)
    return [(r.name, b) for r, b in zip(files, before, strict=False)]


def read_token_files(spark, files: list[tuple[str, int]], digest_only: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) of every document in the files; with ``digest_only`` without the ids."""
    fields = "id long, start long, n_tokens long, ids_crc32 long" + ("" if digest_only else ", ids array<long>")
    if not files:
        return spark.createDataFrame([], fields)
    listed = spark.createDataFrame(files, "name string, before long").repartition(len(files))

    def read(batches):
        for b in batches:
            for name, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                file = TokenFile(open_file(name))
                for k in range(len(file.entries)):
                    rows = list(file.frame(k))
                    counts = [x.size for _, x in rows]
                    starts = [at, *(at + c for c in accumulate(counts))]
                    at = starts.pop()
                    columns = [
                        pa.array([key if key != _NULL_ID else None for key, _ in rows], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([zlib.crc32(x.tobytes()) for _, x in rows], pa.int64()),
                    ]
                    names = ["id", "start", "n_tokens", "ids_crc32"]
                    if not digest_only:
                        columns.append(pa.array([x.astype(np.int64) for _, x in rows], pa.list_(pa.int64())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

    return listed.mapInArrow(read, fields)


def encode_to_files(docs: DataFrame, path: str, folder: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files and reads them back: (id, start, n_tokens, ids_crc32) of every row of ``docs``."""
    files = write_token_files(docs, path, folder or shared_dir(docs.sparkSession), end_id, id_col, text_col)
    return read_token_files(docs.sparkSession, files, digest_only=True).withColumnRenamed("id", id_col)
