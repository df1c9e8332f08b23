"""Byte-level BPE against the tiktoken library: whole texts, overlapping chunks of small sizes, and the query's digests."""

import base64
import hashlib
import itertools
import random

import public_tokenizers
import pytest
import tiktoken

from graphloom.llm import byte_bpe, queries

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
with open(PATH, "rb") as f:
    LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})
#: Pieces of text that are hard to cut: contractions, blanks before and after line ends, marks, digits, words beyond an overlap.
HARD = ["'ll", "'s", "'", " ", "   ", "\n", "\n\n \n", "\t", "don't", " we've", "12", "345", " 6", "...", " ?!", "é", "日本語", " ñandú", "🙂", " ", " ", "x" * 90, " " * 90, "!" * 90, "7" * 90, "<|endoftext|>", "the quick fox "]


def hard_text(rng, n):
    return "".join(rng.choice(HARD) for _ in range(n))


@pytest.mark.parametrize(("size", "overlap"), [(10, 9), (16, 4), (64, 20), (100, 99), (300, 40)])
def test_stitched_chunks_are_the_whole_text(monkeypatch, size, overlap):
    monkeypatch.setattr(byte_bpe, "CHUNK", size)
    monkeypatch.setattr(byte_bpe, "OVERLAP", overlap)
    rng, table = random.Random(size), byte_bpe.codec(PATH, PATTERN)
    for k in range(300):
        text = hard_text(rng, rng.randrange(1, 120)) if k % 5 else rng.choice(["x", " ", "\n", "a b"]) * rng.randrange(1, 900)
        stitcher = byte_bpe.Stitcher(table)
        pieces = [p for t, ended in byte_bpe.chunks(text) for p in stitcher.push(t, table.boundaries(t, ended), ended)]
        assert "".join(t for t, _ in pieces) == text
        assert [t[a:b] for t, known in pieces for a, b in itertools.pairwise(known.tolist())] == table.pattern.findall(text)
        assert [i for t, known in pieces for i in table.ids([t[a:b] for a, b in itertools.pairwise(known.tolist())])] == LIBRARY.encode_ordinary(text)


def test_a_word_over_many_chunks_is_read_once(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK", 64)
    monkeypatch.setattr(byte_bpe, "OVERLAP", 16)
    table, read = byte_bpe.codec(PATH, PATTERN), []
    text = "begin " + "x" * 20_000 + " end"
    rows = [(t, table.boundaries(t, e), e) for t, e in byte_bpe.chunks(text)]
    whole = byte_bpe.Codec.boundaries
    monkeypatch.setattr(byte_bpe.Codec, "boundaries", lambda self, t, e: read.append(len(t)) or whole(self, t, e))
    stitcher = byte_bpe.Stitcher(table)
    assert "".join(t for r in rows for t, _ in stitcher.push(*r)) == text
    assert sum(read) < 3 * len(text)


def test_query_and_round_trip(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    texts = [None, "", " \n", "<|endoftext|> is text", "x" * 70_000, "word " * 20_000, "é日" * 30_000, "'ll don't " * 9_000, *[hard_text(rng, 50) for _ in range(20)], *[hard_text(rng, 9_000) for _ in range(3)]]
    rows = [(i, t, -1, "old") for i, t in enumerate(texts)]
    rows += [(5, texts[5], -1, "old"), (99, texts[5], -1, "old"), (None, "no id " * 9_000, -1, "old"), (None, None, -1, "old")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, key string").repartition(4)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    digest = lambda x: hashlib.sha256(x).hexdigest()

    def by_hand(i, text):
        ids = LIBRARY.encode_ordinary(text or "")
        return i, len(ids), digest(" ".join(map(str, ids)).encode()), digest((text or "").encode())

    got = queries.op11_byte_bpe(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == sorted([by_hand(i, t) for i, t, *_ in rows], key=str)
    encoded = byte_bpe.encode(frame.where("doc_id is not null"), PATH, PATTERN)
    decoded = {}
    for r in sorted(byte_bpe.decode(encoded, PATH, PATTERN).collect(), key=lambda r: (r.doc_id, r.piece)):
        decoded.setdefault(r.doc_id, []).append((r.piece, r.bytes.decode()))
    assert len(decoded[4]) == 1 and len(decoded[7]) > 1  # a single word is one piece
    assert all("".join(dict(decoded[i]).values()) == (t or "") for i, t in enumerate(texts))
    assert byte_bpe.digests(frame.where("false"), PATH, PATTERN).count() == byte_bpe.encode(frame.where("false"), PATH, PATTERN).count() == 0
