"""op5: pairs stand beside the triples of their first word, words are searched for once in a long run of rows, and memory is bounded."""

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from graphloom.llm import ngram_lm
from graphloom.llm.elias_fano import EliasFano, encode
from tests.llm.test_ngram_lm_shards import brute_force


def test_pair_files_hold_words_of_several_shards_alone(spark, monkeypatch):
    rng = random.Random(7)
    some = [f"w{i}" for i in range(200)]
    train = [" ".join(rng.choices(some, [1 / (i + 1) for i in range(200)], k=rng.randrange(40))) for _ in range(120)]
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 900)
    docs = lambda texts: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trie = ngram_lm.build(docs(train))
    ids = np.arange(trie.words.size)
    lowest, highest = trie.words.reach(*trie.words.counts(ids), trie.shards)
    split = set(ids[lowest < highest].tolist())
    held = [ngram_lm._pairs(f"{trie.folder}/pairs-{s}")[0].values().tolist() for s in np.flatnonzero(trie.present[0])]
    assert trie.shards >= 8 and 0 < len(split) < trie.words.size / 2
    assert {x for each in held for x in each} == split  # every word before
    texts = [*train[:40], "", "w0", "new w0 new w1", *(" ".join(rng.choices([*some, "new"], k=30)) for _ in range(30))]
    got = {r.doc_id: r.score for r in ngram_lm.score(docs(texts), trie, [F.col("doc_id")]).collect()}
    for i, full in enumerate(brute_force(train, texts)):
        assert full - 4 * (len(texts[i].split()) + 1) / 4096 - 1e-6 <= got[i] <= full + 1e-6


def test_slices_of_triples_give_the_same(spark, monkeypatch):
    rng = random.Random(8)
    train = [" ".join(rng.choices("abcdefgh", k=60)) for _ in range(40)]
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 500)
    trie = ngram_lm.build(spark.createDataFrame([(t,) for t in train], "text string"))
    ((_, tokens, _),) = ngram_lm._tokens(pa.array([*train, "a x b", "x x"], pa.large_string()))
    whole = trie.score(tokens)
    monkeypatch.setattr(ngram_lm, "SEARCHED", 17)
    assert all((a == b).all() for a, b in zip(whole, trie.score(tokens), strict=True))


def test_batches_are_scored_in_runs_of_many_tokens_and_bounded_bytes(monkeypatch):
    monkeypatch.setattr(ngram_lm, "STEP_TOKENS", 100)
    rng = random.Random(9)

    def runs(sizes, batch, width=1):
        for a in range(0, len(sizes), batch):
            rows = pa.record_batch({"i": np.arange(a, min(a + batch, len(sizes))), "text": ["x" * width] * len(sizes[a : a + batch])})
            bounds = np.concatenate([[0], np.cumsum(sizes[a : a + batch])])
            yield rows, np.repeat(np.arange(a, a + bounds.size - 1), np.diff(bounds)), bounds

    for sizes in ([10] * 100, [rng.randrange(1, 30) for _ in range(200)], [250, 1, 100, 101, 99, 1, 1], []):
        found = list(ngram_lm._row_runs(runs(sizes, 3)))
        rows = [i for run in found for some, _, _ in run for i in some.column(0).to_pylist()]
        assert rows == list(range(len(sizes)))
        assert [np.concatenate([np.diff(b) for _, _, b in run]).sum() for run in found] == [sum(t.size for _, t, _ in run) for run in found]
        assert (np.concatenate([t for run in found for _, t, _ in run]) if sizes else np.zeros(0)).tolist() == np.repeat(np.arange(len(sizes)), sizes).tolist()
        for run in found:
            assert sum(t.size for _, t, _ in run) <= 100 or sum(some.num_rows for some, _, _ in run) == 1
        assert len(found) <= math.ceil(sum(sizes) / 70) + 2  # not a run a batch
    monkeypatch.setattr(ngram_lm, "RUN_BYTES", 5000)
    assert all(len(run) <= 4 for run in ngram_lm._row_runs(runs([1] * 60, 1, 1200)))  # texts without blanks have few tokens


def test_places_in_dense_and_sparse_words():
    rng = np.random.default_rng(3)
    for share in (0.01, 0.5, 0.99, 1.0):
        values = np.flatnonzero(rng.random(5000) < share).astype(np.uint64)
        for universe in (5000, 1 << 40):
            seq = EliasFano(np.frombuffer(encode(values, universe), np.uint8))
            assert (seq.at(np.arange(values.size)) == values).all() and (seq.find(values) == np.arange(values.size)).all()
