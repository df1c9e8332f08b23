"""op5: words and contexts with far more tokens than a shard, and unknown words among the successors of frequent ones."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import ngram_lm
from graphloom.llm.elias_fano import EliasFano, encode


def brute_force(train, texts):
    """Exact log10 probabilities of texts, of the same smoothing without quantisation."""
    toks = lambda t: [None, None, *t.split(), None]
    c, pairs, triples = Counter(), Counter(), Counter()
    for t in train:
        seq = toks(t)
        c.update(seq[2:])
        pairs.update(zip(seq[1:], seq[2:], strict=False))
        triples.update(zip(seq, seq[1:], seq[2:], strict=False))
    off = lambda k: (0, *ngram_lm.DISCOUNTS)[min(k, 3)]
    total, left = Counter(), Counter()
    for level in (pairs, triples):
        for key, k in level.items():
            total[key[:-1]] += k
            left[key[:-1]] += off(k)
    n, v = sum(c.values()), len(c)

    def prob(u, a, b):
        p = (c[b] + 0.1) / (n + 0.1 * (v + 1))
        if total[a,]:
            p = (pairs[a, b] - off(pairs[a, b]) + left[a,] * p) / total[a,]
        if total[u, a]:
            p = (triples[u, a, b] - off(triples[u, a, b]) + left[u, a] * p) / total[u, a]
        return p

    return [sum(math.log10(prob(*x)) for x in zip(s, s[1:], s[2:], strict=False)) for s in map(toks, texts)]


@pytest.mark.parametrize("step", [64, 1 << 20])
def test_hot_words_and_contexts_are_split(spark, monkeypatch, step):
    rng = random.Random(5)
    some = [f"w{i}" for i in range(60)]
    # A third of all tokens follow "hot word"; the rest is spread.
    train = [" ".join(x for _ in range(40) for x in ("hot", "word", rng.choice(some))) + " " + " ".join(rng.choices(some, k=40)) for _ in range(30)]
    new = [" ".join(x for i in range(30) for x in ("hot", "word", rng.choice(some) if i % 2 else f"new{rng.random()}")) for _ in range(10)]
    new += ["word " + " word ".join([f"n{i}" if i % 2 else rng.choice(some) for i in range(60)]) for _ in range(5)]
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 400)
    monkeypatch.setattr(ngram_lm, "STEP_TOKENS", step)
    docs = lambda texts: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trie = ngram_lm.build(docs(train))
    keys, parts = np.unique(trie.part_key, return_counts=True)
    assert parts.max() >= 3 and trie.part_share[trie.part_key == keys[parts.argmax()]].max() < 0.6  # the hot context
    texts = train[:5] + new + ["", "hot", "hot word", "unknown hot word unknown"]
    got = {r.doc_id: r for r in ngram_lm.score(docs(texts), trie, [F.col("doc_id")]).collect()}
    for i, full in enumerate(brute_force(train, texts)):
        assert full - 4 * (len(texts[i].split()) + 1) / 4096 - 1e-6 <= got[i].score <= full + 1e-6


def test_the_start_of_all_texts_is_split(spark, monkeypatch):
    train = [f"w{i % 50} x{i % 7}" for i in range(900)]
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 300)
    docs = lambda texts: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trie = ngram_lm.build(docs(train))
    assert np.unique(trie.part_key, return_counts=True)[1].max() > 5 and trie.part_share.min() < 0.2
    texts = [*train[:60], "", "new x1", "x1 w2 x3", "new new"]
    got = {r.doc_id: r.score for r in ngram_lm.score(docs(texts), trie, [F.col("doc_id")]).collect()}
    for i, full in enumerate(brute_force(train, texts)):
        assert full - 4 * (len(texts[i].split()) + 1) / 4096 - 1e-6 <= got[i] <= full + 1e-6


def test_searches_of_even_and_crowded_sequences():
    rng = np.random.default_rng(1)
    for turn in range(200):
        universe, n = int(rng.integers(1, 1 << int(rng.integers(1, 50)))), int(rng.integers(0, 400))
        values = np.unique(rng.integers(0, universe, n, dtype=np.uint64) // np.uint64(1 if turn % 3 else 1 + universe // 50))
        asked = np.sort(np.concatenate([values, rng.integers(0, universe, 100, dtype=np.uint64)]))
        place = {x: i for i, x in enumerate(values.tolist())}
        found = EliasFano(np.frombuffer(encode(values, universe), np.uint8)).find(asked)
        assert found.tolist() == [place.get(x, -1) for x in asked.tolist()]
