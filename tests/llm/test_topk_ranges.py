"""Top-k by large components, in several chunks of queries and small ranges, and of empty tables."""

import math

import pytest

from graphloom.llm import topk_search


def brute(rows, k):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    out = []
    for q, w in good:
        if q % 5 == 0:
            scores = sorted((-sum(a * b for a, b in zip(w, v, strict=False)), i) for i, v in good if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e5, 3e5, 1.3e6])
def test_large_components_are_exact(spark, scale):
    rows = [(i, [scale * ((i * 37 + d * 11) % 19 - 9) / 10 for d in range(3)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk_search.top_k(df.where("vec_id % 5 = 0"), df, 4).collect())) == brute(rows, 4)


@pytest.mark.parametrize("large", [1e17, -1e17, 1e300, 3e8])
def test_what_does_not_fit_raises(spark, large):
    df = spark.createDataFrame([(0, [large, 0.001]), (1, [large, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="OverflowError"):
        topk_search.top_k(df.where("vec_id = 0"), df, 2).collect()


def test_chunks_and_ranges_of_bytes(spark, monkeypatch):
    rows = [(i, [((i * 37 + d * 11) % 19 - 9) / 10 for d in range(1 + i % 7)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    monkeypatch.setattr(topk_search, "QUERY_BYTES", 100)
    monkeypatch.setattr(topk_search, "RANGE_BYTES", 200)
    asked = df.where("vec_id % 5 = 0")
    assert sorted(map(tuple, topk_search.top_k(asked, df, 4).collect())) == brute(rows, 4)
    assert topk_search.top_k(asked, df.where("false"), 4).count() == topk_search.top_k(asked.where("false"), df, 4).count() == 0
