"""What the operators' docstrings state of empty tables, several chunks, ties, odd ids and clashing names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from graphloom.llm import decontaminate, language_id, ngram_lm, token_counts, token_files, url_filter

EN = "the quick brown fox jumps over the lazy dog while it rains and the river runs to the sea near an old mill "
DE = "der schnelle braune fuchs springt über den faulen hund und es regnet während der fluss zum meer fließt "


def test_chunks_of_items_find_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{i} " + EN * 2 if i % 3 else f"{DE} {i}") for i in range(12)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join((EN if i % 2 else DE).split()[i % 5 : 14])) for i in range(9)], "item_id long, text string")
    whole = sorted(map(tuple, decontaminate.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "CHUNK_ITEMS", 1)
    assert sorted(map(tuple, decontaminate.contaminated(docs, items).collect())) == whole and len(whole) > 20
    assert decontaminate.contaminated(docs.where("false"), items).count() == 0


def test_the_first_of_equal_windows_is_told(spark):
    item = " ".join(EN.split()[:12])
    docs = spark.createDataFrame([(1, f"zero one {item} and {item} and {item}")], "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r.item_id, r.first_word, r.n_words, r.similarity) for r in found] == [(7, 2, 12, 1.0)]


def test_equal_languages_go_to_the_first_label(spark):
    docs = spark.createDataFrame([(i, EN, lang) for i, lang in enumerate(["zz", "aa", "zz", "aa"])], "doc_id long, text string, lang string")
    model = language_id.train(docs)
    got = language_id.predict(docs.withColumn("lang_pred", F.lit("old")), model, [F.col("doc_id"), F.col("lang_pred")]).collect()
    assert {r.lang_pred for r in got} == {"aa"} and all(0 <= r.score <= 1 for r in got)
    assert language_id.predict(docs.where("false"), model, [F.col("doc_id")]).count() == 0


def test_kept_columns_with_a_results_name_give_way(spark):
    docs = spark.createDataFrame([(1, EN, 5.0, "x"), (2, None, 6.0, "y")], "doc_id long, text string, score double, n_tokens string")
    trie = ngram_lm.build(docs)
    got = ngram_lm.score(docs, trie, [F.col("doc_id"), F.col("score"), F.col("n_tokens")])
    assert got.columns.count("score") == got.columns.count("n_tokens") == 1
    assert {r.doc_id: r.n_tokens for r in got.collect()} == {1: len(EN.split()) + 1, 2: 1}
    assert ngram_lm.score(docs.where("false"), trie, [F.col("doc_id")]).count() == 0


def test_the_least_id_stands_for_null_in_files(spark):
    docs = spark.createDataFrame([(-(1 << 63), "a"), (None, "b"), (5, None)], "doc_id long, text string")
    got = token_files.encode_to_files(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == [("5", 1), ("None", 2), ("None", 2)]


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_counts_of_a_text_without_a_safe_cut(spark, monkeypatch, name):
    path = public_tokenizers.path(name)
    monkeypatch.setattr(token_counts, "PIECE_CHARS", 50)
    texts = ["x" * 500, "à  é\n" * 100, "12,34;" * 90, "é " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path, 100).collect()}
    assert got == {i: token_counts._library(path).count([t])[0] for i, t in enumerate(texts)}
    assert token_counts.count_tokens(docs.where("false"), path, 100).count() == 0


def test_no_pages_give_none(spark):
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
