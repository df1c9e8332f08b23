"""The corpus pipeline: language ID, near-duplicate removal, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import decontaminate, jaccard_join, language_id, mixing, token_files
from graphloom.llm.queries import fold, table
from graphloom.llm.shared import shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document goes when no learned language makes up this share of its words.
LEAST_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose main language has at least half of the words; ``lang`` is set to it. Those without a letter go."""
    model = language_id.train(docs.where(fold("doc_id", 3) != 1))
    judged = language_id.predict(docs, model, [F.col(c) for c in COLUMNS])
    kept = judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return kept.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the one with the smallest id, once (of several
    texts under that id the least stays). Documents without words or without an id link nothing and stay."""
    groups = jaccard_join.jaccard_components(docs, percent=80)
    first = groups.where("component_id = doc_id").select("doc_id").distinct()
    # The join has dealt the rows by id, so keeping one row of a repeated id costs no further shuffle.
    kept = docs.join(first, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("row"))
    return kept.select("doc_id", "row.*").unionByName(docs.where("doc_id is null").select(*COLUMNS))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), least=0.8).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of half of the tokens in which source, language and topic shares follow their tempered targets."""
    return mixing.mix(docs, budget=0.5, topics=mixing.label_topics(table(spark, sf_dir, "labels"))).select(*COLUMNS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the sample in the shared folder, read back: (doc_id, start, n_tokens, ids_crc32)."""
    return token_files.encode_to_files(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: Mixture inference and byte-pair encoding are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read as the next one's input.

    Documents without a letter, null texts among them, go with the first stage, and of repeated rows one stays after the second;
    rows with a null id are kept apart from near-duplicate removal. Long texts are judged and encoded whole. Further columns of
    ``documents`` are not read; an empty table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES:
        path = shared_dir(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
