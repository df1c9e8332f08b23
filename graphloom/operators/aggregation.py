"""Valid and deduplicated entities and relationships.

Rows are ordered by ``ord``, a struct such as (doc_id, chunk_seq, pos). First and last are min_by and max_by on it, which
tasks sum up before the shuffle, so a hub entity's occurrences never meet in one list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid_entities(df: DataFrame) -> DataFrame:
    """Name and type are not empty."""
    return df.where((F.col("name") != "") & (F.col("entity_type") != ""))


def valid_relationships(df: DataFrame) -> DataFrame:
    """Both ends and the type are not empty."""
    return df.where((F.col("from_entity") != "") & (F.col("to_entity") != "") & (F.col("relationship_type") != ""))


def merge_properties(df: DataFrame, keys: tuple[str, ...] = ("name", "entity_type")) -> DataFrame:
    """A row for each key, with its first ``ord``, number of rows, and for each property name the last value by ``ord``.

    The input is read once. Rows without properties count too: they are one entry with a null name.
    """
    entries = df.select(*keys, "ord", F.posexplode_outer(F.map_entries("properties")).alias("pos", "e"))
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0  # each row has one such entry
    last = entries.groupBy(*keys, F.col("e.key").alias("k")).agg(F.max_by("e.value", "ord").alias("v"), F.min("ord").alias("ord"), F.sum(first.cast("long")).alias("n"))
    named = F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "v")))  # nulls are left out
    return last.groupBy(*keys).agg(F.min("ord").alias("ord"), F.sum("n").alias("occurrences"), F.map_from_entries(F.array_sort(named)).alias("properties"))


def dedupe_entities(df: DataFrame) -> DataFrame:
    """One row for each exact (name, type) with its first place, number of occurrences and merged properties."""
    return merge_properties(df)


def dedupe_relationships(df: DataFrame) -> DataFrame:
    """One row for each (from, type, to), with the first one's properties."""
    keys = ("from_entity", "relationship_type", "to_entity")
    return df.groupBy(*keys).agg(F.min_by("properties", "ord").alias("properties"), F.min("ord").alias("ord"))


def count_relationships(df: DataFrame) -> DataFrame:
    """The distinct valid (from, type, to), with the number of their rows as ``occurrences``."""
    return valid_relationships(df).groupBy("from_entity", "relationship_type", "to_entity").agg(F.count("*").alias("occurrences"))


def entity_support(df: DataFrame) -> DataFrame:
    """Occurrences, chunks and documents of each entity."""
    per_chunk = df.groupBy("name", "entity_type", "doc_id", "chunk_seq").agg(F.count("*").alias("n"))
    per_doc = per_chunk.groupBy("name", "entity_type", "doc_id").agg(F.sum("n").alias("n"), F.count("*").alias("chunks"))
    return per_doc.groupBy("name", "entity_type").agg(F.sum("n").alias("occurrences"), F.sum("chunks").alias("chunks"), F.count("*").alias("documents"))
