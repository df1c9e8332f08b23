"""Checks of a graph against its schema. Every check counts all rows; listings take a limit for display only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import strip
from graphloom.operators.graph import edge_counts_by_type, node_counts_by_label
from graphloom.sources.shared import written

SYSTEM_LABELS, SYSTEM_TYPES = ("Chunk", "Document"), ("MENTIONS", "FROM_DOCUMENT")


def unexpected_labels(nodes: DataFrame, entity_types: DataFrame | None) -> DataFrame:
    """G1: labels that the schema doesn't have; all labels without a schema."""
    found = nodes.select("label").distinct()
    if entity_types is None:
        return found
    return found.where(~F.col("label").isin(*SYSTEM_LABELS)).join(entity_types.select(F.col("name").alias("label")), "label", "left_anti")


def unexpected_types(edges: DataFrame, relationship_types: DataFrame | None) -> DataFrame:
    """G1: edge types that the schema doesn't have; all types without a schema."""
    found = edges.select("edge_type").distinct()
    if relationship_types is None:
        return found
    return found.where(~F.col("edge_type").isin(*SYSTEM_TYPES)).join(relationship_types.select(F.col("name").alias("edge_type")), "edge_type", "left_anti")


def orphan_nodes(nodes: DataFrame, edges: DataFrame, limit: int | None = None) -> DataFrame:
    """Nodes without any edge, by id."""
    ends = edges.select(F.col("src_id").alias("node_id")).unionByName(edges.select(F.col("dst_id").alias("node_id"))).distinct()
    found = nodes.join(ends, "node_id", "left_anti")
    return found if limit is None else found.orderBy("node_id").limit(limit)


def dangling_chunks(chunks: DataFrame, edges: DataFrame, limit: int | None = None) -> DataFrame:
    """Chunk nodes that mention nothing, by id."""
    found = chunks.join(edges.where("edge_type = 'MENTIONS'").select(F.col("src_id").alias("id")).distinct(), "id", "left_anti")
    return found if limit is None else found.orderBy("id").limit(limit)


def duplicate_entities(nodes: DataFrame) -> DataFrame:
    """Names that several nodes share but for case and blanks at the ends, with all their spellings in order."""
    keyed = nodes.where("name is not null").groupBy(strip(F.lower("name")).alias("key"), "name").agg(F.count("*").alias("n"))
    groups = keyed.groupBy("key").agg(F.sum("n").alias("nodes"), F.array_sort(F.collect_list("name")).alias("names"))
    return groups.where("nodes > 1")


def wrong_direction_edges(nodes: DataFrame, edges: DataFrame, relationship_types: DataFrame) -> DataFrame:
    """Edges of each schema type with both ends given, and how many have another label at one end. All edges count."""
    types = F.broadcast(relationship_types.where("from_type <> '' and to_type <> ''").select(F.col("name").alias("edge_type"), "from_type", "to_type"))  # a schema, not data
    labels = nodes.select("node_id", "label")
    joined = edges.join(types, "edge_type").join(labels.select(F.col("node_id").alias("src_id"), F.col("label").alias("src")), "src_id").join(labels.select(F.col("node_id").alias("dst_id"), F.col("label").alias("dst")), "dst_id")
    wrong = (F.col("src") != F.col("from_type")) | (F.col("dst") != F.col("to_type"))
    return joined.groupBy("edge_type").agg(F.count("*").alias("edges"), F.sum(wrong.cast("long")).alias("wrong"))


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, name, n) of labels and types, and both totals."""
    row = lambda df, kind, name: df.select(F.lit(kind).alias("kind"), name.alias("name"), "n")
    return (
        row(node_counts_by_label(nodes), "label", F.col("label")).unionByName(row(edge_counts_by_type(edges), "type", F.col("edge_type")))
        .unionByName(row(nodes.agg(F.count("*").alias("n")), "total", F.lit("nodes"))).unionByName(row(edges.agg(F.count("*").alias("n")), "total", F.lit("relationships")))
    )


def graph_profile(nodes: DataFrame, edges: DataFrame, chunks: DataFrame) -> DataFrame:
    """A row for each node, chunk and end of an edge: (node_id, label, name, is_node, is_chunk, n_in, n_out, mentions, ends), by one
    union and group-by over the three tables. ``ends`` are the types and sides of its edges: as many as types at most."""
    # Edges are summed up by end, type and side before they meet the nodes, so a hub brings a row for each task.
    sides = F.explode(F.array(F.struct(F.col("src_id").alias("node_id"), F.lit("out").alias("side")), F.struct(F.col("dst_id").alias("node_id"), F.lit("in").alias("side")))).alias("end")
    ends = edges.select("edge_type", sides).groupBy("end.node_id", "edge_type", "end.side").agg(F.count("*").alias("n"))
    none = lambda kind: F.lit(None).cast(kind)
    rows = nodes.select("node_id", "label", "name", F.lit(True).alias("is_node"), F.lit(False).alias("is_chunk"), none("string").alias("edge_type"), none("string").alias("side"), none("long").alias("n"))
    rows = rows.unionByName(chunks.select(F.col("id").alias("node_id"), F.lit(True).alias("is_chunk")), allowMissingColumns=True).unionByName(ends, allowMissingColumns=True)
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    out = F.col("side") == "out"
    return rows.groupBy("node_id").agg(
        F.max("label").alias("label"), F.max("name").alias("name"), F.coalesce(F.max("is_node"), F.lit(False)).alias("is_node"), F.coalesce(F.max("is_chunk"), F.lit(False)).alias("is_chunk"),
        total(~out).alias("n_in"), total(out).alias("n_out"), total(out & (F.col("edge_type") == "MENTIONS")).alias("mentions"), F.collect_set(F.when(F.col("side").isNotNull(), F.struct("edge_type", "side"))).alias("ends"),
    )


def validation_report(nodes: DataFrame, edges: DataFrame, chunks: DataFrame, entity_types: DataFrame | None, relationship_types: DataFrame | None, materialize: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """(check, n, severity) of every check: pass where n is 0; info for what needs a schema that isn't given.

    Each table is read once, for ``graph_profile``; that is written, and the checks read it. A type has the wrong direction if a
    node at one of its edges' ends has another label than the schema says.
    """
    profile = materialize(graph_profile(nodes, edges, chunks))
    one = lambda df, name, bad: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), F.col("n").cast("long").alias("n"), F.lit(bad).alias("bad"))
    no_schema = lambda x: "warning" if x is not None else "info"
    found, ends = profile.where("is_node"), profile.select("label", "is_node", F.explode("ends").alias("e")).select("label", "is_node", "e.*").distinct()
    rows = [
        one(unexpected_labels(found, entity_types), "unexpected_labels", no_schema(entity_types)),
        one(unexpected_types(ends, relationship_types), "unexpected_types", no_schema(relationship_types)),
        one(found.where("n_in + n_out = 0"), "orphan_nodes", "warning"),
        one(profile.where("is_chunk and mentions = 0"), "dangling_chunks", "warning"),
        one(duplicate_entities(found), "duplicate_entities", "error"),
    ]
    if relationship_types is None:  # nothing to compare with: one row that says so
        rows.append(nodes.sparkSession.range(1).select(F.lit("wrong_direction").alias("check"), F.lit(0).cast("long").alias("n"), F.lit("info").alias("bad")))
    else:
        types = F.broadcast(relationship_types.where("from_type <> '' and to_type <> ''").select(F.col("name").alias("edge_type"), "from_type", "to_type"))  # a schema, not data
        wrong = F.col("label") != F.when(F.col("side") == "out", F.col("from_type")).otherwise(F.col("to_type"))
        rows.append(one(ends.where("is_node").join(types, "edge_type").where(wrong).select("edge_type").distinct(), "wrong_direction", "warning"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.select("check", "n", F.when(F.col("bad") == "info", "info").when(F.col("n") == 0, "pass").otherwise(F.col("bad")).alias("severity"))


def severity_counts(report: DataFrame) -> DataFrame:
    """G7's last line: checks by severity."""
    return report.groupBy("severity").agg(F.count("*").alias("n"))
