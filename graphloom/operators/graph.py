"""Entities, relationships and chunks to a property graph without duplicates.

nodes(node_id, label, name, properties), edges(src_id, edge_type, dst_id), chunks(id, text, source, section, char_count).
Every upsert takes the existing rows first, so loading twice gives what loading once gives.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import normalized_name
from graphloom.operators.aggregation import merge_properties, valid_entities, valid_relationships
from graphloom.operators.components import components
from graphloom.sources.shared import written

EDGE = ("src_id", "edge_type", "dst_id")
CHUNK_FIELDS = ("text", "source", "section", "char_count")


def node_id(label: Column, name: Column) -> Column:
    return F.md5(F.concat(label, F.lit("\u0001"), name).cast("binary"))


def effective_name(df: DataFrame) -> DataFrame:
    """a property called ``name`` replaces the name."""
    return df.withColumn("name", F.coalesce(F.try_element_at("properties", F.lit("name")), "name"))


def merge_entity_nodes(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """upsert by (label, name); given properties replace, others stay. ``incoming``: name, entity_type, properties, ord.
    ``existing`` holds each node once, as this function leaves it, and joins by node_id."""
    rows = effective_name(valid_entities(incoming)).select(F.col("entity_type").alias("label"), "name", "properties", "ord")
    merged = merge_properties(rows, ("label", "name"))
    new = merged.select(node_id(F.col("label"), F.col("name")).alias("node_id"), "label", "name", "properties")
    return new if existing is None else upsert_nodes(existing, new)


def upsert_nodes(existing: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` nodes over ``existing`` ones, both distinct by node_id: a full join, so a stored side that is bucketed by node_id is
    not shuffled."""
    fields = ("label", "name", "properties")
    old = existing.select("node_id", F.struct(*fields).alias("old"))
    both = old.join(new.select("node_id", F.struct(*fields).alias("new")), "node_id", "full_outer")
    kept = F.filter(F.map_entries("old.properties"), lambda e: ~F.array_contains(F.map_keys("new.properties"), e["key"]))
    properties = F.map_from_entries(F.array_sort(F.concat(kept, F.map_entries("new.properties"))))
    one = lambda c: F.coalesce(f"new.{c}", f"old.{c}").alias(c)
    return both.select("node_id", one("label"), one("name"), F.coalesce(properties, "new.properties", "old.properties").alias("properties"))


def resolve_edges(relationships: DataFrame, nodes: DataFrame) -> DataFrame:
    """ends are matched by name under any label; edges are distinct, unknown ends drop out.

    Names are gathered to arrays of node ids first (as many as labels), so each relationship joins once for an end.
    """
    ids = nodes.groupBy("name").agg(F.collect_set("node_id").alias("ids"))
    pairs = valid_relationships(relationships).select("from_entity", F.col("relationship_type").alias("edge_type"), "to_entity").distinct()
    ends = pairs.join(ids.select(F.col("name").alias("from_entity"), F.col("ids").alias("src")), "from_entity").join(ids.select(F.col("name").alias("to_entity"), F.col("ids").alias("dst")), "to_entity")
    return ends.select("edge_type", F.explode("src").alias("src_id"), "dst").select("src_id", "edge_type", F.explode("dst").alias("dst_id")).distinct()


def unmatched_relationships(relationships: DataFrame, nodes: DataFrame) -> DataFrame:
    """the valid relationships with an end that no node has."""
    names = nodes.select("name").distinct().withColumn("known", F.lit(True))
    rows = valid_relationships(relationships)
    rows = rows.join(names.select(F.col("name").alias("from_entity"), F.col("known").alias("_from")), "from_entity", "left").join(names.select(F.col("name").alias("to_entity"), F.col("known").alias("_to")), "to_entity", "left")
    return rows.where(F.col("_from").isNull() | F.col("_to").isNull()).drop("_from", "_to")


def merge_edges(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """upsert by (source, type, target). ``existing`` holds each edge once; bucketed by the three it is not shuffled."""
    new = incoming.select(*EDGE).distinct()
    return new if existing is None else existing.select(*EDGE).join(new, list(EDGE), "full_outer")


def merge_chunk_nodes(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """upsert by content id; the last source and section by ``ord`` win. ``existing`` holds each id once."""
    new = incoming.groupBy("id").agg(F.max_by(F.struct(*CHUNK_FIELDS), "ord").alias("node")).select("id", "node.*")
    return new if existing is None else upsert_chunks(existing, new)


def upsert_chunks(existing: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` chunk nodes over ``existing`` ones, both distinct by id, by a full join."""
    old = existing.select("id", F.struct(*CHUNK_FIELDS).alias("old"))
    both = old.join(new.select("id", F.struct(*CHUNK_FIELDS).alias("new")), "id", "full_outer")
    return both.select("id", F.coalesce("new", "old").alias("node")).select("id", "node.*")


#: Bytes of the gram by which a name is looked up in texts, the most bits (2 to this) of the map that tells grams of no name apart
#: early and its bits for a name, and the bytes of text that a task looks at in one step.
GRAM, MAP_BITS, BITS_A_NAME, STEP = 6, 27, 64, 1 << 20
#: Names of one or two letters up to which all are looked for in each text at once; nearly all texts meet in such a gram.
TINY, TINY_NAMES = 3, 4096


def _grams(column: pa.Array, n: int, keep: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, gram) of the distinct grams of ``n`` bytes within each string, of those that ``keep`` marks. A gram is a number: n, then its bytes."""
    column = column.cast(pa.large_string())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends, rows, grams = ends - ends[0], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for a in range(0, data.size - n + 1, STEP):
        b = min(a + STEP, data.size - n + 1)
        gram = np.full(b - a, n, np.uint64)
        for i in range(n):
            gram <<= np.uint64(8)
            gram |= data[a + i : b + i]
        at = np.arange(b - a) if keep is None else np.flatnonzero(keep(gram))
        row = np.searchsorted(ends, at + a, "right") - 1
        whole = at + a + n <= ends[row + 1]
        rows.append(row[whole])
        grams.append(gram[at[whole]])
    row, gram = np.concatenate(rows), np.concatenate(grams)
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    new = np.ones(row.size, bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    return row[new], gram[new].view(np.int64)


def _slots(gram: np.ndarray) -> np.ndarray:
    """Places of grams in a map of 2 to the ``MAP_BITS`` bits."""
    return (gram.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - MAP_BITS)).view(np.int64)


def _anchors(names: DataFrame) -> DataFrame:
    """(low, gram, slot): each name's gram that the fewest names have; a shorter name is its own gram."""

    def run(batches):
        for batch in batches:
            low = batch.column(0)
            size = np.minimum(pc.binary_length(low).to_numpy(zero_copy_only=False), GRAM)
            for n in np.unique(size).tolist():
                some = low.filter(pa.array(size == n))
                row, gram = _grams(some, n)
                yield pa.RecordBatch.from_arrays([some.take(pa.array(row)), pa.array(gram), pa.array(_slots(gram))], ["low", "gram", "slot"])

    grams = names.mapInArrow(run, "low string, gram long, slot long")
    shared = grams.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = F.min_by(F.struct("gram", "slot"), F.struct("n", "gram")).alias("best")
    return grams.join(shared, "gram").groupBy("low").agg(rarest).select("low", "best.*")


def _gram_map(anchors: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """The map of the ``n`` anchors' slots, ``BITS_A_NAME`` bits or more for each up to 2 to the ``MAP_BITS`` in all (16 MB), and how far to shift slots for it."""
    bits = max(15, min(MAP_BITS, (n * BITS_A_NAME - 1).bit_length()))
    place = anchors.select((F.shiftright("slot", MAP_BITS - bits) + 1).alias("place")).withColumn("part", F.bitmap_bucket_number("place"))
    parts = place.repartition("part").groupBy("part").agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).toArrow()
    out = np.zeros((1 << bits - 15, 4096), np.uint8)
    for part, found in zip(parts.column(0).to_pylist(), parts.column(1).to_pylist(), strict=True):
        out[part - 1] = np.frombuffer(found, np.uint8)
    return out.ravel(), MAP_BITS - bits


def _mentions(hits: DataFrame, names: DataFrame) -> DataFrame:
    return hits.join(names, "low").select("src_id", F.lit("MENTIONS").alias("edge_type"), F.col("node_id").alias("dst_id")).distinct()


def _lowered(chunks: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = nodes.where("name <> ''").select(F.lower("name").alias("low"), "node_id").distinct()
    return chunks.select(F.col("id").alias("src_id"), F.lower("content").alias("body")), names


def link_mentions(chunks: DataFrame, nodes: DataFrame) -> DataFrame:
    """(chunk id, node id) where the chunk's text has the node's name as a substring, upper and lower case alike.

    A text's grams meet the names' anchors in an equality join, and ``contains`` confirms each pair. Grams whose bit in a map of
    the anchors is not set go before that; the map is broadcast, 16 MB at most. Names of one or two letters are tried on each
    text itself (more than ``TINY_NAMES`` of them join by grams too). Rows of one id count as one chunk.
    """
    texts, names = _lowered(chunks, nodes)
    distinct = names.select("low").distinct()
    found = None
    tiny = [r[0] for r in distinct.where(F.length("low") < TINY).limit(TINY_NAMES + 1).collect()]
    if 0 < len(tiny) <= TINY_NAMES:
        distinct = distinct.where(F.length("low") >= TINY)
        found = texts.select("src_id", F.explode(F.filter(F.lit(tiny), lambda low: F.contains(F.col("body"), low))).alias("low"))
    anchors = written(_anchors(distinct))
    sizes = dict(map(tuple, anchors.groupBy(F.least(F.octet_length("low"), F.lit(GRAM))).count().collect()))  # of 1 to GRAM bytes
    if sizes:
        bits, shift = _gram_map(anchors, sum(sizes.values()))
        sent = texts.sparkSession.sparkContext.broadcast(bits)

        def run(batches):
            def known(gram):
                slot = _slots(gram) >> shift
                return sent.value[slot >> 3] >> (slot & 7).astype(np.uint8) & 1

            for batch in batches:
                for n in sizes:
                    row, gram = _grams(batch.column(1), n, known)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(gram)], ["src_id", "gram"])

        kind = texts.schema["src_id"].dataType.simpleString()
        maybe = texts.where("body is not null").mapInArrow(run, f"src_id {kind}, gram long").join(anchors, "gram").select("src_id", "low").distinct()
        held = maybe.join(texts, "src_id").where(F.contains("body", "low")).select("src_id", "low")
        found = held if found is None else found.unionByName(held)
    if found is None:
        found = texts.select("src_id", F.col("body").alias("low")).limit(0)
    return _mentions(found, names)


def document_nodes(documents: DataFrame) -> DataFrame:
    """A ``Document`` node for each source and file type."""
    rows = documents.select("source", "file_type").distinct()
    properties = F.create_map(F.lit("source"), F.col("source"), F.lit("file_type"), F.col("file_type"))
    return rows.select(node_id(F.lit("Document"), F.col("source")).alias("node_id"), F.lit("Document").alias("label"), F.col("source").alias("name"), properties.alias("properties"))


def from_document_edges(chunks: DataFrame) -> DataFrame:
    """Chunk FROM_DOCUMENT document."""
    return chunks.select(F.col("id").alias("src_id"), F.lit("FROM_DOCUMENT").alias("edge_type"), node_id(F.lit("Document"), F.col("source")).alias("dst_id")).distinct()


def resolve_entities(entities: DataFrame, aliases: DataFrame | None = None, materialize: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """(name, canonical_id, canonical_name) of every name. Names with one normal form are one entity.

    The canonical name is the most frequent one, ties by first ``ord``. ``aliases`` (a, b) join normal forms, also along
    chains of any length (``components``).
    """
    named = entities.select("name", normalized_name(F.col("name")).alias("key"), "ord")
    counted = named.groupBy("key", "name").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    if aliases is None:
        counted = counted.withColumn("label", F.col("key"))
    else:
        links = aliases.select(normalized_name(F.col("a")).alias("x"), normalized_name(F.col("b")).alias("y")).where("x is not null and y is not null")
        roots = components(links, materialize).select(F.col("node").alias("key"), "root")
        counted = counted.join(roots, "key", "left").withColumn("label", F.coalesce("root", "key")).drop("root")
    # Most frequent first; the earlier of equals: n ascending and the negative place can't be one struct, so two steps.
    most = counted.groupBy("label").agg(F.max("n").alias("n"))
    best = counted.join(most, ["label", "n"]).groupBy("label").agg(F.min_by("name", "first").alias("canonical_name"))
    return counted.join(best, "label").select("name", F.md5(F.col("label").cast("binary")).alias("canonical_id"), "canonical_name")


def canonical_nodes(nodes: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes under their canonical names, those of one label and name merged (the canonical one's properties win, then
    those of the larger name), and (node_id, canonical_node_id) of every node. Names that ``resolved`` lacks stay."""
    names = resolved.select("name", "canonical_name").distinct()
    named = nodes.join(names, "name", "left").withColumn("canonical", F.coalesce("canonical_name", "name"))
    rows = named.select("label", F.col("canonical").alias("name"), "properties", F.struct((F.col("name") == F.col("canonical")).alias("own"), F.col("name")).alias("ord"))
    merged = merge_properties(rows, ("label", "name"))
    new_id = node_id(F.col("label"), F.col("canonical")).alias("canonical_node_id")
    return merged.select(node_id(F.col("label"), F.col("name")).alias("node_id"), "label", "name", "properties"), named.select("node_id", new_id)


def rewrite_edges(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """The distinct edges between canonical nodes; ``mapping`` is (node_id, canonical_node_id), other ends stay. Only ids that
    change take part in the two joins."""
    changed = mapping.where("node_id <> canonical_node_id")
    for end in ("src_id", "dst_id"):
        to = changed.select(F.col("node_id").alias(end), F.col("canonical_node_id").alias("_to"))
        edges = edges.join(to, end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
    return edges.select(*EDGE).distinct()


def node_counts_by_label(nodes: DataFrame) -> DataFrame:
    """E4, largest first; ties by label."""
    return nodes.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")


def edge_counts_by_type(edges: DataFrame) -> DataFrame:
    """E5, largest first; ties by type."""
    return edges.groupBy("edge_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "edge_type")


def graph_summary(nodes: DataFrame, edges: DataFrame, label: str | None = None, edge_type: str | None = None) -> DataFrame:
    """Totals in one row, of one label or type if given."""
    n = (nodes if label is None else nodes.where(F.col("label") == label)).agg(F.count("*").alias("nodes"))
    m = (edges if edge_type is None else edges.where(F.col("edge_type") == edge_type)).agg(F.count("*").alias("relationships"))
    return n.crossJoin(m)  # one row each


def load_stats(entities: DataFrame, relationships: DataFrame, chunks: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows sent, and what they came to: distinct nodes and edges, relationships without both ends. ``relationships`` may be
    distinct ones with the number of their rows in ``occurrences`` (``count_relationships``)."""
    one = lambda df, name, n=F.count("*"): df.agg(n.alias(name))
    rows = F.coalesce(F.sum("occurrences"), F.lit(0)) if "occurrences" in relationships.columns else F.count("*")
    return (
        one(valid_entities(entities), "nodes_created").crossJoin(one(valid_relationships(relationships), "relationships_created", rows)).crossJoin(one(chunks, "chunks_created"))
        .crossJoin(one(nodes, "nodes_distinct")).crossJoin(one(edges, "edges_distinct")).crossJoin(one(unmatched_relationships(relationships, nodes), "unmatched", rows))
    )  # fmt: skip  one row each


def chunks_to_graph(entities: DataFrame, relationships: DataFrame, chunks: DataFrame | None = None, existing: dict[str, DataFrame] | None = None, materialize: Callable[[DataFrame], DataFrame] = written) -> dict[str, DataFrame]:
    """F8: nodes, then edges, then chunk nodes, then mentions. ``chunks``: content, source, section, ord; without them the
    existing chunk nodes stay. Nodes are written once, as edges and mentions are looked for among them."""
    from graphloom.operators.chunking import chunk_nodes

    old = existing or {}
    nodes = materialize(merge_entity_nodes(old.get("nodes"), entities))
    edges = merge_edges(old.get("edges"), resolve_edges(relationships, nodes))
    out = {"nodes": nodes, "edges": edges}
    if chunks is None and "chunks" in old:
        out["chunks"] = old["chunks"]
    if chunks is not None:
        rows = chunk_nodes(chunks)
        out["chunks"] = merge_chunk_nodes(old.get("chunks"), rows)
        out["edges"] = merge_edges(edges, link_mentions(rows, nodes))
    return out
