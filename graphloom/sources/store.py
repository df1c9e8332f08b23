"""Schemas as JSON, and graphs as bucketed Parquet tables in versions."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from graphloom.operators.chunking import chunk_nodes
from graphloom.operators.graph import EDGE, link_mentions, merge_chunk_nodes, merge_edges, merge_entity_nodes, resolve_edges, upsert_chunks, upsert_nodes

SCHEMA = (
    "entity_types array<struct<name:string,description:string,example_properties:array<string>>>, "
    "relationship_types array<struct<name:string,from_type:string,to_type:string,description:string>>"
)


def write_schema_json(schema: DataFrame, path: str) -> None:
    """One JSON object, for people to read and change. ``schema`` is one row of the fields of ``SCHEMA``."""
    schema.select(F.to_json(F.struct("entity_types", "relationship_types"), {"pretty": "true"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_schema_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entity types, relationship types); missing lists are empty."""
    schema = spark.read.option("multiLine", True).schema(SCHEMA).json(path)
    return schema.select(F.inline("entity_types")), schema.select(F.inline("relationship_types"))


# --- graphs ------------------------------------------------------------------------------------------------------

#: By which columns each table is dealt into buckets, and how new rows go over stored ones.
KEYS = {"nodes": ("node_id",), "edges": EDGE, "chunks": ("id",)}
_UPSERTS = {"nodes": upsert_nodes, "edges": merge_edges, "chunks": upsert_chunks}


def _keys(name: str, df: DataFrame | StructType) -> tuple[str, ...]:
    names = df.names if isinstance(df, StructType) else df.columns
    return KEYS[name] if name in KEYS and set(KEYS[name]) <= set(names) else (names[0],)


def _manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest manifest below a path or pattern; None where there is none."""
    try:
        found = spark.read.text(f"{path}/complete")
    except AnalysisException:  # no such path
        return None
    newest = found.agg(F.max_by("value", F.get_json_object("value", "$.version").cast("int")).alias("value")).first()
    return newest.value and json.loads(newest.value)


class GraphStore:
    """A10: versions of a graph in one folder, in hash buckets.

    Every table is dealt into ``buckets`` by its key (nodes by id, edges by both ends and type, chunks by id). A version is a
    manifest that names, for each bucket, the generation of files that holds it; it is written last, so a load that was cut
    off leaves the version before it. An upsert reads and writes only the buckets that its rows fall into. Tables are read as
    Spark's bucketed tables, so joins and aggregations by the key don't shuffle what is stored.

    The tables stand in the session's catalog as external ones, by names made from their place. The number of buckets is
    that of the first load (by default, of shuffle partitions) and stays. A load with a name and number (a stream's query and epoch) is done
    once: coming again it changes nothing, whatever other loads came between. Two loads at once: the later one raises.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def latest(self) -> dict | None:
        return _manifest(self.spark, f"{self.root}/v*")

    def read(self, version: int | None = None) -> dict[str, DataFrame]:
        """The tables of a version; of the newest one by default."""
        found = self.latest() if version is None else _manifest(self.spark, f"{self.root}/v{version}")
        if found is None:
            raise ValueError(f"no complete graph in {self.root}")
        return self.tables(found)

    def tables(self, manifest: dict) -> dict[str, DataFrame]:
        return {name: self._read(name, manifest) for name in manifest["tables"]}

    def load(self, entities: DataFrame, relationships: DataFrame, chunks: DataFrame | None = None, once: tuple[str, int] | None = None) -> int:
        """F8 over the newest version: upserts nodes, edges, chunk nodes and mentions; returns the version's number.

        Ends of relationships and mentions are looked for among all names, of which the stored nodes' names and ids are read.
        """
        base = self.latest()
        if once and base and base["loads"].get(once[0], -1) >= once[1]:
            return base["version"]
        generation = f"g{uuid.uuid4().hex}"
        nodes = self._staged(merge_entity_nodes(None, entities), "nodes", generation)
        known = nodes.select("node_id", "name")
        if base and "nodes" in base["tables"]:
            known = known.unionByName(self._read("nodes", base).select("node_id", "name"))
        rows, edges = {"nodes": nodes}, resolve_edges(relationships, known)
        if chunks is not None:
            found = chunk_nodes(chunks)
            rows["chunks"] = self._staged(merge_chunk_nodes(None, found), "chunks", generation)
            edges = edges.unionByName(link_mentions(found, known))
        rows["edges"] = self._staged(edges.distinct(), "edges", generation)
        return self._put(rows, generation, base, once)

    def upsert(self, rows: dict[str, DataFrame], once: tuple[str, int] | None = None) -> int:
        """New rows (nodes, edges, chunks; each key once) over the newest version."""
        base, generation = self.latest(), f"g{uuid.uuid4().hex}"
        if once and base and base["loads"].get(once[0], -1) >= once[1]:
            return base["version"]
        return self._put({name: self._staged(df, name, generation) for name, df in rows.items()}, generation, base, once)

    def vacuum(self, keep: int = 1) -> int:
        """Deletes all versions but the newest ``keep``, and the files that only they name; returns how many buckets' files went.
        Files that no manifest names stay, as a load that is under way may be writing them. Nobody may be reading the old versions."""
        try:
            found = [json.loads(r.value) for r in self.spark.read.text(f"{self.root}/v*/complete").collect()]  # a row a version
        except AnalysisException:  # no version
            return 0
        versions = sorted(found, key=lambda m: m["version"])
        old, kept = versions[: max(0, len(versions) - keep)], versions[max(0, len(versions) - keep) :]
        files = lambda ms: {(name, b, g) for m in ms for name, t in m["tables"].items() for b, g in t["generations"].items()}
        gone = files(old) - files(kept)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for m in old:
            system.delete(path(f"{self.root}/v{m['version']}"), True)
        for name, b, g in gone:
            system.delete(path(f"{self.root}/{name}/bucket={b}/generation={g}"), True)
        return len(gone)

    def _staged(self, df: DataFrame, name: str, generation: str) -> DataFrame:
        """New rows, written first: they are looked at twice, for their buckets and for the merge."""
        path = f"{self.root}/staged/{generation}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _put(self, rows: dict[str, DataFrame], generation: str, base: dict | None, once: tuple[str, int] | None) -> int:
        buckets = base["buckets"] if base else self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        manifest = {"version": base["version"] + 1 if base else 0, "root": self.root, "buckets": buckets, "tables": dict(base["tables"]) if base else {}, "loads": dict(base["loads"]) if base else {}}
        for name, new in rows.items():
            stored = manifest["tables"].get(name)
            schema = StructType.fromJson(stored["schema"]) if stored else new.schema
            generations = dict(stored["generations"]) if stored else {}
            bucket = F.pmod(F.hash(*_keys(name, schema)), F.lit(buckets))
            touched = [r[0] for r in new.select(bucket).distinct().collect()]  # numbers of buckets
            old = {str(b): generations[str(b)] for b in touched if str(b) in generations}
            if old:
                merged = _UPSERTS[name](self._select(name, schema, buckets, old), new)
            else:
                merged = new.repartition(buckets, *_keys(name, schema))
            self._insert(name, schema, buckets, merged, generation)
            manifest["tables"][name] = {"schema": schema.jsonValue(), "generations": generations | {str(b): generation for b in touched}}
        if once:
            manifest["loads"][once[0]] = once[1]
        self._commit(f"{self.root}/v{manifest['version']}", manifest | {"generation": generation})
        return manifest["version"]

    def _commit(self, path: str, manifest: dict) -> None:
        if _manifest(self.spark, path) is not None:
            raise ValueError(f"another load has made {path}")
        rows = self.spark.createDataFrame([(json.dumps(manifest),)], "value string")
        rows.coalesce(1).write.mode("overwrite").text(f"{path}/complete")
        if (_manifest(self.spark, path) or {}).get("generation") != manifest["generation"]:
            raise ValueError(f"another load has made {path}")

    def _table(self, name: str, schema: StructType, buckets: int) -> str:
        """The external table over all generations of a table's files."""
        key = hashlib.md5(f"{self.root}/{name} {schema.json()} {buckets}".encode()).hexdigest()
        table = f"graph_{name}_{key}"
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            keys = ", ".join(_keys(name, schema))
            place = f"{self.root}/{name}".replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, bucket INT, generation STRING) USING parquet PARTITIONED BY (bucket, generation) CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}'")
        return table

    def _insert(self, name: str, schema: StructType, buckets: int, df: DataFrame, generation: str) -> None:
        bucket = F.pmod(F.hash(*_keys(name, schema)), F.lit(buckets)).alias("bucket")
        df.select(*schema.names, bucket, F.lit(generation).alias("generation")).write.insertInto(self._table(name, schema, buckets))

    def _select(self, name: str, schema: StructType, buckets: int, generations: dict[str, str]) -> DataFrame:
        table = self._table(name, schema, buckets)
        self.spark.catalog.refreshTable(table)
        by: dict[str, list[int]] = {}
        for b, g in generations.items():
            by.setdefault(g, []).append(int(b))
        wanted = F.lit(False)
        for g, some in by.items():
            wanted = wanted | ((F.col("generation") == g) & F.col("bucket").isin(some))
        return self.spark.table(table).where(wanted).select(*schema.names)

    def _read(self, name: str, manifest: dict) -> DataFrame:
        stored = manifest["tables"][name]
        return self._select(name, StructType.fromJson(stored["schema"]), manifest["buckets"], stored["generations"])


def write_graph(graph: dict[str, DataFrame], path: str) -> None:
    """A10: whole tables as one version in a folder of its own; the manifest comes last, so a graph without it is not complete."""
    spark = next(iter(graph.values())).sparkSession
    store, generation = GraphStore(spark, path), f"g{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = {}
    for name, df in graph.items():
        keys = _keys(name, df)
        store._insert(name, df.schema, buckets, df.repartition(buckets, *keys), generation)
        tables[name] = {"schema": df.schema.jsonValue(), "generations": {str(b): generation for b in range(buckets)}}
    manifest = {"version": 0, "root": store.root, "buckets": buckets, "tables": tables, "loads": {}, "generation": generation}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/complete")


def read_graph(spark: SparkSession, path: str, tables: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """A10: the tables of a complete graph (all that it has by default), labels and types as they were written. ``path`` is that of
    ``write_graph`` or of a store's version."""
    manifest = _manifest(spark, path)
    if manifest is None:
        raise ValueError(f"no complete graph in {path}")
    found = GraphStore(spark, manifest["root"]).tables(manifest)
    return {name: df for name, df in found.items() if tables is None or name in tables}
