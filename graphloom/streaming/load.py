"""A file stream into the graph: every batch is an idempotent upsert, so a repeated one changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graphloom.sources.store import GraphStore


def graph_upsert(spark: SparkSession, path: str, split, buckets: int | None = None, name: str = ""):
    """A ``foreachBatch`` function: ``split`` turns a batch into (entities, relationships, chunks), which become the next version of
    the ``GraphStore`` in ``path``. A batch that comes again after its version was complete changes nothing; one that was cut
    off is loaded anew. Batches are told apart by the stream's query id, which its checkpoint keeps, and the epoch: a second stream into the
    same graph goes on from the newest version. ``name`` stands for the query id where there is none."""
    store = GraphStore(spark, path, buckets)

    def load(batch: DataFrame, epoch: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or name
        store.load(*split(batch), once=(query, epoch))

    return load


def stream_files(spark: SparkSession, directory: str, schema: str, upsert, checkpoint: str):
    """Starts the load of Parquet files as they arrive in ``directory``."""
    stream = spark.readStream.schema(schema).parquet(directory)
    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
