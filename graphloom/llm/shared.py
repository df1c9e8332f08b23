"""Helpers of the operators: written tables, files in the shared folder, and bounded Arrow batches."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes in an Arrow batch that carries whole texts (a longer text is a batch of its own).
TEXT_BATCH_ROWS, TEXT_BATCH_BYTES = 512, 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """A new folder's URI below ``spark.checkpoint.dir``; a temporary folder only where it is unset on one machine, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/graphloom-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again: lineage ends there, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches small, as rows hold whole texts. The session keeps these sizes: later functions get such batches too."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", TEXT_BATCH_BYTES)


def filesystem(uri: str):
    """The Arrow filesystem of a URI and the path in it; ``file`` or none is the mounted shared folder itself."""
    from pyarrow import fs

    at = urlparse(uri)
    if at.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(at.path)
    return fs.FileSystem.from_uri(uri)


def put_file(folder: str, name: str, parts: Iterator[bytes] | list[bytes]) -> str:
    """Writes ``parts`` to a name of its own and then moves it into place, so a second attempt of a task does no harm."""
    store, path = filesystem(folder)
    store.create_dir(path, recursive=True)
    attempt = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(attempt) as out:
        for part in parts:
            out.write(part)
    store.move(attempt, f"{path}/{name}")
    return f"{folder}/{name}"


def open_file(uri: str):
    """A seekable reader: memory-mapped where the shared folder is mounted."""
    store, path = filesystem(uri)
    if urlparse(uri).scheme in ("", "file"):
        return pa.memory_map(path, "r")
    return store.open_input_file(path)


def mounted(uri: str) -> bool:
    return urlparse(uri).scheme in ("", "file")


def map_file(uri: str):
    """A file's bytes: mapped into memory where the shared folder is mounted, else read whole."""
    return open_file(uri).read_buffer()


def kept_files(read):
    """Keeps what ``read`` made of the files of one folder: of many mapped files, or of a few that were read whole."""
    many, few, last = functools.lru_cache(4096)(read), functools.lru_cache(16)(read), [""]

    @functools.wraps(read)  # so that it is pickled by its own name
    def get(uri: str):
        folder = uri.rpartition("/")[0]
        if folder != last[0]:
            many.cache_clear()
            few.cache_clear()
            last[0] = folder
        return many(uri) if mounted(uri) else few(uri)

    return get


def make_dirs(folder: str) -> None:
    """Creates a mounted shared folder before tasks write into it."""
    if urlparse(folder).scheme in ("", "file"):
        os.makedirs(unquote(urlparse(folder).path), exist_ok=True)


def byte_runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive runs of items of at most ``most`` bytes each; a larger item is a run of its own."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)
