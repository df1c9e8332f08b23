"""URL rules in a sorted digest array: 64-bit xxhash keys in memory-mapped files, vectorised binary search, stored strings.

A rule is (host, path, verdict). It fits a URL whose host is the rule's or below it and whose path begins with the
rule's. Every host suffix and path prefix that a rule could have is hashed and searched for; the stored string then
confirms a hit, so two keys with one digest do no harm. The longest fitting rule wins.

Null URLs and URLs without ``://`` have an empty host and path and fit no rule. Rules with equal host and path count once;
``block`` wins. Without rules each URL gets the default verdict. Repeated rows stay; further columns are not read; pages without rows
give none. A long URL is looked up by all of its host's suffixes and all prefixes of its path.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.shared import make_dirs, open_file, put_file, shared_dir

_HEAD = 3  # of a shard file: int64 count and bytes of rule strings, and of verdict strings


def _digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key)


def build_index(rules: DataFrame) -> tuple[list[tuple[int, str]], list[int]]:
    """Writes the digest array of ``rules`` (host, path, verdict) as files by digest range into the shared folder.

    Returns the first digest and name of each file, and the lengths that rule paths have.
    """
    spark = rules.sparkSession
    folder = shared_dir(spark)
    make_dirs(folder)
    # An A-Z host is stored in lower case, as hosts are compared so.
    keyed = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select(_lower(F.col("host")).alias("host"), "path", "verdict")
    keyed = keyed.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    lengths = [r[0] for r in keyed.select(F.length("path")).distinct().collect()]  # as many as paths have lengths

    def digests(batches):
        for b in batches:
            keys = [h + p for h, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            signed = np.array([_digest(k) for k in keys], np.uint64) ^ np.uint64(1 << 63)  # ordered as signed numbers
            yield pa.RecordBatch.from_arrays([pa.array(signed.view(np.int64)), pa.array(keys, pa.string()), b.column(2)], ["digest", "rule", "verdict"])

    def write(batches):
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        t = pa.Table.from_batches(table)
        keys = t.column(0).to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
        texts = [[x.encode() for x in t.column(i).to_pylist()] for i in (1, 2)]
        ends = [np.cumsum([0, *map(len, x)]).astype(np.int64) for x in texts]
        head = np.array([keys.size, ends[0][-1], ends[1][-1]], np.int64)
        name = put_file(folder, f"{int(keys[0]):016x}.urls", [head.tobytes(), keys.tobytes(), ends[0].tobytes(), ends[1].tobytes(), *texts[0], *texts[1]])
        yield pa.RecordBatch.from_arrays([pa.array([int(keys[0]) - (1 << 63)], pa.int64()), pa.array([name])], ["digest", "name"])

    ordered = keyed.select("host", "path", "verdict").mapInArrow(digests, "digest long, rule string, verdict string").repartitionByRange("digest").sortWithinPartitions("digest", "rule")
    files = ordered.mapInArrow(write, "digest long, name string").collect()  # one row a file
    return sorted((r.digest + (1 << 63), r.name) for r in files), sorted(lengths)


@functools.lru_cache(64)
def _shard(name: str):
    buf = np.frombuffer(open_file(name).read_buffer(), np.uint8)
    n, a, b = buf[: 8 * _HEAD].view(np.int64).tolist()
    at = 8 * _HEAD + 8 * n
    keys = buf[8 * _HEAD : at].view(np.uint64)
    rule_ends, verdict_ends = buf[at : at + 8 * (n + 1)].view(np.int64), buf[at + 8 * (n + 1) : at + 16 * (n + 1)].view(np.int64)
    text = at + 16 * (n + 1)
    return keys, (buf[text : text + a], rule_ends), (buf[text + a : text + a + b], verdict_ends)


def _string(column, i: int) -> str:
    data, ends = column
    return data[ends[i] : ends[i + 1]].tobytes().decode()


def probe(index: list[tuple[int, str]], keys: list[str]) -> list[tuple[str, str] | None]:
    """The (rule, verdict) stored under each key, or None."""
    found: list[tuple[str, str] | None] = [None] * len(keys)
    if not index or not keys:
        return found
    digests = np.array([_digest(k) for k in keys], np.uint64)
    firsts = np.array([x for x, _ in index], np.uint64)
    at = np.searchsorted(firsts, digests, "right") - 1
    for s in np.unique(at[at >= 0]).tolist():
        stored, rules, verdicts = _shard(index[s][1])
        mine = np.flatnonzero(at == s)
        pos = np.searchsorted(stored, digests[mine], "left")
        for k, i in zip(mine.tolist(), pos.tolist(), strict=True):
            while i < stored.size and stored[i] == digests[k]:  # more than one only where digests collide
                if _string(rules, i) == keys[k]:
                    found[k] = (keys[k], _string(verdicts, i))
                    break
                i += 1
    return found


def _lower(col):
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def judge(batch_hosts: list[str], batch_paths: list[str], index, lengths: list[int]) -> list[tuple[str, str] | None]:
    """The longest fitting rule of each URL; among equally long ones that with the longer host."""
    keys, owner = [], []
    for u, (host, path) in enumerate(zip(batch_hosts, batch_paths, strict=True)):
        cuts = [0, *(i + 1 for i, c in enumerate(host) if c == ".")] if host else []
        found = {(host[c:] + path[:n], len(host) - c) for c in cuts for n in lengths if n <= len(path)}
        for key, _ in sorted(found, key=lambda x: (-len(x[0]), -x[1])):
            keys.append(key)
            owner.append(u)
    best: list[tuple[str, str] | None] = [None] * len(batch_hosts)
    for u, hit in zip(owner, probe(index, keys), strict=True):
        if hit and best[u] is None:
            best[u] = hit
    return best


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``pages``; ``rules`` has host, path and verdict (allow or block)."""
    index, lengths = build_index(rules)
    url = F.coalesce(F.col(url_col), F.lit(""))
    parts = pages.select(
        F.col(id_col).alias("id"),
        _lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"),
    )

    def run(batches):
        for b in batches:
            best = judge(b.column(1).to_pylist(), b.column(2).to_pylist(), index, lengths)
            rule = pa.array([x and x[0] for x in best], pa.string())
            verdict = pc.fill_null(pa.array([x and x[1] for x in best], pa.string()), default)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), rule, verdict], ["id", "host", "path", "rule", "verdict"])

    kind = pages.schema[id_col].dataType.simpleString()
    return parts.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col)
