"""Shards along a Hilbert curve over several metadata dimensions.

Source, language and size are quantised to ``BITS`` bits each. Rows in the order of their curve index are cut into runs
of equal row counts (law ``rows``: at most one apart), so each shard's file covers a small box in every dimension and
readers prune files by any of them. The order is made by a range shuffle and per-partition counts, never in one task;
equal rows of one hot source are split by doc_id and text.

Null source or language is a value of its own and comes first; a null text has size 16 and the checksum of the empty
text. Rows that are equal in every read column get places in any order. An empty table gives an empty table. Further
columns are not read.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.shared import written

BITS = 5
#: Categories up to which one task ranks them and all tasks get them; more are ranked by a range shuffle and joined by a shuffle.
MAX_VALUES = 50_000


def hilbert_index(axes: list[np.ndarray], bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve through the grid of ``bits`` bits in each axis (Skilling's transposition)."""
    x = [a.astype(np.int64).copy() for a in axes]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(turned, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ flip) >> b) & 1)
    return out


def _ranked(df: DataFrame, name: str) -> DataFrame:
    """``df`` with ``{name}_code``: the value's rank among all values, spread over the axis."""
    values = df.groupBy(name).count().select(name)
    n = values.count()
    order = F.col(name).asc_nulls_first()
    ranked = values.withColumn("_rank", F.row_number().over(Window.orderBy(order)) - 1) if n <= MAX_VALUES else _ranks(values, [order])
    codes = ranked.select(F.col(name).alias("_value"), F.floor(F.col("_rank") * (1 << BITS) / F.lit(max(n, 1))).cast("int").alias(f"{name}_code"))
    return df.join(F.broadcast(codes) if n <= MAX_VALUES else codes, df[name].eqNullSafe(codes["_value"])).drop("_value")


def _ranks(df: DataFrame, order: list) -> DataFrame:
    """``df`` with ``_rank``, the row's place in the order from 0: a range shuffle, and the counts of its partitions."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = sorted((r[0], r[1]) for r in placed.groupBy(part.alias("p")).count().collect())  # a row for each partition
    before = dict(zip((p for p, _ in counts), accumulate((n for _, n in counts), initial=0), strict=False))
    offsets = spark.createDataFrame(list(before.items()) or [(0, 0)], "_part long, _before long")
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("_rank", F.col("_before") + within).drop("_part", "_before", "_at")


def shard_rows(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", categories: tuple[str, ...] = ("source", "lang"), carry: bool = False) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard, curve_index) of every row; with ``carry`` also ``row``, all its columns."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    size = F.octet_length(text).cast("long") + 16
    whole, own = ([F.struct(*docs.columns).alias("row")], ["row"]) if carry else ([], [])
    rows = written(docs.select(F.col(id_col).alias("id"), size.alias("size"), F.crc32(text).alias("text_crc32"), *categories, *whole))
    total = rows.count()
    for name in categories:
        rows = _ranked(rows, name)
    # The size's magnitude: twice its bit length and the bit after the first.
    length = F.length(F.bin("size"))
    second = F.expr("cast(shiftright(size, length(bin(size)) - 2) & 1 as int)")
    rows = rows.withColumn("size_code", F.least(F.lit((1 << BITS) - 1), 2 * (length - 5) + second))

    @F.pandas_udf("long")
    def curve(*axes: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index([a.to_numpy() for a in axes]))

    rows = rows.withColumn("curve_index", curve(*[F.col(f"{c}_code") for c in (*categories, "size")]))
    order = [F.col("curve_index"), F.col("id").asc_nulls_first(), F.col("text_crc32")]
    ranked = _ranks(rows.select("id", "size", "text_crc32", "curve_index", *own), order)
    shard = F.floor(F.col("_rank") * shards / F.lit(max(total, 1)))
    ranked = ranked.withColumn("shard", F.expr(f"cast(_rank * {shards} div {max(total, 1)} as int)")) if total else ranked.withColumn("shard", shard.cast("int"))
    first = F.expr(f"cast((cast(shard as bigint) * {total} + {shards - 1}) div {shards} as bigint)")
    return ranked.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("_rank") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve_index", *own)


def write_shards(docs: DataFrame, shards: int, path: str, **columns) -> None:
    """Writes every row of ``docs`` into one folder a shard in slot order, so Parquet's statistics are narrow in every dimension.

    Columns of ``docs`` that are called shard or slot give way to the place.
    """
    placed = shard_rows(docs, shards, carry=True, **columns)
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("shard", "slot")]
    placed.select("shard", "slot", *kept).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
