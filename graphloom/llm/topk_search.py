"""Exact top-k by integer inner product, block at a time.

Each task cuts its documents into blocks of consecutive rows and keeps, for every term (vector component), the block's
largest and smallest weight. The sum of a query's weights times these bounds every score in the block. A query visits
blocks by falling bound and scores them through the block's forward index (its rows' weights) until no bound can reach
its k-th score. Tasks return k rows a query at most, and a window merges them.

Vectors that are null or hold null or non-finite components take no part, nor do rows without an id. Vectors of unequal
width count as ending in zeros. A query id that repeats is one query (its smallest vector); a candidate's repeated rows
are candidates each. Queries go out in chunks of ``QUERY_BYTES`` of weights, and a task holds ``RANGE_BYTES`` of rows, so wide vectors
make smaller chunks; of several chunks, each one's finds are written before the next is sent. Tables without rows find nothing; further
columns make no difference.

Weights and scores are 64-bit integers. Blocks whose sums could pass them are scored with Python's integers; a component or
a score among the best that doesn't fit raises ``OverflowError``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.shared import written

BLOCK_ROWS = 512
#: Bytes of the weights of the queries that are sent at once, and of the rows that a task holds at once.
QUERY_BYTES, RANGE_BYTES = 1 << 25, 1 << 24
_NONE = np.iinfo(np.int64).min


def weights(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    lengths = np.diff(ends)
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], lengths)] = values[ends[0] : ends[-1]]
    return out


def _widest(column: pa.Array) -> int:
    return int(np.diff(column.offsets.to_numpy()).max(initial=0))


def nothing_found(n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of n queries before any row was seen: places not taken hold the lowest score."""
    return np.full((n, k), _NONE), np.full((n, k), np.iinfo(np.int64).max)


def search_block_at_a_time(query_ids, queries, ids, vectors, best, best_ids, block_rows: int = BLOCK_ROWS) -> int:
    """Brings ``best`` and ``best_ids`` (best first; ties to the smaller id) up to date with the rows of ``vectors``.

    Returns how many (query, block) pairs were scored. Rows of the query's own id don't count.
    """
    k = best.shape[1]
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    largest = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (queries, vectors)]
    if max(largest) >= np.iinfo(np.int64).max:  # what a cast from double made of something larger
        raise OverflowError("a component's weight does not fit 64 bits")
    most = largest[0] * largest[1] * max(1, queries.shape[1])
    exact = most < 1 << 53
    kind = np.float64 if exact else np.int64 if most < 1 << 63 else object  # BLAS where every sum is exact in doubles
    q, v = queries.astype(kind), vectors.astype(kind)
    cuts = np.arange(0, len(ids), block_rows)
    top, low = np.maximum.reduceat(vectors, cuts).astype(kind), np.minimum.reduceat(vectors, cuts).astype(kind)
    bounds = np.maximum(queries, 0).astype(kind) @ top.T + np.minimum(queries, 0).astype(kind) @ low.T
    visits = np.argsort(-bounds, axis=1, kind="stable")
    scored, live = 0, np.arange(len(q))
    for step in range(len(cuts)):
        block = visits[live, step]
        live, block = (x[bounds[live, block] >= best[live, -1]] for x in (live, block))  # an equal bound can hold a smaller id
        if not live.size:
            break
        scored += live.size
        for b in np.unique(block).tolist():
            rows = live[block == b]
            span = slice(b * block_rows, (b + 1) * block_rows)
            score = (q[rows] @ v[span].T).astype(np.int64)
            score[query_ids[rows][:, None] == ids[span][None, :]] = _NONE
            every = np.concatenate([best[rows], score], axis=1)
            every_ids = np.concatenate([best_ids[rows], np.broadcast_to(ids[span], score.shape)], axis=1)
            every_ids[every == _NONE] = np.iinfo(np.int64).max
            take = np.lexsort((every_ids, -every.astype(np.float64) if exact else ~every), axis=1)[:, :k]
            best[rows], best_ids[rows] = np.take_along_axis(every, take, 1), np.take_along_axis(every_ids, take, 1)
    return scored


def top_k(queries: DataFrame, vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the ``k`` best rows of ``vectors`` for each row of ``queries``, all of whole numbers."""
    spark = vectors.sparkSession

    def narrow(df):
        return df.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("id"), weights(F.col(vector_col)).alias("w"))

    asked, rows = narrow(queries).groupBy("id").agg(F.min("w").alias("w")), narrow(vectors)
    size = asked.agg(F.count("*"), F.max(F.size("w"))).first()
    chunks = max(1, -(-size[0] * (size[1] or 0) * 8 // QUERY_BYTES))
    parts = []
    for c in range(chunks):
        chunk = asked.where(F.pmod(F.xxhash64("id"), F.lit(chunks)) == c).toArrow()
        if not chunk.num_rows:
            continue
        sent = spark.sparkContext.broadcast(chunk.combine_chunks())

        def run(batches, sent=sent):
            asked_ids, asked_w = sent.value.column(0).to_numpy(), sent.value.column(1).combine_chunks()
            best, best_ids = nothing_found(len(asked_ids), k)

            def add(held):
                table = pa.Table.from_batches(held)
                w = table.column(1).combine_chunks()
                width = max(_widest(asked_w), _widest(w))
                ids, v = table.column(0).to_numpy(), _matrix(w, width)
                for a in range(0, len(best), 1024):
                    some = slice(a, a + 1024)
                    search_block_at_a_time(asked_ids[some], _matrix(asked_w[some], width), ids, v, best[some], best_ids[some])

            held, rows_held, width = [], 0, 1
            for batch in batches:
                step = max(1, RANGE_BYTES // 8 // max(_widest(batch.column(1)), 1))
                for a in range(0, batch.num_rows, step):
                    held.append(b := batch.slice(a, step))
                    rows_held, width = rows_held + b.num_rows, max(width, _widest(b.column(1)))
                    if rows_held * width * 8 >= RANGE_BYTES:
                        add(held)
                        held, rows_held, width = [], 0, 1
            if held:
                add(held)
            at, rank = np.nonzero(best != _NONE)
            yield pa.RecordBatch.from_arrays([pa.array(asked_ids[at]), pa.array(best_ids[at, rank]), pa.array(best[at, rank])], ["query_id", "id", "score"])

        part = rows.mapInArrow(run, "query_id long, id long, score long")
        if chunks > 1:
            part = written(part)
            sent.unpersist()
        parts.append(part)
    if not parts:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
