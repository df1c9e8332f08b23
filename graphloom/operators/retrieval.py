"""Similarity search, walks along edges, context for a question, and metrics of a run."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.sources.shared import written

#: Bytes of query vectors that are sent at once, and of vectors that a task compares at once.
QUERY_BYTES, RANGE_BYTES = 1 << 26, 1 << 24
#: Queries to which every vector's angle bounds its angle to the others, and how far a bound must be off to count.
PIVOTS, MARGIN = 16, 1e-9
#: Rows of a part of the starts, or of the nodes, that meet when a walk's result is given to all starts of a group.
PART = 512


def _units(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of length 1 (or 0), shorter ones as ending in zeros."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    out, lengths = np.zeros((len(column), width)), np.diff(ends)
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], lengths)] = values[ends[0] : ends[-1]]
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(size > 0, size, 1)


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def _pivots(q: np.ndarray) -> np.ndarray:
    """Queries far from each other: each next one is the farthest from those taken."""
    taken, near = [0], q @ q[0]
    while len(taken) < PIVOTS and near.min() < 1 - MARGIN:
        taken.append(int(near.argmin()))
        near = np.maximum(near, q @ q[taken[-1]])
    return q[taken]


def _search(ids: np.ndarray, q: np.ndarray, own: np.ndarray, v: np.ndarray, best: np.ndarray, best_ids: np.ndarray) -> int:
    """Brings the best scores (best first, ties to the smaller id) up to date with unit vectors ``v``; returns the pairs scored.

    Vectors are grouped by their nearest pivot. By the triangle inequality of angles, a group's range of angles to every
    pivot bounds its cosines with a query; groups whose bound is below a query's k-th best score are not scored for it.
    """
    pivots = _pivots(q)
    to_query, to_pivot = _angles(q, pivots), _angles(v, pivots)
    nearest = to_pivot.argmin(axis=1)
    groups = [np.flatnonzero(nearest == p) for p in range(len(pivots))]
    groups = [part for g in groups if g.size for part in np.array_split(g[np.argsort(to_pivot[g, nearest[g[0]]], kind="stable")], -(-g.size // 256))]
    low, high = (np.stack([f(to_pivot[g], axis=0) for g in groups]) for f in (np.min, np.max))
    apart = np.maximum(to_query[:, None, :] - high[None], low[None] - to_query[:, None, :]).max(axis=2)
    bound = np.cos(np.clip(apart - MARGIN, 0, np.pi)) + MARGIN
    visits, scored, live = np.argsort(-bound, axis=1, kind="stable"), 0, np.arange(len(q))
    for step in range(len(groups)):
        group = visits[live, step]
        keep = bound[live, group] >= best[live, -1]
        live, group = live[keep], group[keep]
        for g in np.unique(group).tolist():
            rows, some = live[group == g], groups[g]
            score = q[rows] @ v[some].T
            scored += score.size
            score[ids[rows][:, None] == own[some][None, :]] = -np.inf
            every = np.concatenate([best[rows], score], axis=1)
            every_ids = np.concatenate([best_ids[rows], np.broadcast_to(own[some], score.shape)], axis=1)
            take = np.lexsort((every_ids, -every), axis=1)[:, : best.shape[1]]
            best[rows], best_ids[rows] = np.take_along_axis(every, take, 1), np.take_along_axis(every_ids, take, 1)
    return scored


def top_k_similar(queries: DataFrame, vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scored: Accumulator | None = None) -> DataFrame:
    """(query_id, rank, id, score): exact cosine, ties to the smaller id; a query's own id doesn't count.

    Vectors that are null or hold a null or non-finite component, and rows without an id, take no part; of unequal widths, the
    shorter one ends in zeros; a vector without length has cosine 0 with all. Queries go out in chunks of ``QUERY_BYTES``; each task
    keeps the k best of all its rows for a query and returns these alone. Groups of vectors too far from a query are not
    compared with it (``_search``); ``scored`` counts the pairs that were (a repeated task counts again).
    """
    spark = vectors.sparkSession
    finite = F.coalesce(F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    narrow = lambda df: df.where(finite & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    asked, rows = narrow(queries).groupBy("id").agg(F.min("v").alias("v")), narrow(vectors)
    n, widest = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    chunks = max(1, -(-n * (widest or 0) * 8 // QUERY_BYTES))
    found = None
    for c in range(chunks):
        table = asked.where(F.pmod(F.xxhash64("id"), F.lit(chunks)) == c).toArrow()
        if not table.num_rows:
            continue
        sent = spark.sparkContext.broadcast(table.combine_chunks())

        def run(batches, sent=sent):
            ids, asked_v = sent.value.column(0).to_numpy(), sent.value.column(1).combine_chunks()
            wide = lambda column: int(np.diff(column.offsets.to_numpy()).max(initial=1))
            best, best_ids = np.full((len(ids), k), -np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)
            for batch in batches:
                width = max(wide(asked_v), wide(batch.column(1))) if batch.num_rows else 1
                q, step = (_units(asked_v, width) if batch.num_rows else None), max(1, RANGE_BYTES // 8 // width)
                for a in range(0, batch.num_rows, step):
                    part = batch.slice(a, step)
                    own, other = part.column(0).to_numpy(), _units(part.column(1), width)
                    for b in range(0, len(ids), 1024):
                        some = slice(b, b + 1024)
                        n = _search(ids[some], q[some], own, other, best[some], best_ids[some])
                        if scored is not None:
                            scored.add(n)
            at, rank = np.nonzero(best > -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(best_ids[at, rank]), pa.array(best[at, rank])], ["query_id", "id", "score"])

        part = rows.mapInArrow(run, "query_id long, id long, score double")
        if chunks > 1:  # so that one chunk is held at a time
            part = written(part)
            sent.unpersist()
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = spark.createDataFrame([], "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def _steps(edges: DataFrame, edge_types: tuple[str, ...] | None, directed: bool) -> DataFrame:
    e = (edges if edge_types is None else edges.where(F.col("edge_type").isin(*edge_types))).select("src_id", "dst_id")
    return (e if directed else e.unionByName(e.select(F.col("dst_id").alias("src_id"), F.col("src_id").alias("dst_id")))).distinct()


def hubs(edges: DataFrame, max_degree: int, edge_types: tuple[str, ...] | None = None, directed: bool = True) -> DataFrame:
    """(node_id, degree) of the nodes from which a walk with ``max_degree`` doesn't go on."""
    return _steps(edges, edge_types, directed).groupBy(F.col("src_id").alias("node_id")).agg(F.count("*").alias("degree")).where(F.col("degree") > max_degree)


def _twins(starts: DataFrame, e: DataFrame) -> DataFrame:
    """(start_id, rep, alone): starts whose steps lead to the same nodes have the least of them as ``rep``; null without a step. Sets of
    nodes are told apart by their size and 128 bits of hash, so none is gathered."""
    here = e.join(starts.select(F.col("start_id").alias("src_id")), "src_id", "left_semi")
    marks = here.groupBy(F.col("src_id").alias("start_id")).agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("dst_id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "dst_id")).alias("y"))
    reps = marks.groupBy("n", "x", "y").agg(F.min("start_id").alias("rep"), (F.count("*") == 1).alias("alone"))
    return starts.join(marks.join(reps, ["n", "x", "y"]).select("start_id", "rep", "alone"), "start_id", "left")


def _for_each_twin(twins: DataFrame, reached: DataFrame) -> DataFrame:
    """(start_id, node_id, hop): each of ``twins`` (start_id, rep) beside all that its ``rep`` reaches (start_id, node_id, hop).

    Both sides of a rep are dealt into parts of about ``PART`` rows, and two parts meet in a group of their own: a hot rep is spread,
    and about a ``PART``-th of the result is shuffled.
    """
    n = int(twins.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = lambda df, name: df.groupBy("rep").agg(F.ceil(F.count("*") / PART).cast("int").alias(name))
    nodes = reached.select(F.col("start_id").alias("rep"), "node_id", "hop")
    sizes = parts(twins, "rows").join(parts(nodes, "columns"), "rep")
    own = lambda c, size: F.pmod(F.xxhash64(c), F.col(size)).cast("int")
    every = lambda size: F.explode(F.sequence(F.lit(0), F.col(size) - 1))
    left = twins.join(sizes, "rep").select("rep", "start_id", own("start_id", "rows").alias("i"), every("columns").alias("j"))
    right = nodes.join(sizes, "rep").select("rep", "node_id", "hop", every("rows").alias("i"), own("node_id", "columns").alias("j"))
    keys = ["rep", "i", "j"]
    return left.repartition(n, *keys).join(right.repartition(n, *keys), keys).select("start_id", "node_id", "hop")


def k_hop(start: DataFrame, edges: DataFrame, hops: int, edge_types: tuple[str, ...] | None = None, directed: bool = True, max_degree: int | None = None, materialize: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """(start_id, node_id, hop) of every node within ``hops`` steps of the nodes in ``start`` (node_id), with its least hop.

    Starts with the same first steps are walked from once (``_twins``); what they reach is the same but for themselves, and is given to each
    at the end. Each hop's frontier is written, and holds only nodes that no earlier one has, so every node is walked from once and the plan
    grows by one join a hop; steps are written once. ``max_degree`` keeps walks from going on from ``hubs``, which that function lists.
    """
    e = _steps(edges, edge_types, directed)
    if max_degree is not None:
        e = e.join(hubs(edges, max_degree, edge_types, directed).select(F.col("node_id").alias("src_id")), "src_id", "left_anti")
    e = written(e)
    groups = materialize(_twins(start.select(F.col("node_id").alias("start_id")).distinct(), e))
    at_start = lambda df: df.select("start_id", F.col("start_id").alias("node_id"), F.lit(0).alias("hop"))
    other = ~F.col("start_id").eqNullSafe(F.col("node_id"))
    found, front = at_start(groups), at_start(groups.where("start_id = rep"))
    seen, reached = at_start(groups.where("start_id = rep and alone")), None  # twins reach each other, so a rep counts as seen only if alone
    for h in range(1, hops + 1):
        ahead = front.join(e, front["node_id"] == e["src_id"]).select("start_id", F.col("dst_id").alias("node_id")).distinct()
        front = materialize(ahead.join(seen.select("start_id", "node_id"), ["start_id", "node_id"], "left_anti").withColumn("hop", F.lit(h)))
        if front.isEmpty():
            break
        seen, reached = seen.unionByName(front), front if reached is None else reached.unionByName(front)
    if reached is None:
        return found
    found = found.unionByName(reached.where(other))
    twins = groups.where("start_id <> rep").select("start_id", "rep")
    return found if twins.isEmpty() else found.unionByName(_for_each_twin(twins, reached).where(other))


def match_path(start: DataFrame, edges: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """(start_id, node_id) at the end of a directed path with these edge types, distinct at each step."""
    front = start.select(F.col("node_id").alias("start_id"), "node_id").distinct()
    for t in types:
        e = edges.where(F.col("edge_type") == t).select("src_id", "dst_id")
        front = front.join(e, front["node_id"] == e["src_id"]).select("start_id", F.col("dst_id").alias("node_id")).distinct()
    return front


def match_path_rows(start: DataFrame, edges: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """Every directed path with these edge types from the nodes in ``start``: (start_id, node_id, nodes, edges), with the ids of
    its nodes in order and its edges as structs. As many rows as paths."""
    front = start.select(F.col("node_id").alias("start_id"), "node_id").distinct().withColumn("nodes", F.array("node_id")).withColumn("edges", F.array().cast("array<struct<src_id:string,edge_type:string,dst_id:string>>"))
    for t in types:
        e = edges.where(F.col("edge_type") == t).select("src_id", "edge_type", "dst_id").distinct()
        grown = F.concat("nodes", F.array("dst_id")).alias("nodes"), F.concat("edges", F.array(F.struct("src_id", "edge_type", "dst_id"))).alias("edges")
        front = front.join(e, front["node_id"] == e["src_id"]).select("start_id", F.col("dst_id").alias("node_id"), *grown)
    return front


def hybrid_context(hits: DataFrame, chunks: DataFrame, edges: DataFrame, nodes: DataFrame, hops: int = 1) -> DataFrame:
    """(query_id, kind, id, text): the found chunks' texts, and the names of what their entities reach.

    ``hits``: query_id, rank, id of a chunk.
    """
    texts = hits.join(chunks.select("id", "text"), "id").select("query_id", F.lit("chunk").alias("kind"), "id", "text")
    mentioned = hits.join(edges.where("edge_type = 'MENTIONS'").select(F.col("src_id").alias("id"), F.col("dst_id").alias("start_id")), "id").select("query_id", "start_id").distinct()
    reached = k_hop(mentioned.select(F.col("start_id").alias("node_id")), edges.where("edge_type <> 'MENTIONS'"), hops)
    facts = mentioned.join(reached, "start_id").select("query_id", "node_id").distinct().join(nodes.select("node_id", "label", "name"), "node_id")
    return texts.unionByName(facts.select("query_id", F.lit("entity").alias("kind"), F.col("node_id").alias("id"), F.concat_ws(": ", "label", "name").alias("text")))


def pipeline_metrics(calls: DataFrame, entities: DataFrame, distinct_entities: DataFrame, cost_per_call: float = 0.003) -> DataFrame:
    """Of each document: chunks, failures, retries, answers without JSON, cost and entities; throttled calls and mean and
    longest seconds of a chunk where ``calls`` has them (as D5 gives them); and the run's dedup ratio."""
    bad = (F.col("status") == "ok") & ~F.contains("response", F.lit("{"))
    per_doc = calls.groupBy("doc_id").agg(
        F.count("*").alias("chunks"), F.sum((F.col("status") != "ok").cast("long")).alias("failed"), F.sum(F.col("attempts") - 1).alias("retries"), F.sum(F.coalesce(bad, F.lit(False)).cast("long")).alias("malformed"),
        F.sum(F.col("attempts") * cost_per_call).alias("cost"),
        *([F.sum("throttles").alias("throttles")] if "throttles" in calls.columns else []),
        *([F.avg("seconds").alias("mean_seconds"), F.max("seconds").alias("longest_seconds")] if "seconds" in calls.columns else []),
    )
    found = entities.groupBy("doc_id").agg(F.count("*").alias("entities"))
    ratio = entities.agg(F.count("*").alias("all")).crossJoin(distinct_entities.agg(F.count("*").alias("kept"))).select(F.when(F.col("all") > 0, 1 - F.col("kept") / F.col("all")).otherwise(0.0).alias("dedup_ratio"))
    return per_doc.join(found, "doc_id", "left").fillna(0, ["entities"]).crossJoin(ratio)  # one row
